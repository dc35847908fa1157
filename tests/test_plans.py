"""What the physical plans must and must not contain."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from tagmill.operators.extract import page_users
from tagmill.operators.pairs import compare_items, user_cdf
from tagmill.operators.ranking import rank_lists
from tagmill.operators.snapshots import removed_keys
from tagmill.operators.tags import raw_tags


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def records(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "records")
    spark.range(1000).select(
        (F.col("id") % 20).alias("user_order"),
        (F.col("id") % 50).alias("subject_id"),
        (F.col("id") % 10 + 1).cast("int").alias("rate"),
        F.concat(F.lit("u"), F.col("id") % 20).alias("user_id"),
        F.array(F.lit("a")).alias("tags"),
        F.lit("long text").alias("comment"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_only_needed_columns_are_read(records):
    for df in (compare_items(records), user_cdf(records).select("cdf"), raw_tags(records)):
        shown = plan(df)
        assert "comment" not in shown
        assert "CartesianProduct" not in shown and "BroadcastNestedLoopJoin" not in shown


def test_shares_and_pairs_never_gather_a_user(records):
    """Windows run over stored counts per (user, rate), never over the records."""
    shown = plan(compare_items(records))
    windowed = [part for part in shown.split("\n\n") if "Window" in part.split("\n")[0] and "Input" in part]
    assert windowed and all("_n#" in part.split("Arguments")[0] for part in windowed)
    assert "/rates" in shown
    # One exchange feeds both sides of the self-join.
    df = compare_items(records)
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_filters_reach_the_scan(records):
    shown = plan(removed_keys(records.where("subject_id > 5"), records, "user_order"))
    assert "PushedFilters: [IsNotNull(subject_id), GreaterThan(subject_id,5)" in shown
    assert "LeftAnti" in shown


def test_a_page_is_read_once(spark):
    df = spark.createDataFrame([("u", None, "<p>")], "url string, redirect_from string, html string")
    tree = plan(page_users(df)).split("\n\n")[0]
    assert tree.count("ArrowEvalPython") == 1


def test_ranks_exchange_rows_once(records):
    """One range exchange of the rows, which is stored; after it only the small table of ranges is shuffled or sent."""
    ratings = records.select("subject_id", "rate")
    shown = plan(rank_lists(ratings, "rate", ["subject_id"]))
    assert "rate#" not in "".join(line for line in shown.splitlines() if "Join condition" in line or "Left keys" in line)
    scans = [part for part in shown.split("\n\n") if "Scan parquet" in part.split("\n")[0]]
    assert scans and all("/ranges" in scan for scan in scans)


def test_a_rating_of_a_third_of_the_rows_is_spread(spark):
    rows = spark.range(6_000).select("id", F.when(F.col("id") % 3 == 0, 7.5).otherwise(F.col("id") / 2).alias("v"))
    ranked = rank_lists(rows, "v", parts=8)
    got = {r["id"]: r["rank"] for r in ranked.collect()}
    above = sum(1 for i in range(6_000) if i % 3 and i / 2 > 7.5)
    assert {got[i] for i in range(0, 6_000, 3)} == {above + 1}
    folder = [p for p in ranked.inputFiles() if "/ranges" in p][0].rsplit("/", 1)[0]
    ranges = spark.read.parquet(folder).where("v = 7.5").groupBy("_range").count().collect()
    assert len(ranges) > 2 and max(r["count"] for r in ranges) < 1_500


def test_ranks_do_not_use_one_task(records):
    shown = plan(rank_lists(records.select("subject_id", "rate"), "rate"))
    assert "CartesianProduct" not in shown and "BroadcastNestedLoopJoin" not in shown
    windows = [line for line in shown.splitlines() if "specifiedwindowframe" in line]
    assert windows
    # The only window without a partition is over the sizes of the ranges, at most one row per range.
    assert "_size" in "".join(w for w in windows if "windowspecdefinition(_range" in w)
