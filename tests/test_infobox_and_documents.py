import datetime as dt
import json

from pyspark.sql import functions as F

from tagmill.functions.infobox import (
    info_from_json,
    info_json,
    infobox_first,
    normalize_infobox,
    parse_infobox,
)
from tagmill.operators.documents import build_documents
from tagmill.operators.subjects import (
    eligible_subjects,
    enrich_subjects,
    first_non_null,
    subject_aliases,
    subject_list,
)
from tagmill.schemas import INFO_TYPE, INT, LONG, SUBJECT_API, TEXT, struct

AS_OF = dt.date(2026, 12, 1)


def parse(spark, text):
    df = spark.createDataFrame([(text,)], "infobox string")
    row = parse_infobox(df).select("info_type", info_json("info").alias("j"), "error").first()
    return row["info_type"], json.loads(row["j"]), row["error"]


def entries(spark, body):
    return parse(spark, "{{Infobox T\n" + body + "\n}}")[1]


def test_entries(spark):
    assert entries(spark, "|中文名= x\n|空= ") == [
        {"key": "中文名", "value": "x"},
        {"key": "空", "value": None},
    ]
    listed = [{"key": "别名", "value": [{"v": "a"}, {"k": "k", "v": "b"}]}]
    assert entries(spark, "|别名={\n[a]\n[k|b]\n[k|]\n}") == listed
    assert entries(spark, "|别名= x\n{\n[a]\n}") == [{"key": "别名", "value": [{"v": "a"}]}]
    assert entries(spark, "|a b = 1=2\n\n  ") == [{"key": "a b ", "value": "1=2"}]
    assert entries(spark, "|a={\n}") == [{"key": "a", "value": []}]


def test_odd_braces(spark):
    # A closing brace without a list repeats the field with its bar; alone it has no key at all.
    assert entries(spark, "|a=1\n}") == [{"key": "a", "value": "1"}, {"key": "|a", "value": None}]
    assert entries(spark, "}") == [{"key": None, "value": None}]
    # A brace after an opened list takes the entry before it and the first sign of the key.
    assert entries(spark, "|x=1\n|ab={\n{\n[v]\n}") == [{"key": "b", "value": [{"v": "v"}]}]


def test_empty_and_broken(spark):
    assert parse(spark, "") == (None, None, None)
    assert parse(spark, None) == (None, None, None)
    assert parse(spark, "{{Infobox T\n}}") == ("T", None, None)
    for broken in (
        "{{Infobox T\n|a={\n[x]\n|b=1\n}}",
        "{{Infobox T\n|a\n}}",
        "{{Infobox T\n|a= 1",
        "{{Infobox T\n[x]\n}}",
        "{{Infobox T\n|a={ x\n}}",
        "{{Infobox T\n|a={\n[x]\n}}",
        "{{Infobox T\n{\n}}",
        "{{Infobox T\n|a={\nplain\n}\n}}",
        "text",
    ):
        info_type, info, error = parse(spark, broken)
        assert info == [] and error and info_type is None, broken
    # An item with a label and no text is skipped even outside of a list.
    assert parse(spark, "{{Infobox T\n[k|]\n}}") == ("T", None, None)


INFO = [
    ("别名", None, [(None, "A")]),
    ("开始", "2009-04-05", None),
    ("开始", "2010年4月5日", None),
    ("集数", "12", None),
    ("其他", "z", None),
    ("平台", "TV", None),
    ("话数", None, None),
    ("结束", "never", None),
]


def test_lookups_through_json(spark):
    df = spark.createDataFrame([(INFO,)], struct(info=INFO_TYPE))
    df = df.select(info_from_json(info_json("info")).alias("info"))
    row = df.select(
        infobox_first("info", "别名").alias("alias"),
        infobox_first("info", "平台").alias("platform"),
        infobox_first("info", "话数").alias("empty"),
        infobox_first("info", "none").alias("none"),
        normalize_infobox("info", as_of=AS_OF).alias("known"),
    ).first()
    assert (row["alias"], row["platform"], row["empty"], row["none"]) == (["A"], ["TV"], None, None)
    assert row["known"] == {"date_onair": "2010-04-05", "num_episodes": "12"}


def test_documents(spark):
    schema = struct(id=LONG, name=TEXT, name_cn=TEXT, fav_count=LONG, info=INFO_TYPE)
    subjects = spark.createDataFrame(
        [(1, "N", "C", 7, INFO), (2, "M", "", 0, [("别名", "B", None)]), (3, "L", None, 3, None)],
        schema,
    ).select("id", "name", "name_cn", "fav_count", info_json("info").alias("infobox"))
    tags = spark.createDataFrame(
        [(1, "t1", "t1", 0.5, 3, 3), (1, "t2", "t2", 0.1, 1, 1)],
        "iid long, tags string, tags_normalized string, confidence double, tag_cnt long, "
        "tagnorm_cnt long",
    )
    ranking = spark.createDataFrame([(1, 4)], "name long, rank_custom long")
    rows = {r["id"]: r for r in build_documents(subjects, tags, ranking, AS_OF).collect()}
    assert [tuple(s) for s in rows[1]["suggest"]] == [("N", 7), ("C", 7), ("A", 3), ("t1", 3)]
    assert rows[1]["infobox"] == {"date_onair": "2010-04-05", "num_episodes": "12"}
    assert rows[1]["rank_custom"] == 4 and [t["tags"] for t in rows[1]["tags"]] == ["t1", "t2"]
    assert [tuple(s) for s in rows[2]["suggest"]] == [("M", 1), ("B", 1)]
    assert [tuple(s) for s in rows[3]["suggest"]] == [("L", 3)] and rows[3]["infobox"] == {}


def test_aliases(spark):
    box = "{{Infobox T\n|中文名= 甲\n|英文名= E\n|别名={\n[a!]\n[x|b]\n}\n}}"
    df = spark.createDataFrame(
        [(1, "N!", "N!", box), (2, "M", "", None), (3, None, None, None)],
        "id long, name string, name_cn string, infobox string",
    )
    plain = sorted(tuple(r) for r in subject_aliases(df).collect())
    assert plain == [(1, "N!", "n"), (2, "M", "m")]
    full = {r["alias"] for r in subject_aliases(df, include_infobox=True).where("id = 1").collect()}
    assert full == {"N!", "甲", "E", "a!", "b"}


def test_statistics(spark):
    def counters(wish):
        return (wish, 0, 0, 0, 0)

    stats = spark.createDataFrame(
        [(1, 1, counters(4), (None, 10)), (1, 2, counters(9), (0, 20))], SUBJECT_API
    )
    archive = spark.createDataFrame(
        [(1, 2, "a", None, "", "s\x00"), (2, None, "b", "", None, None)],
        struct(id=LONG, type=INT, name=TEXT, name_cn=TEXT, infobox=TEXT, summary=TEXT),
    )
    rows = {r["id"]: r for r in enrich_subjects(stats, archive).collect()}
    one, two = rows[1], rows[2]
    assert (one["rank"], one["wish_count"], one["fav_count"], one["rate_count"]) == (None, 4, 4, 10)
    assert (one["type"], one["infobox"], one["summary"]) == ("anime", "null", "s")
    assert (two["rank"], two["fav_count"], two["rate_count"]) == (None, 0, 0)


def test_first_non_null_skips_nulls(spark):
    df = spark.createDataFrame(
        [(1, 1, None, "a"), (1, 2, 5, None), (1, 3, 6, "b"), (None, 1, 1, "x")],
        "k int, o int, x int, y string",
    )
    assert [tuple(r) for r in first_non_null(df, ["k"], ["x", "y"], "o").collect()] == [(1, 5, "a")]


def test_eligible(spark):
    df = spark.createDataFrame(
        [
            (1, "anime", "n", None, 3, 1),
            (2, "anime", "n", "", None, 50),
            (3, "anime", "n", "c", None, 49),
            (4, "game", "n", "c", 1, 900),
        ],
        "id long, type string, name string, name_cn string, rank long, rate_count long",
    )
    rows = sorted(tuple(r) for r in subject_list(eligible_subjects(df)).collect())
    assert rows == [(1, "n", 3), (2, "", None)]


def test_json_of_special_characters(spark):
    text = 'q"\\\n\t/é你'
    df = spark.createDataFrame([([("k", text, None)],)], struct(info=INFO_TYPE))
    row = df.select(info_json("info").alias("j"), info_from_json(info_json("info")).alias("i")).first()
    assert json.loads(row["j"]) == [{"key": "k", "value": text}]
    assert row["i"][0]["value"] == text
    assert json.loads(row["j"]) == json.loads(json.dumps([{"key": "k", "value": text}]))
