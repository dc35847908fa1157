"""Round trips through every file format; outputs go to the shared scratch folder."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.schemas import DOUBLE, INT, LONG, TEXT, struct
from tagmill.operators.snapshots import removed_keys
from tagmill.session import counted, scratch_folder
from tagmill.sources.readers import (
    latest_snapshot,
    list_files,
    read_csv,
    read_jsonlines,
    read_lines_with_key,
    read_tsv,
)
from tagmill.sources.writers import (
    flat_items,
    route,
    write_chunked,
    write_csv,
    write_item_tsv,
    write_jsonlines,
    write_numbered,
    write_routed,
    write_tsv,
)

from .base import check, table

AS_OF = dt.date(2026, 12, 1)
AWKWARD_SQL = """p_name || CASE WHEN p_partkey % 2 = 0 THEN chr(9) || '"NA", ' ELSE '' END AS name"""


def _awkward_parts(spark, sf):
    """Names with tabs, quotes and commas in them, and a rank missing for some."""
    extra = F.when(F.col("p_partkey") % 2 == 0, F.lit('\t"NA", ')).otherwise("")
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("iid"),
        F.concat("p_name", extra).alias("name"),
        F.when(F.col("p_size") > 25, F.col("p_size").cast("long")).alias("rank"),
    )


PARTS_SQL = f"""
    SELECT p_partkey AS iid, {AWKWARD_SQL}, CASE WHEN p_size > 25 THEN p_size END::BIGINT AS rank
    FROM part"""
PARTS = struct(iid=LONG, name=TEXT, rank=LONG)


@check(PARTS_SQL)
def jsonlines_round_trip(spark, sf):
    path = write_jsonlines(_awkward_parts(spark, sf), scratch_folder(spark, "files"), AS_OF)
    return read_jsonlines(spark, path, PARTS)


@check(PARTS_SQL)
def tsv_round_trip(spark, sf):
    path = scratch_folder(spark, "files")
    write_tsv(_awkward_parts(spark, sf), path)
    return read_tsv(spark, path, PARTS)


@check(f"SELECT iid, name FROM ({PARTS_SQL})")
def csv_round_trip(spark, sf):
    path = scratch_folder(spark, "files")
    write_csv(_awkward_parts(spark, sf), path, ["iid", "name"])
    return read_csv(spark, path, struct(iid=LONG, name=TEXT))


@check(
    """
    SELECT l_partkey || '_' || l_suppkey AS key,
           '{"l_partkey":' || l_partkey || ',"l_suppkey":' || l_suppkey || '}' AS line
    FROM lineitem"""
)
def keyed_lines(spark, sf):
    path = scratch_folder(spark, "files")
    lines = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey")
    write_chunked(lines, path, 10_000)
    return read_lines_with_key(spark, path, ["l_partkey", "l_suppkey"])


ITEMS_SQL = """
    SELECT o_custkey AS uid, array_to_string(list(DISTINCT o_orderpriority ORDER BY o_orderpriority), ';')
             AS tags,
           'status:' || array_to_string(list(DISTINCT o_orderstatus ORDER BY o_orderstatus), ',')
             || ';n:' || count(*) AS staff
    FROM orders GROUP BY 1"""


def _items(spark, sf):
    status = F.sort_array(F.collect_set("o_orderstatus"))
    number = F.array(F.count(F.lit(1)).cast("string"))
    return (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("uid"))
        .agg(
            F.sort_array(F.collect_set("o_orderpriority")).alias("tags"),
            F.create_map(F.lit("status"), status, F.lit("n"), number).alias("staff"),
        )
    )


@check(ITEMS_SQL, "flat_items")
def flat_items_query(spark, sf):
    return flat_items(_items(spark, sf), ["uid", "tags", "staff"])


@check(ITEMS_SQL)
def item_tsv_round_trip(spark, sf):
    path = scratch_folder(spark, "files")
    write_item_tsv(_items(spark, sf), path, ["uid", "tags", "staff"])
    return spark.read.schema(struct(uid=LONG, tags=TEXT, staff=TEXT)).csv(
        path, sep="\t", header=True, escape='"'
    )


@check(
    """
    SELECT CASE WHEN event_type = 'signup' THEN 'user'
                WHEN event_type = 'click' AND value > 10 THEN 'record' ELSE 'rest' END AS file, event_id
    FROM events"""
)
def routed_items(spark, sf):
    signup = F.col("event_type") == "signup"
    record = (F.col("event_type") == "click") & (F.col("value") > 10)
    outputs = route(table(spark, sf, "events"), {"user": signup, "record": record})
    named = [d.select(F.lit(n).alias("file"), "event_id") for n, d in outputs.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


@check(
    """
    SELECT CASE WHEN event_type = 'signup' THEN 'user'
                WHEN event_type = 'click' AND value > 10 THEN 'record' ELSE 'rest' END AS file, event_id,
           CASE WHEN event_type = 'click' AND value > 10 THEN round(value, 6) END AS value
    FROM events"""
)
def routed_in_one_scan(spark, sf):
    """Outputs with columns of their own; only records have a value."""
    signup = F.col("event_type") == "signup"
    record = (F.col("event_type") == "click") & (F.col("value") > 10)
    columns = {"user": ["event_id"], "record": ["event_id", "value"], "rest": ["event_id"]}
    outputs = write_routed(
        table(spark, sf, "events"), {"user": signup, "record": record}, scratch_folder(spark, "routes"), columns=columns
    )
    named = [
        d.select(
            F.lit(n).alias("file"), "event_id", F.round(d["value"] if n == "record" else F.lit(None).cast("double"), 6).alias("value")
        )
        for n, d in outputs.items()
    ]
    return named[0].unionByName(named[1]).unionByName(named[2])


@check(
    """
    SELECT CAST(floor(n / 1000) AS BIGINT) AS chunk, count(*) AS rows, 1::BIGINT AS files
    FROM (SELECT row_number() OVER () - 1 AS n FROM lineitem) GROUP BY 1"""
)
def numbered_files(spark, sf):
    """Every numbered file but the last is full, and each number is one file."""
    path = scratch_folder(spark, "files")
    write_numbered(table(spark, sf, "lineitem").select("l_orderkey"), path, 1_000)
    stored = spark.read.schema(struct(l_orderkey=LONG, chunk=LONG)).json(path)
    return stored.groupBy("chunk").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(F.col("_metadata.file_path")).alias("files")
    )


@check("SELECT count(*) AS rows, true AS within_limit FROM orders")
def chunked_files(spark, sf):
    path = scratch_folder(spark, "files")
    write_chunked(table(spark, sf, "orders").select("o_orderkey"), path, 1_000)
    written = spark.read.schema(struct(o_orderkey=LONG)).json(path)
    per_file = written.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return per_file.agg(
        F.sum("n").alias("rows"), (F.max("n") <= 1_000).alias("within_limit")
    )


@check(
    """
    SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 5 = 0"""
)
def dated_snapshots(spark, sf):
    """Two dated snapshots are written; the newest and the one before are found again and compared."""
    folder, orders = scratch_folder(spark, "snapshots"), table(spark, sf, "orders").select("o_orderkey")
    write_jsonlines(orders.where("o_orderkey % 3 <> 0"), f"{folder}/orders", dt.date(2026, 11, 30))
    write_jsonlines(orders.where("o_orderkey % 5 <> 0"), f"{folder}/orders", dt.date(2026, 12, 1))
    files = list_files(spark, folder)
    newest, before = (latest_snapshot(files, "orders", n).first()["path"] for n in (1, 2))
    shape = struct(o_orderkey=LONG)
    gone = removed_keys(
        read_jsonlines(spark, before, shape), read_jsonlines(spark, newest, shape), "o_orderkey"
    )
    return gone.select(F.col("o_orderkey").alias("id"))


COUNTED = ("lineitem", "orders", "part", "events", "pages")


@check(" UNION ALL ".join(f"SELECT '{name}' AS dataset, count(*) AS rows, count(*) AS lines FROM {name}" for name in COUNTED))
def counted_datasets(spark, sf):
    """Rows observed while datasets are written, in the same job, beside the lines that their files hold."""
    folder, found = scratch_folder(spark, "files"), []
    for name in COUNTED:
        observed, seen = counted(table(spark, sf, name), name)
        write_jsonlines(observed, f"{folder}/{name}", AS_OF)
        lines = spark.read.option("recursiveFileLookup", "true").text(f"{folder}/{name}")
        counts = lines.agg(F.count(F.lit(1)).alias("lines"))
        found.append(counts.select(F.lit(name).alias("dataset"), F.lit(seen.get["rows"]).cast("long").alias("rows"), "lines"))
    return reduce(DataFrame.unionByName, found)


SCANNED = struct(l_partkey=LONG, l_linenumber=INT, l_quantity=DOUBLE)


@check("SELECT l_partkey, l_linenumber, l_quantity FROM lineitem")
def jsonlines_scan(spark, sf):
    path = scratch_folder(spark, "files")
    table(spark, sf, "lineitem").select(*SCANNED.names).write.json(path)
    return read_jsonlines(spark, path, SCANNED)
