"""Snapshots and feeds."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagmill.operators.snapshots import snapshot_diff
from tagmill.operators.subjects import composite_key
from tagmill.sources.readers import latest_snapshot

from .base import check, table

# Two snapshots of what customers bought: lines shipped before 1998, and the lines from 1997 on.
BEFORE_SQL = """
    SELECT DISTINCT l_partkey || '_' || l_suppkey AS id FROM lineitem
    WHERE l_shipdate < TIMESTAMP '1998-01-01'"""
NOW_SQL = """
    SELECT l_partkey || '_' || l_suppkey AS id, l_orderkey, l_linenumber FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1997-01-01'"""


def _snapshots(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        composite_key("l_partkey", "l_suppkey").alias("id"),
        "l_orderkey",
        "l_linenumber",
        "l_shipdate",
    )
    before = lines.where(F.col("l_shipdate") < F.to_timestamp_ntz(F.lit("1998-01-01")))
    now = lines.where(F.col("l_shipdate") >= F.to_timestamp_ntz(F.lit("1997-01-01")))
    return before, now


@check(f"{BEFORE_SQL} EXCEPT SELECT id FROM ({NOW_SQL})")
def snapshot_deletes(spark, sf):
    return snapshot_diff(*_snapshots(spark, sf), "id")[1]


@check(NOW_SQL)
def snapshot_upserts(spark, sf):
    return snapshot_diff(*_snapshots(spark, sf), "id")[0].drop("l_shipdate")


@check(
    """
    SELECT path, strftime(mtime, '%Y-%m-%d') AS day FROM (
      SELECT 'store/subject_' || o_orderkey AS path, o_orderdate AS mtime FROM orders)
    WHERE path LIKE 'store/subject\\_1%' ESCAPE '\\'
    ORDER BY mtime DESC, path DESC LIMIT 1 OFFSET 1""",
    "latest_snapshot",
)
def latest_snapshot_query(spark, sf):
    files = table(spark, sf, "orders").select(
        F.concat(F.lit("store/subject_"), "o_orderkey").alias("path"),
        F.col("o_orderdate").alias("mtime"),
    )
    found = latest_snapshot(files, "subject_1", n=2)
    return found.select("path", F.date_format("mtime", "yyyy-MM-dd").alias("day"))


@check(
    """
    SELECT o_orderkey AS id, 'open' AS feed FROM orders WHERE o_orderstatus = 'O'
    UNION ALL
    SELECT o_orderkey, 'dear' FROM orders WHERE o_totalprice > 300000
    UNION
    SELECT NULL, 'none' WHERE false"""
)
def merged_feeds(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), "o_orderstatus", "o_totalprice"
    )
    opened = orders.where("o_orderstatus = 'O'").select("id", F.lit("open").alias("feed"))
    dear = orders.where("o_totalprice > 300000").select(F.lit("dear").alias("feed"), "id")
    return opened.unionByName(dear).dropDuplicates()
