"""Registration of queries, and the catalogue-shaped views of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def check(sql: str | None = None, name: str | None = None):
    """Register a query under its function name, with the SQL that gives the same rows."""

    def register(query):
        key = name or query.__name__
        QUERIES[key] = query
        if sql is not None:
            SQL[key] = sql
        return query

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Users rate parts: one row per order line.
RECORDS_SQL = """
    SELECT o_custkey AS user_order, l_partkey AS subject_id,
           CAST(ceil(l_quantity / 5) AS INTEGER) AS rate
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def records(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("o_custkey").alias("user_order"),
        F.col("l_partkey").alias("subject_id"),
        F.ceil(F.col("l_quantity") / 5).cast("int").alias("rate"),
    )


# Parts as subjects: media type, localised name (null, empty or given), rank, number of ratings.
SUBJECTS_SQL = """
    SELECT p_partkey AS id, lower(p_type) AS type, p_name AS name,
           CASE p_size % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE p_brand END AS name_cn,
           CASE WHEN p_size > 25 THEN p_partkey + 1 END AS rank,
           coalesce(n, 0) AS rate_count
    FROM part LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1)
      ON l_partkey = p_partkey"""


def localised_name() -> Column:
    size = F.col("p_size") % 3
    return F.when(size == 0, F.lit(None)).when(size == 1, F.lit("")).otherwise(F.col("p_brand"))


def subjects(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    parts = table(spark, sf, "part")
    return parts.join(lines, parts["p_partkey"] == lines["l_partkey"], "left").select(
        F.col("p_partkey").alias("id"),
        F.lower("p_type").alias("type"),
        F.col("p_name").alias("name"),
        localised_name().alias("name_cn"),
        F.when(F.col("p_size") > 25, F.col("p_partkey") + 1).alias("rank"),
        F.coalesce("n", F.lit(0)).alias("rate_count"),
    )


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})
