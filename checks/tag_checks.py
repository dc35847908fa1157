"""Tag edges, mutual reinforcement, tag table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagmill.operators.tags import (
    normalize_l1,
    tag_confidence,
    tag_edges,
    tag_rows,
    tag_table,
    user_authority,
    vector_distance,
)

from .base import check, rounded, table

# Both sides settle: the operators by their tolerance, the SQL after more rounds than that takes.
ROUNDS = 14
TOLERANCE = 1e-13

# Customers tag suppliers with the words of the parts they order; every third word is dressed up
# so that several raw tags share one normalised form.
ROWS_SQL = """
    SELECT user_id, subject_id,
           CASE WHEN l_linenumber % 3 = 0 THEN upper(tag) || '!' ELSE tag END AS tags,
           tag AS tags_normalized
    FROM (SELECT 'u' || o_custkey AS user_id, l_suppkey AS subject_id, l_linenumber,
                 unnest(string_split(p_name, ' ')) AS tag
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

EDGES_SQL = f"""
    SELECT user_id, subject_id, tags_normalized, count(*) AS n FROM ({ROWS_SQL}) GROUP BY 1, 2, 3"""


def authority_ctes(rounds: int) -> str:
    ctes = [
        f"edges AS MATERIALIZED ({EDGES_SQL})",
        "u0 AS (SELECT user_id, 1.0 / count(*) OVER () AS score "
        "FROM (SELECT DISTINCT user_id FROM edges))",
    ]
    for i in range(rounds):
        ctes += [
            f"h{i} AS MATERIALIZED (SELECT subject_id, tags_normalized, sum(n * score) AS hub "
            f"FROM edges JOIN u{i} USING (user_id) GROUP BY 1, 2)",
            f"s{i} AS MATERIALIZED (SELECT user_id, sum(n * hub) AS raw "
            f"FROM edges JOIN h{i} USING (subject_id, tags_normalized) GROUP BY 1)",
            f"u{i + 1} AS MATERIALIZED (SELECT user_id, raw / (SELECT sum(raw) FROM s{i}) AS score FROM s{i})",
        ]
    return ",\n".join(ctes)


HUBS_SQL = f"""
    SELECT subject_id, tags_normalized, sum(n * score) AS confidence,
           CAST(sum(n) AS BIGINT) AS tagnorm_cnt
    FROM edges JOIN u{ROUNDS} USING (user_id) GROUP BY 1, 2"""


def tagged_records(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"
    )
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    parts = table(spark, sf, "part").select("p_partkey", "p_name")
    words = F.split("p_name", " ")
    dressed = F.transform(words, lambda w: F.concat(F.upper(w), F.lit("!")))
    return (
        lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
        .join(parts, lines["l_partkey"] == parts["p_partkey"])
        .select(
            F.concat(F.lit("u"), "o_custkey").alias("user_id"),
            F.col("l_suppkey").alias("subject_id"),
            F.when(F.col("l_linenumber") % 3 == 0, dressed).otherwise(words).alias("tags"),
        )
    )


def archive(spark, sf):
    return table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"))


def edges(spark, sf):
    return tag_edges(tag_rows(tagged_records(spark, sf), archive(spark, sf)))


@check(EDGES_SQL, "tag_edges")
def tag_edges_query(spark, sf):
    return edges(spark, sf)


@check(
    f"WITH {authority_ctes(ROUNDS)} SELECT user_id, round(score, 10) AS score FROM u{ROUNDS}",
    "user_authority",
)
def user_authority_query(spark, sf):
    return rounded(user_authority(edges(spark, sf), tol=TOLERANCE), 10, "score")


@check(
    f"""WITH {authority_ctes(ROUNDS)}
    SELECT subject_id, tags_normalized, round(confidence, 8) AS confidence, tagnorm_cnt
    FROM ({HUBS_SQL})""",
    "tag_confidence",
)
def tag_confidence_query(spark, sf):
    return rounded(tag_confidence(edges(spark, sf), tol=TOLERANCE), 8, "confidence")


@check(
    f"""WITH {authority_ctes(ROUNDS)}
    SELECT r.subject_id AS iid, tags, r.tags_normalized, round(confidence, 8) AS confidence,
           tag_cnt, tagnorm_cnt
    FROM (SELECT subject_id, tags, tags_normalized, count(*) AS tag_cnt
          FROM ({ROWS_SQL}) GROUP BY 1, 2, 3) r
    JOIN ({HUBS_SQL}) h
      ON r.subject_id = h.subject_id AND r.tags_normalized = h.tags_normalized""",
    "tag_table",
)
def tag_table_query(spark, sf):
    tags = tag_table(tagged_records(spark, sf), archive(spark, sf), tol=TOLERANCE)
    return rounded(tags, 8, "confidence")


@check(
    """
    SELECT c_custkey, round(c_acctbal / sum(c_acctbal) OVER (), 12) AS share FROM customer""",
    "normalize_l1",
)
def normalize_l1_query(spark, sf):
    shares = normalize_l1(table(spark, sf, "customer"), "c_acctbal")
    return shares.select("c_custkey", F.round("c_acctbal", 12).alias("share"))


@check(
    """
    WITH a AS (SELECT o_custkey AS k, sum(o_totalprice) AS v FROM orders GROUP BY 1),
         b AS (SELECT o_custkey AS k, count(*) AS v FROM orders GROUP BY 1)
    SELECT round(sqrt(sum((a.v - b.v) * (a.v - b.v))), 3) AS distance FROM a JOIN b USING (k)""",
    "vector_distance",
)
def vector_distance_query(spark, sf):
    orders = table(spark, sf, "orders").withColumnRenamed("o_custkey", "k").groupBy("k")
    spent = orders.agg(F.sum("o_totalprice").alias("v"))
    counted = orders.agg(F.count(F.lit(1)).cast("double").alias("v"))
    return rounded(vector_distance(spent, counted, "k", "v"), 3, "distance")
