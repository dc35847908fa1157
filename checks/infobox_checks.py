"""Infobox parsing and lookups, suggestions, documents."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tagmill.functions.infobox import (
    info_from_json,
    info_json,
    infobox_first,
    normalize_infobox,
    parse_infobox,
)
from tagmill.operators.documents import build_documents, build_suggestions, tags_of_subject

from .base import check, localised_name, table

AS_OF = dt.date(2026, 12, 1)


def boxes(spark, sf):
    """Template text of each part: scalars, an empty value, two lists, dates, a dropped key."""
    text = F.concat(
        F.lit("{{Infobox "), "p_type", F.lit("\r\n|中文名= "), "p_name",
        F.lit("\r\n|空= \r\n|别名={\r\n["), "p_brand", F.lit("]\r\n[en|"), "p_name",
        F.lit("]\r\n[k|]\r\n}\r\n|平台= "), "p_type", F.lit("\r\n|集数= "), "p_size",
        F.lit("\r\n|开始= 2009-04-05\r\n|放送开始= 2010年"), F.col("p_size") % 12 + 1,
        F.lit("月1日\r\n|其他= z\r\n}}"),
    )
    # Some are broken: a line without "=", and a list that is never closed.
    broken = F.when(F.col("p_partkey") % 10 == 0, F.concat(F.lit("{{Infobox x\n|no\n}}"))).when(
        F.col("p_partkey") % 10 == 1, F.lit("{{Infobox x\n|a={\n[v]\n}}")
    )
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.coalesce(broken, text).alias("infobox")
    )


GOOD = "p_partkey % 10 > 1"


@check(
    f"""
    SELECT id, pos, key, value, items FROM (
      SELECT p_partkey AS id, unnest(range(8)) AS pos,
             unnest(['中文名', '空', '别名', '平台', '集数', '开始', '放送开始', '其他']) AS key,
             unnest([p_name, NULL, NULL, p_type, CAST(p_size AS VARCHAR), '2009-04-05',
                     '2010年' || (p_size % 12 + 1) || '月1日', 'z']) AS value,
             unnest([NULL, NULL, ':' || p_brand || ';en:' || p_name, NULL, NULL, NULL, NULL, NULL])
               AS items
      FROM part WHERE {GOOD})""",
    "parse_infobox",
)
def parse_infobox_query(spark, sf):
    parsed = parse_infobox(boxes(spark, sf)).select("id", F.posexplode("info").alias("pos", "entry"))
    labelled = F.transform(
        "entry.items", lambda i: F.concat(F.coalesce(i["k"], F.lit("")), F.lit(":"), i["v"])
    )
    return parsed.select(
        "id",
        F.col("pos").cast("long").alias("pos"),
        "entry.key",
        "entry.value",
        F.array_join(labelled, ";").alias("items"),
    )


@check(
    f"""
    SELECT p_partkey AS id, CASE WHEN {GOOD} THEN p_type END AS info_type,
           NOT ({GOOD}) AS failed, CASE WHEN {GOOD} THEN 8 ELSE 0 END AS entries
    FROM part"""
)
def infobox_errors(spark, sf):
    parsed = parse_infobox(boxes(spark, sf))
    return parsed.select(
        "id", "info_type", F.col("error").isNotNull().alias("failed"), F.size("info").alias("entries")
    )


@check(
    f"""
    SELECT p_partkey AS id, CASE WHEN {GOOD} THEN p_brand || '|' || p_name END AS alias,
           CASE WHEN {GOOD} THEN p_type END AS platform, NULL::VARCHAR AS absent
    FROM part""",
    "infobox_first",
)
def infobox_first_query(spark, sf):
    # Through the JSON text and back, as between two jobs.
    info = info_from_json(info_json(F.col("info")))
    parsed = parse_infobox(boxes(spark, sf)).select("id", info.alias("info"))
    return parsed.select(
        "id",
        F.array_join(infobox_first("info", "别名"), "|").alias("alias"),
        F.array_join(infobox_first("info", "平台"), "|").alias("platform"),
        F.array_join(infobox_first("info", "空"), "|").alias("absent"),
    )


@check(
    f"""
    SELECT p_partkey AS id, unnest(['name_cn', 'num_episodes', 'date_onair']) AS key,
           unnest([p_name, CAST(p_size AS VARCHAR),
                   '2010-' || lpad(CAST(p_size % 12 + 1 AS VARCHAR), 2, '0') || '-01']) AS value
    FROM part WHERE {GOOD}""",
    "normalize_infobox",
)
def normalize_infobox_query(spark, sf):
    parsed = parse_infobox(boxes(spark, sf))
    return parsed.select("id", F.explode(normalize_infobox("info", as_of=AS_OF)))


# Tags of a part: the return flags of its order lines, with their counts.
TAGS_SQL = """
    SELECT l_partkey AS iid, l_returnflag AS tags, sum(l_quantity) AS confidence, count(*) AS tag_cnt
    FROM lineitem GROUP BY 1, 2"""


def part_tags(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_partkey").alias("iid"), F.col("l_returnflag").alias("tags"))
        .agg(F.sum("l_quantity").alias("confidence"), F.count(F.lit(1)).alias("tag_cnt"))
    )


@check(
    f"""
    SELECT iid AS id, row_number() OVER (PARTITION BY iid ORDER BY tags) - 1 AS pos, tags,
           confidence, tag_cnt
    FROM ({TAGS_SQL})""",
    "tags_of_subject",
)
def tags_of_subject_query(spark, sf):
    listed = tags_of_subject(part_tags(spark, sf))
    return listed.select("id", F.posexplode("tags").alias("pos", "t")).select(
        "id", F.col("pos").cast("long").alias("pos"), "t.tags", "t.confidence", "t.tag_cnt"
    )


SUGGEST_SQL = f"""
    SELECT id, input, weight FROM (
      SELECT p_partkey AS id, p_name AS input, greatest(1, p_size - 3)::BIGINT AS weight FROM part
      UNION ALL
      SELECT p_partkey, p_brand, greatest(1, p_size - 3) FROM part WHERE p_size % 3 = 2
      UNION ALL
      SELECT p_partkey, unnest(ALIASES), greatest(1, CAST(floor((p_size - 3) / 2) AS BIGINT))
      FROM part WHERE {GOOD}
      UNION ALL
      SELECT iid, tags, tag_cnt FROM ({TAGS_SQL}) WHERE tag_cnt > 1
        AND iid IN (SELECT p_partkey FROM part))"""


@check(SUGGEST_SQL.replace("ALIASES", "[p_type]"), "build_suggestions")
def build_suggestions_query(spark, sf):
    tags = tags_of_subject(part_tags(spark, sf))
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        localised_name().alias("name_cn"),
        F.when(F.col("p_partkey") % 10 > 1, F.array("p_type")).alias("alias"),
        (F.col("p_size") - 3).cast("long").alias("fav_count"),
    )
    both = parts.join(tags, "id", "left")
    return both.select("id", F.inline(build_suggestions()))


def documents(spark, sf):
    names = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        localised_name().alias("name_cn"),
        (F.col("p_size") - 3).cast("long").alias("fav_count"),
    )
    texts = parse_infobox(boxes(spark, sf)).select("id", info_json("info").alias("infobox"))
    ranking = table(spark, sf, "part").where("p_size > 10").select(
        F.col("p_partkey").alias("name"), F.col("p_size").cast("long").alias("rank_custom")
    )
    return build_documents(names.join(texts, "id"), part_tags(spark, sf), ranking, AS_OF)


@check(
    f"""
    SELECT p_partkey AS id, p_name AS name, CASE WHEN p_size > 10 THEN p_size END::BIGINT
             AS rank_custom,
           CASE WHEN {GOOD} THEN p_brand || '|' || p_name END AS alias,
           CASE WHEN {GOOD} THEN p_type END AS platform,
           CASE WHEN {GOOD} THEN CAST(p_size AS VARCHAR) END AS episodes,
           CASE WHEN {GOOD} THEN 3 ELSE 0 END AS fields, coalesce(n, 0) AS tags
    FROM part LEFT JOIN (SELECT iid, count(*) AS n FROM ({TAGS_SQL}) GROUP BY 1) ON iid = p_partkey""",
    "build_documents",
)
def build_documents_query(spark, sf):
    return documents(spark, sf).select(
        "id",
        "name",
        "rank_custom",
        F.array_join("alias", "|").alias("alias"),
        F.array_join("platform", "|").alias("platform"),
        F.try_element_at("infobox", F.lit("num_episodes")).alias("episodes"),
        F.size("infobox").alias("fields"),
        F.coalesce(F.size("tags"), F.lit(0)).cast("long").alias("tags"),
    )


@check(SUGGEST_SQL.replace("ALIASES", "[p_brand, p_name]"))
def document_suggestions(spark, sf):
    return documents(spark, sf).select("id", F.inline("suggest"))
