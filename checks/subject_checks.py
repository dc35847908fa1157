"""Statistics, types, eligibility, enrichment, aliases, landed API answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagmill.functions.infobox import infobox_subtype, infobox_type
from tagmill.operators.api import (
    allowed_users,
    api_collections,
    api_subjects,
    api_users,
    collection_pages,
)
from tagmill.operators.subjects import (
    COUNTS,
    display_name,
    eligible_subjects,
    enrich_subjects,
    first_non_null,
    flatten_stats,
    known_only,
    resolve_type,
    settle_counts,
    subject_aliases,
    subject_list,
)
from tagmill.sources.readers import ids_between, latest_by

from .base import SUBJECTS_SQL, check, localised_name, subjects, table

PRIORITIES = {
    "wish": "1-URGENT",
    "collect": "2-HIGH",
    "doing": "3-MEDIUM",
    "on_hold": "4-NOT SPECIFIED",
    "dropped": "5-LOW",
}

# Statistics per customer: orders by priority as counters, a rank that is 0 or null for some.
COUNTERS_SQL = ", ".join(
    f"count(*) FILTER (WHERE o_orderpriority = '{p}') AS {name}" for name, p in PRIORITIES.items()
)
RENAMED_SQL = """wish AS wish_count, on_hold AS on_hold_count, dropped AS dropped_count,
    doing AS do_count, collect AS collect_count, wish + on_hold + dropped + doing + collect
    AS fav_count"""


def statistics(spark, sf):
    """Two answers per customer (``order`` 1 and 2), the second one with doubled counters."""
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderpriority")
    counted = orders.groupBy(F.col("o_custkey").alias("id")).agg(
        *[
            F.count(F.when(F.col("o_orderpriority") == p, 1)).alias(name)
            for name, p in PRIORITIES.items()
        ],
        F.count(F.lit(1)).alias("total"),
    )
    both = counted.withColumn("order", F.explode(F.array(F.lit(1), F.lit(2))))
    counters = [(F.col(c) * F.col("order")).alias(c) for c in PRIORITIES]
    second = F.when(F.col("order") == 2, F.col("id") % 7)
    return both.select(
        "id",
        F.col("order").cast("long").alias("order"),
        F.struct(*counters).alias("collection"),
        F.struct(second.alias("rank"), F.col("total").alias("total")).alias("rating"),
    )


@check(
    f"""
    SELECT id, n AS "order", {', '.join(
        f'{old} * n AS {new}' for old, new in [
            ('wish', 'wish_count'), ('on_hold', 'on_hold_count'), ('dropped', 'dropped_count'),
            ('doing', 'do_count'), ('collect', 'collect_count'),
            ('(wish + on_hold + dropped + doing + collect)', 'fav_count')])},
        CASE WHEN n = 2 THEN id % 7 END AS rank, total AS rate_count
    FROM (SELECT o_custkey AS id, {COUNTERS_SQL}, count(*) AS total FROM orders GROUP BY 1),
         (SELECT unnest([1, 2])::BIGINT AS n)"""
)
def flattened_statistics(spark, sf):
    return flatten_stats(statistics(spark, sf)).drop("collection", "rating")


@check(
    """
    SELECT o_custkey AS id,
           arg_min(o_totalprice, o_orderkey) FILTER (WHERE o_orderstatus = 'F') AS price,
           arg_min(o_orderpriority, o_orderkey) FILTER (WHERE o_orderstatus <> 'F') AS priority
    FROM orders GROUP BY 1""",
    "first_non_null",
)
def first_non_null_query(spark, sf):
    final = F.col("o_orderstatus") == "F"
    given = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("id"),
        "o_orderkey",
        F.when(final, F.col("o_totalprice")).alias("price"),
        F.when(~final, F.col("o_orderpriority")).alias("priority"),
    )
    return first_non_null(given, ["id"], ["price", "priority"], "o_orderkey")


@check(
    """
    SELECT o_custkey, o_orderkey, o_totalprice, o_orderpriority FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey DESC)
      = 1""",
    "latest_by",
)
def latest_by_query(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", "o_totalprice", "o_orderpriority"
    )
    return latest_by(orders, "o_totalprice", ["o_custkey"])


@check(f"SELECT id, coalesce(name_cn, name) AS shown FROM ({SUBJECTS_SQL})")
def display_names(spark, sf):
    return subjects(spark, sf).select("id", display_name().alias("shown"))


HEADERS = {
    "animanga/Manga": "book",
    "animanga/TV": "anime",
    "animanga/BookSeries": "book",
    "Album": "music",
    "Game": "game",
    "real/Television": "real",
    "None": None,
}
HEADER_LIST = list(HEADERS)
CODES_SQL = "CASE WHEN p_size % 8 IN (0, 7) THEN NULL ELSE p_size % 8 END"
LABEL_SQL = " ".join(
    f"WHEN {n} THEN '{label}'"
    for n, label in {1: "book", 2: "anime", 3: "music", 4: "game", 6: "real"}.items()
)
HEADER_SQL = "[" + ", ".join(f"'{h}'" for h in HEADER_LIST) + "][1 + p_partkey % 7]"


def headed_parts(spark, sf):
    code = F.col("p_size") % 8
    header = F.get(F.array(*[F.lit(h) for h in HEADER_LIST]), (F.col("p_partkey") % 7).cast("int"))
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        F.when(~code.isin(0, 7), code).alias("type"),
        F.col("p_name").alias("name"),
        localised_name().alias("name_cn"),
        F.concat(F.lit("{{Infobox "), header, F.lit("\r\n|中文名= "), "p_name", F.lit("\r\n}}")).alias(
            "infobox"
        ),
        F.concat("p_name", F.lit("\x00"), "p_brand").alias("summary"),
    )


@check(
    f"""
    SELECT id, coalesce(CASE code {LABEL_SQL} END, CASE WHEN code IS NULL THEN parsed END) AS type,
           parsed, nullif(header, 'None') AS subtype
    FROM (SELECT p_partkey AS id, {CODES_SQL} AS code, {HEADER_SQL} AS header,
                 CASE {HEADER_SQL} {' '.join(
                     f"WHEN '{h}' THEN '{t}'" for h, t in HEADERS.items() if t)} END AS parsed
          FROM part)"""
)
def resolved_types(spark, sf):
    return headed_parts(spark, sf).select(
        "id",
        resolve_type().alias("type"),
        infobox_type("infobox").alias("parsed"),
        infobox_subtype("infobox").alias("subtype"),
    )


SETTLED_SQL = f"""
    SELECT id, nullif(coalesce(rank, 0), 0) AS rank, {', '.join(
        f'coalesce({c}, 0) AS {c}' for c in (*COUNTS, 'fav_count', 'rate_count'))}
    FROM (SELECT c_custkey AS id, c_custkey % 7 AS rank, {RENAMED_SQL}, total AS rate_count
          FROM customer LEFT JOIN (
            SELECT o_custkey, {COUNTERS_SQL}, count(*) AS total
            FROM orders GROUP BY 1) ON o_custkey = c_custkey AND total > 9)"""


@check(SETTLED_SQL.replace("c_custkey % 7 AS rank", "CASE WHEN total > 9 THEN c_custkey % 7 END AS rank"))
def settled_counts(spark, sf):
    found = first_non_null(
        flatten_stats(statistics(spark, sf)),
        ["id"],
        ["rank", *COUNTS, "fav_count", "rate_count"],
        "order",
    ).where("rate_count > 9")
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    return settle_counts(customers.join(found, "id", "left"))


@check(
    f"""
    SELECT id AS iid, coalesce(name_cn, name) AS subjectname, rank FROM ({SUBJECTS_SQL})
    WHERE type = 'economy' AND (rank IS NOT NULL OR rate_count >= 30)""",
    "eligible_subjects",
)
def eligible_subjects_query(spark, sf):
    return subject_list(eligible_subjects(subjects(spark, sf), "economy", 30))


@check(
    f"""
    SELECT p_partkey AS id, p_name AS name, p_name || p_brand AS summary,
           nullif({HEADER_SQL}, 'None') AS subtype,
           '[{{"key": "中文名", "value": "' || p_name || '"}}]' AS infobox,
           nullif(CASE WHEN total IS NOT NULL THEN p_partkey % 7 END, 0) AS rank,
           coalesce(total, 0) AS rate_count, coalesce(wish, 0) AS wish_count,
           coalesce(wish + on_hold + dropped + doing + collect, 0) AS fav_count
    FROM part LEFT JOIN (
      SELECT o_custkey, {COUNTERS_SQL}, count(*) AS total FROM orders GROUP BY 1)
      ON o_custkey = p_partkey""",
    "enrich_subjects",
)
def enrich_subjects_query(spark, sf):
    subjects_ = enrich_subjects(statistics(spark, sf), headed_parts(spark, sf))
    return subjects_.select(
        "id", "name", "summary", "subtype", "infobox", "rank", "rate_count", "wish_count",
        "fav_count",
    )


ALIAS_SQL = """
    SELECT DISTINCT id, alias, lower(regexp_replace(alias, '[^\\p{L}\\p{N}_]', '', 'g'))
      AS alias_normalized
    FROM (SELECT p_partkey AS id, unnest([p_name,
            CASE p_size % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE p_brand END, EXTRA]) AS alias
          FROM part)
    WHERE alias <> ''"""


@check(ALIAS_SQL.replace(", EXTRA", ""), "subject_aliases")
def subject_aliases_query(spark, sf):
    return subject_aliases(headed_parts(spark, sf))


@check(ALIAS_SQL.replace("EXTRA", "upper(p_name), p_type || '!', p_brand"))
def subject_aliases_with_infobox(spark, sf):
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        localised_name().alias("name_cn"),
        F.concat(
            F.lit("{{Infobox Game\n|中文名= "), F.upper("p_name"), F.lit("\n|其他= z\n|别名={\n["),
            "p_type", F.lit("!]\n[x|"), "p_brand", F.lit("]\n}\n}}"),
        ).alias("infobox"),
    )
    return subject_aliases(parts, include_infobox=True)


@check(
    """
    SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem
    WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 5)"""
)
def known_records(spark, sf):
    near = table(spark, sf, "supplier").where("s_nationkey < 5")
    twice = near.union(near)  # duplicates on the known side must not multiply records
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return known_only(lines, twice, "l_suppkey", "s_suppkey")


@check(
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey >= 10 AND o_custkey < (SELECT max(c_custkey) FROM customer)"""
)
def id_range(spark, sf):
    largest = table(spark, sf, "customer").agg(F.max("c_custkey").alias("id_max"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    bounded = orders.crossJoin(F.broadcast(largest))  # one row
    return ids_between(bounded, "o_custkey", 10, F.col("id_max")).drop("id_max")


# ------------------------------------------------------------------------------ landed API answers
def user_answers(spark, sf):
    """Profiles of customers as API answers: some missing, some of a banned group."""
    key = F.col("c_custkey")
    body = F.to_json(
        F.struct(
            key.alias("id"),
            F.concat(F.lit("https://example.org/u/"), key).alias("url"),
            F.concat(F.lit("u"), key).alias("username"),
            F.col("c_name").alias("nickname"),
            F.lit("hello").alias("sign"),
            (F.col("c_nationkey") % 11).alias("usergroup"),
            F.struct(F.lit("x.png").alias("large")).alias("avatar"),
        )
    )
    missing = F.lit('{"request": "/user", "code": 404, "error": "Not Found"}')
    return table(spark, sf, "customer").select(
        F.when(key % 10 == 0, 404).otherwise(200).alias("status"),
        F.concat(F.lit("https://api.example.org/user/"), key).alias("url"),
        F.lit(None).cast("string").alias("redirect_from"),
        F.when(key % 10 == 1, missing).otherwise(body).alias("body"),
    )


USERS_SQL = """
    SELECT c_custkey AS id, 'https://example.org/u/' || c_custkey AS url,
           'u' || c_custkey AS username, c_name AS nickname, 'hello' AS sign,
           CAST(c_nationkey % 11 AS INTEGER) AS usergroup
    FROM customer WHERE c_custkey % 10 NOT IN (0, 1)"""


@check(USERS_SQL, "api_users")
def api_users_query(spark, sf):
    return api_users(user_answers(spark, sf))


@check(f"SELECT id, username FROM ({USERS_SQL}) WHERE usergroup NOT IN (4, 5)", "allowed_users")
def allowed_users_query(spark, sf):
    return allowed_users(api_users(user_answers(spark, sf))).select("id", "username")


def collection_answers(spark, sf):
    """Order lines of a customer as pages of a listing, one page per order."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag"
    )
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    entry = F.struct(
        F.col("l_partkey").alias("subject_id"),
        F.ceil(F.col("l_quantity") / 5).alias("rate"),
        F.array("l_returnflag").alias("tags"),
        F.lit(2).alias("type"),
        F.lit(False).alias("private"),
        F.struct(F.lit("x").alias("name")).alias("subject"),
    )
    pages = (
        lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
        .groupBy("o_custkey", "o_orderkey")
        .agg(F.collect_list(entry).alias("data"))
    )
    offset = F.col("o_orderkey") % 3 * 50
    total = F.size("data") + offset + F.when(F.col("o_orderkey") % 2 == 0, 7).otherwise(0)
    return pages.select(
        F.lit(200).alias("status"),
        F.concat(
            F.lit("https://api.example.org/v0/users/u"), "o_custkey",
            F.lit("/collections?limit=50&offset="), offset,
        ).alias("url"),
        F.lit(None).cast("string").alias("redirect_from"),
        F.to_json(F.struct("data", total.alias("total"))).alias("body"),
    )


@check(
    f"""
    SELECT u.username AS user_id, u.id AS user_order, l_partkey AS subject_id,
           CAST(ceil(l_quantity / 5) AS INTEGER) AS rate, l_returnflag AS tag
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN ({USERS_SQL}) u ON u.id = o_custkey
    WHERE usergroup NOT IN (4, 5)""",
    "api_collections",
)
def api_collections_query(spark, sf):
    rows = api_collections(collection_answers(spark, sf), api_users(user_answers(spark, sf)))
    return rows.select(
        "user_id", "user_order", "subject_id", "rate", F.array_join("tags", ",").alias("tag")
    )


@check(
    """
    SELECT 'u' || o_custkey AS user_id, o_orderkey % 3 * 50 AS "offset", n AS "rows",
           o_orderkey % 2 = 0 AS more,
           CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 3 * 50 + 50 END AS next_offset
    FROM orders JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)
      ON l_orderkey = o_orderkey""",
    "collection_pages",
)
def collection_pages_query(spark, sf):
    pages = collection_pages(collection_answers(spark, sf))
    return pages.select("user_id", "offset", "rows", "more", "next_offset")


@check(
    """
    SELECT p_partkey AS id, p_name AS name, CAST(p_size % 6 AS INTEGER) AS type,
           p_size::BIGINT AS wish, CASE WHEN p_partkey % 5 = 2 THEN p_partkey + 1000 ELSE p_partkey END
           AS "order"
    FROM part WHERE p_partkey % 5 NOT IN (0, 1, 3)""",
    "api_subjects",
)
def api_subjects_query(spark, sf):
    key = F.col("p_partkey")
    body = F.struct(
        key.alias("id"),
        (F.col("p_size") % 6).alias("type"),
        F.col("p_name").alias("name"),
        (key % 5 == 1).alias("locked"),
        F.lit("dropped").alias("summary"),
        F.struct(F.col("p_size").alias("wish")).alias("collection"),
    )
    base = F.lit("https://api.example.org/v0/subjects/")
    landed = table(spark, sf, "part").select(
        F.when(key % 5 == 0, 404).otherwise(200).alias("status"),
        F.concat(base, key).alias("url"),
        F.when(key % 5 == 2, F.concat(base, key + 1000)).alias("redirect_from"),
        F.when(key % 5 == 3, F.lit('{"error": "gone"}')).otherwise(F.to_json(body)).alias("body"),
    )
    found = api_subjects(landed)
    return found.select("id", "name", "type", F.col("collection.wish").alias("wish"), "order")
