"""Extraction from pages: the given raw pages, and catalogue pages composed from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagmill.functions.html import child, deep
from tagmill.operators.extract import (
    extract_pages,
    forward_fill,
    home_links,
    html_pages,
    page_friends,
    page_home_users,
    page_indexes,
    page_links,
    page_records,
    page_subjects,
    page_users,
    rule,
)

from tagmill.functions.urls import url_segment
from tagmill.session import shuffle_partitions

from .base import check, table

def _none():
    return F.lit(None).cast("string")


def landed(pages):
    """Pages as they would lie in files: spread evenly, not by how small the test data is."""
    return pages.repartition(shuffle_partitions(pages.sparkSession), "url")


def _t(text):
    return F.lit(text)


# ------------------------------------------------------------------------------- given raw pages
@check(
    """
    SELECT page_id,
           replace(replace(replace(regexp_extract(html, '<title>([^<]*)', 1), '&lt;', '<'),
             '&gt;', '>'), '&amp;', '&') AS title,
           len(regexp_extract_all(html, '<a href="')) AS links
    FROM pages"""
)
def page_titles(spark, sf):
    rules = {
        "title": rule(deep("title")),
        "links": rule(deep("a"), take="count"),
    }
    return extract_pages(table(spark, sf, "pages"), rules).select("page_id", "title", "links")


@check(
    """
    SELECT page_id, string_split(string_split(url, '/')[-1], '?')[1] AS state,
           string_split(url, '/')[-2] AS before, NULL::VARCHAR AS origin,
           regexp_extract(html, '<h1>([^<]*)', 1) <> '' AS titled
    FROM pages"""
)
def landed_pages(spark, sf):
    rules = {"heading": rule(deep("h1"), default="")}
    found = extract_pages(html_pages(table(spark, sf, "pages")), rules)
    return found.select(
        "page_id",
        url_segment("url", strip_query=True).alias("state"),
        url_segment("url", 2).alias("before"),
        F.col("redirect_from").alias("origin"),
        (F.col("heading") != "").alias("titled"),
    )


@check(
    """
    SELECT page_id, unnest(range(len(links)))::BIGINT AS pos, unnest(links) AS link
    FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS links FROM pages)"""
)
def page_hrefs(spark, sf):
    found = extract_pages(table(spark, sf, "pages"), {"links": rule(deep("a"), take="@@href")})
    return found.select("page_id", F.posexplode("links").alias("pos", "link")).withColumn(
        "pos", F.col("pos").cast("long")
    )


@check(
    """
    SELECT page_id, regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang,
           regexp_matches(html, '<div class="ad">') AS has_ad
    FROM pages"""
)
def page_attributes(spark, sf):
    rules = {
        "lang": rule(child("html"), take="@lang"),
        "has_ad": rule(deep("div", class_="ad"), take="any"),
    }
    return extract_pages(table(spark, sf, "pages"), rules).select("page_id", "lang", "has_ad")


# ----------------------------------------------------------------------------------------- users
def profile_pages(spark, sf):
    """Profiles of customers; some without a header, some without activity, some redirected."""
    key = F.col("c_custkey")
    head = F.when(key % 7 == 0, _t("<p>gone</p>")).otherwise(_t('<div id="headerProfile"></div>'))
    timeline = F.when(key % 5 == 0, _t("")).otherwise(_t("<li>seen<li>wished"))
    html = F.concat(
        _t("<html><body><div><div></div><div>"), head,
        _t("</div><div><div><div><h1><div>x</div><div><a>"), F.col("c_name"), _t("\x07</a><small>@"),
        key, _t("</small></div></h1></div></div></div><div><div><div><div><div><ul><li><span>in</span>"
                "<span>2009-4-"), key % 28 + 1, _t(" joined</span></li></ul></div></div></div></div></div>"),
        _t('<ul class="timeline">'), timeline, _t("</ul></div></body>"),
    )
    base = _t("https://example.org/user/")
    return table(spark, sf, "customer").select(
        F.concat(base, key).alias("url"),
        F.when(key % 3 == 0, F.concat(base, key + 5000)).alias("redirect_from"),
        html.alias("html"),
    )


PROFILES_SQL = """
    SELECT CASE WHEN c_custkey % 3 = 0 THEN c_custkey + 5000 ELSE c_custkey END AS uid,
           CAST(c_custkey AS VARCHAR) AS name, c_name AS nickname,
           '2009-04-' || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') AS joined
    FROM customer"""


@check(f"{PROFILES_SQL} WHERE c_custkey % 7 <> 0 AND c_custkey % 5 <> 0", "page_users")
def page_users_query(spark, sf):
    return page_users(landed(profile_pages(spark, sf))).select(
        "uid", "name", "nickname", F.date_format("joindate", "yyyy-MM-dd").alias("joined")
    )


def home_pages(spark, sf):
    key = F.col("c_custkey")
    banner = F.when(key % 6 == 0, _t('<div class="tipIntro">closed</div>')).otherwise(_t(""))
    lists = F.when(key % 2 == 0, _t('<div id="anime"></div><div id="real"></div>')).otherwise(
        _t('<div id="book"></div>')
    )
    html = F.concat(
        _t('<body><div id="headerProfile"><div class="headerContainer"><div class="inner"><a>'),
        F.col("c_name"), _t("</a></div></div></div>"), banner,
        _t('<div id="user_home"><div class="user_box clearit"><ul><li><span>in</span><span>2009-4-'),
        key % 28 + 1, _t(" joined</span></ul></div></div>"), lists, _t("</body>"),
    )
    return table(spark, sf, "customer").select(
        F.concat(_t("https://example.org/user/"), key).alias("url"),
        F.when(key % 3 == 0, F.concat(_t("https://example.org/user/"), key + 5000)).alias(
            "redirect_from"
        ),
        html.alias("html"),
    )


HOMES_SQL = (
    f"SELECT uid, name, nickname, joined FROM ({PROFILES_SQL} WHERE c_custkey % 6 <> 0) "
    "WHERE name NOT IN ('7', '8')"
)


@check(HOMES_SQL, "page_home_users")
def page_home_users_query(spark, sf):
    users = page_home_users(landed(home_pages(spark, sf)), blocked=("7", "8"))
    return users.select(
        "uid", "name", "nickname", F.date_format("joindate", "yyyy-MM-dd").alias("joined")
    )


@check(
    f"""
    SELECT uid, '/' || unnest(CASE WHEN CAST(name AS BIGINT) % 2 = 0 THEN ['anime', 'real']
                              ELSE ['book'] END) || '/list/' || name AS link
    FROM ({HOMES_SQL})""",
    "home_links",
)
def home_links_query(spark, sf):
    return home_links(page_home_users(landed(home_pages(spark, sf)), blocked=("7", "8")))


# ----------------------------------------------------------------------------------- lists, friends
def _order_lines(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag"
    )
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])


def index_pages(spark, sf):
    """A user-made list per order: its lines in order of part and line number."""
    entry = F.struct("l_partkey", "l_linenumber")
    grouped = (
        _order_lines(spark, sf)
        .groupBy("o_orderkey", "o_custkey", "o_orderdate")
        .agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    )
    listed = F.transform("entries", lambda e: F.concat(_t('<li id="item_'), e["l_partkey"], _t('">')))
    liked = F.when(
        F.col("o_orderkey") % 2 == 0, F.concat(_t("<span>"), F.col("o_orderkey") % 9, _t("</span>"))
    ).otherwise(_t(""))
    html = F.concat(
        _t('<div id="columnSubjectBrowserA"><div><a href="/user/u'), "o_custkey",
        _t('">x</a><span><span>'), F.date_format("o_orderdate", "yyyy-M-d"), _t(" made</span>"),
        liked, _t("</span></div><ul>"), F.array_join(listed, ""), _t("</ul></div>"),
    )
    bare = F.when(F.col("o_orderkey") % 11 == 0, _t("<p>nothing</p>")).otherwise(html)
    return grouped.select(
        F.concat(_t("https://example.org/index/"), "o_orderkey").alias("url"),
        _none().alias("redirect_from"),
        bare.alias("html"),
    )


@check(
    """
    SELECT o_orderkey AS indexid, 'u' || o_custkey AS creator,
           CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 9 ELSE 0 END AS favourite,
           strftime(o_orderdate, '%Y-%m-%d') AS made, items
    FROM orders JOIN (
      SELECT l_orderkey, string_agg(l_partkey, ';' ORDER BY l_partkey, l_linenumber) AS items
      FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
    WHERE o_orderkey % 11 <> 0""",
    "page_indexes",
)
def page_indexes_query(spark, sf):
    return page_indexes(landed(index_pages(spark, sf))).select(
        "indexid",
        "creator",
        "favourite",
        F.date_format("date", "yyyy-MM-dd").alias("made"),
        F.array_join(F.col("items").cast("array<string>"), ";").alias("items"),
    )


def record_pages(spark, sf):
    """A list page per order: its lines with date, and tags, stars and a comment for some."""

    def part(condition, *pieces):
        return F.when(condition, F.concat(*pieces)).otherwise(_t(""))

    rate = F.ceil(F.col("l_quantity") / 5)
    item = F.concat(
        _t('<li id="item_'), "l_partkey", _t('"><div><p class="collectInfo"><span class="tip_j">'),
        F.date_format("o_orderdate", "yyyy-M-d"), _t("</span>"),
        part(F.col("l_linenumber") % 2 == 0,
             _t('<span class="tip"> tags: '), "l_returnflag", _t(" x "), _t("</span>")),
        part(rate > 3, _t('<span class="starstop-s"><span class="starlight stars'), rate,
             _t('"></span></span>')),
        _t("</p>"),
        part(F.col("l_linenumber") == 3, _t('<div class="text">said &amp; '), "l_suppkey", _t("</div>")),
        _t("</div>"),
    )
    grouped = (
        _order_lines(spark, sf)
        .groupBy("o_orderkey", "o_custkey")
        .agg(F.collect_list(item).alias("items"))
    )
    html = F.concat(
        _t('<body><ul class="navSubTabs"><li><a class="focus" href="/anime/list/u'), "o_custkey",
        _t('/collect"><span>seen ('), F.col("o_orderkey") % 100,
        _t(')</span></a></li><li><a href="/wish"><span>wished</span></a></ul>'
           '<ul id="browserItemList">'),
        F.array_join("items", ""), _t("</ul>"),
    )
    return grouped.select(
        F.concat(
            _t("https://example.org/anime/list/u"), "o_custkey", _t("/collect?page="),
            F.col("o_orderkey") % 4 + 1,
        ).alias("url"),
        _none().alias("redirect_from"),
        html.alias("html"),
    )


@check(
    """
    SELECT 'u' || o_custkey AS uid, l_partkey AS iid, 'anime' AS typ, 'collect' AS state,
           strftime(o_orderdate, '%Y-%m-%d') AS added,
           CASE WHEN ceil(l_quantity / 5) > 3 THEN ceil(l_quantity / 5) END::INTEGER AS rate,
           CASE WHEN l_linenumber % 2 = 0 THEN l_returnflag || ',x' END AS tags,
           CASE WHEN l_linenumber = 3 THEN 'said & ' || l_suppkey END AS comment
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "page_records",
)
def page_records_query(spark, sf):
    return page_records(landed(record_pages(spark, sf))).select(
        "uid",
        "iid",
        "typ",
        "state",
        F.date_format("adddate", "yyyy-MM-dd").alias("added"),
        "rate",
        F.array_join("tags", ",").alias("tags"),
        "comment",
    )


@check(
    """
    WITH p AS (SELECT o_orderkey AS k, o_orderkey % 4 + 1 AS page,
        'https://example.org/anime/list/u' || o_custkey || '/collect?page=' AS base,
        '/anime/list/u' || o_custkey || '/collect' AS tab
      FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem))
    SELECT base || page AS url, 'state' AS kind, tab AS link FROM p
    UNION ALL SELECT base || page, 'state', '/wish' FROM p
    UNION ALL SELECT base || page, 'next', base || (page + 1) FROM p WHERE 24 * page < k % 100""",
    "page_links",
)
def page_links_query(spark, sf):
    return page_links(landed(record_pages(spark, sf))).drop("pos")


@check(
    """
    SELECT 'u' || o_custkey AS "user", 's' || l_suppkey AS friend
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "page_friends",
)
def page_friends_query(spark, sf):
    link = F.concat(_t('<li><div><a href="/user/s'), "l_suppkey", _t('">x</a></div>'))
    grouped = _order_lines(spark, sf).groupBy("o_orderkey", "o_custkey").agg(
        F.collect_list(link).alias("links")
    )
    pages = grouped.select(
        F.concat(_t("https://example.org/user/u"), "o_custkey", _t("/friends")).alias("url"),
        _none().alias("redirect_from"),
        F.concat(
            _t('<a href="/out">o</a><ul id="memberUserList">'), F.array_join("links", ""), _t("</ul>")
        ).alias("html"),
    )
    return page_friends(landed(pages))


# --------------------------------------------------------------------------------------- subjects
def subject_pages(spark, sf):
    """A page per part: facts with and without links, an alias, relations with repeated labels."""
    key = F.col("p_partkey")

    def related(label, number):
        opening = _t(f'<li class="sep"><span>{label}</span>') if label else _t("<li>")
        return F.concat(opening, _t('<a class="title" href="/subject/'), number, _t('">x</a></li>'))

    again = F.when(key % 2 == 0, related("前传", key + 4)).otherwise(_t(""))
    volumes = F.when(
        key % 4 == 0,
        F.concat(_t('<ul class="browserCoverSmall clearit"><li><a href="/subject/'), key + 9,
                 _t('">v</a></ul>')),
    ).otherwise(_t(""))
    html = F.concat(
        _t('<body><div id="headerSubject"><h1><a title="'),
        F.when(key % 3 == 0, _t("")).otherwise(F.col("p_name")), _t('">'), F.col("p_brand"),
        _t('</a></h1></div><div class="global_score"><div><small>Site '),
        F.col("p_type"), _t(' rank</small></div></div><div class="infobox"><ul><li><span>导演: </span>'
                            '<a href="/person/'), key, _t('">a</a> and <a href="/person/'), key + 1,
        _t('">b</a></li><li><span>别名: </span>'), F.col("p_name"), _t("!</li><li><span>集数: </span>12"
           '</li></ul></div><ul class="browserCoverMedium clearit">'),
        related("前传", key + 1), related(None, key + 2), related("续集", key + 3), again,
        _t("</ul>"), volumes,
    )
    page = F.when(key % 13 == 0, _t("<p>locked</p>")).otherwise(html)
    base = _t("https://example.org/subject/")
    return table(spark, sf, "part").select(
        F.concat(base, key).alias("url"),
        F.when(key % 5 == 0, F.concat(base, key + 7000)).alias("redirect_from"),
        page.alias("html"),
    )


@check(
    """
    SELECT p_partkey AS subjectid, lower(p_type) AS subjecttype,
           CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE p_name END AS subjectname,
           CASE WHEN p_partkey % 5 = 0 THEN p_partkey + 7000 ELSE p_partkey END AS "order",
           p_name || '!' AS alias, '导演:' || p_partkey || ',' || (p_partkey + 1) AS staff,
           CASE WHEN p_partkey % 2 = 0 THEN '前传:' || (p_partkey + 4)
                ELSE '前传:' || (p_partkey + 1) || ',' || (p_partkey + 2) END
           || CASE WHEN p_partkey % 4 = 0 THEN ';单行本:' || (p_partkey + 9) ELSE '' END
           || ';续集:' || (p_partkey + 3) AS relations
    FROM part WHERE p_partkey % 13 <> 0""",
    "page_subjects",
)
def page_subjects_query(spark, sf):
    def flat(column):
        pairs = F.transform(
            F.map_entries(column), lambda e: F.concat(e["key"], _t(":"), F.array_join(e["value"], ","))
        )
        return F.array_join(F.array_sort(pairs), ";")

    return page_subjects(landed(subject_pages(spark, sf))).select(
        "subjectid",
        "subjecttype",
        "subjectname",
        "order",
        F.array_join("alias", ",").alias("alias"),
        flat("staff").alias("staff"),
        flat("relations").alias("relations"),
    )


@check(
    """
    SELECT l_orderkey, l_linenumber, l_partkey,
           last_value(CASE WHEN l_quantity > 25 THEN l_returnflag END IGNORE NULLS) OVER (
             PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_extendedprice
             ROWS UNBOUNDED PRECEDING) AS filled
    FROM lineitem""",
    "forward_fill",
)
def forward_fill_query(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.when(F.col("l_quantity") > 25, F.col("l_returnflag")).alias("label"),
        F.struct("l_linenumber", "l_partkey", "l_extendedprice").alias("pos"),
    )
    return forward_fill(lines, ["l_orderkey"], "pos", "label").drop("label", "pos")
