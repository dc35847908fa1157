"""Text cleaning, dates, addresses, JSON fields."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tagmill.functions.dates import iso_date, parse_document_date, parse_site_date, stamp_date
from tagmill.functions.text import (
    convert_by_table,
    map_chars,
    normalize_tag,
    number_in,
    second_token_lower,
    slice_tokens,
    strip_controls,
    strip_nul,
    to_json_text,
)
from tagmill.functions.urls import (
    next_page_url,
    page_number,
    pages_remaining,
    trailing_id,
    url_id,
    url_segment,
)

from .base import check, table

AS_OF = dt.date(2026, 12, 1)
NORMAL_SQL = "lower(regexp_replace({}, '[^\\p{{L}}\\p{{N}}_]', '', 'g'))"


@check(
    f"""
    SELECT DISTINCT lang, word, {NORMAL_SQL.format('word')} AS normal
    FROM (SELECT lang, unnest(string_split(text, ' ')) AS word FROM documents)"""
)
def normalized_words(spark, sf):
    words = table(spark, sf, "documents").select("lang", F.explode(F.split("text", " ")).alias("word"))
    return words.distinct().withColumn("normal", normalize_tag("word"))


@check(
    """
    SELECT doc_id, regexp_replace(text, '[\\x00-\\x1f]', '', 'g') AS cleaned,
           replace(text || chr(7), chr(10), '') AS no_newline
    FROM documents"""
)
def stripped_text(spark, sf):
    # The given texts hold no NUL, so newlines stand in for it.
    text = F.col("text")
    marked = F.translate(F.concat(text, F.lit("\x07")), "\n", "\x00")
    return table(spark, sf, "documents").select(
        "doc_id", strip_controls(text).alias("cleaned"), strip_nul(marked).alias("no_newline")
    )


CHARACTERS = {"é": "e", "è": "e", "ê": "e", "ü": "u", "ñ": "n"}
PHRASES = {"the": "THE", "th": "T", "and": "&", "é": "e", "ér": "ER"}


@check("SELECT doc_id, translate(text, 'éèêüñ', 'eeeun') AS converted FROM documents")
def converted_characters(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", map_chars("text", CHARACTERS).alias("converted")
    )


@check(
    """
    SELECT p_partkey, replace(replace(replace(p_name, 'ring', '1'), 'red', '2'), 'rod', '33')
      AS converted
    FROM part"""
)
def converted_phrases(spark, sf):
    phrases = {"ring": "1", "red": "2", "rod": "33"}
    return table(spark, sf, "part").select(
        "p_partkey", map_chars("p_name", phrases).alias("converted")
    )


@check(
    """
    SELECT doc_id, replace(replace(replace(replace(replace(replace(text, 'ér', 'ER'), 'é', 'e'),
      'the', chr(1)), 'th', 'T'), 'and', '&'), chr(1), 'THE') AS converted
    FROM documents"""
)
def converted_document_phrases(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", map_chars("text", PHRASES).alias("converted")
    )


@check("SELECT p_partkey, upper(p_name) AS converted FROM part")
def converted_by_table(spark, sf):
    """The table has each distinct word of all names, so every word is one longest match."""
    part = table(spark, sf, "part")
    words = part.select(F.explode(F.split("p_name", " ")).alias("source")).distinct()
    phrases = words.withColumn("target", F.upper("source"))
    return convert_by_table(part.select("p_partkey", F.col("p_name").alias("converted")), "converted", phrases)


STYLES = ("yyyy-M-d", "yyyy年M月d日", "yyyy/M/d", "yyyy.M.d", "yyyy-M", "yyyy年M月", "yyyy年", "yyyy")
STRF = ("%Y-%-m-%-d", "%Y年%-m月%-d日", "%Y/%-m/%-d", "%Y.%-m.%-d", "%Y-%-m", "%Y年%-m月", "%Y年", "%Y")


def _dated_orders(spark, sf):
    shown = F.lit(None).cast("string")
    for i, style in enumerate(STYLES):
        shown = F.when(F.col("o_orderkey") % 8 == i, F.date_format("o_orderdate", style)).otherwise(
            shown
        )
    return table(spark, sf, "orders").select("o_orderkey", shown.alias("shown"))


@check(
    """
    SELECT o_orderkey, strftime(CASE WHEN o_orderkey % 8 < 4 THEN o_orderdate
        WHEN o_orderkey % 8 < 6 THEN date_trunc('month', o_orderdate)
        ELSE date_trunc('year', o_orderdate) END, '%Y-%m-%d') AS parsed,
      strftime(CASE WHEN o_orderkey % 8 < 4 THEN o_orderdate
        WHEN o_orderkey % 8 < 6 THEN date_trunc('month', o_orderdate)
        ELSE date_trunc('year', o_orderdate) END, '%Y_%m_%d') AS stamped
    FROM orders"""
)
def site_dates(spark, sf):
    shown = F.concat(F.lit("on "), F.col("shown"), F.lit(" at noon"))
    parsed = parse_site_date(shown)
    return _dated_orders(spark, sf).select(
        "o_orderkey", iso_date(parsed).alias("parsed"), stamp_date(parsed).alias("stamped")
    )


@check(
    """
    SELECT o_orderkey, CASE
        WHEN o_orderkey % 8 < 4 THEN strftime(o_orderdate, '%Y-%m-%d')
        WHEN o_orderkey % 8 < 6 THEN strftime(last_day(o_orderdate), '%Y-%m-%d')
        WHEN o_orderkey % 8 = 6 THEN strftime(o_orderdate, '%Y-12-01')
        ELSE strftime(o_orderdate, '%Y-12-31') END AS parsed
    FROM orders"""
)
def document_dates(spark, sf):
    return _dated_orders(spark, sf).select(
        "o_orderkey", iso_date(parse_document_date("shown", AS_OF)).alias("parsed")
    )


@check("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS parsed FROM orders")
def document_dates_dressed(spark, sf):
    """With a weekday in brackets, a time behind the date, or full-width digits."""
    day = F.date_format("o_orderdate", "yyyy年M月d日")
    shown = (
        F.when(F.col("o_orderkey") % 3 == 0, F.concat(day, F.lit("（日）")))
        .when(F.col("o_orderkey") % 3 == 1, F.concat(F.date_format("o_orderdate", "yyyy-M-d"), F.lit(" 9:30")))
        .otherwise(F.translate(day, "0123456789", "０１２３４５６７８９"))
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", iso_date(parse_document_date(shown, AS_OF)).alias("parsed")
    )


@check(
    """
    SELECT o_orderkey, strftime(CASE WHEN o_orderkey % 3 = 2 THEN last_day(o_orderdate)
      ELSE o_orderdate END, '%Y-%m-%d') AS parsed FROM orders"""
)
def document_dates_in_words(spark, sf):
    shown = (
        F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "MMMM d, yyyy"))
        .when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "d MMM yyyy"))
        .otherwise(F.date_format("o_orderdate", "MMMM yyyy"))
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", iso_date(parse_document_date(shown, AS_OF)).alias("parsed")
    )


@check(
    """
    SELECT page_id, string_split(url, '/')[-1] AS last_part, string_split(url, '/')[-2] AS before,
           string_split(string_split(url, '/')[-1], '?')[1] AS bare,
           TRY_CAST(string_split(url, '/')[-1] AS BIGINT) AS id,
           TRY_CAST(nullif(regexp_extract(url, '(\\d+)', 1), '') AS BIGINT) AS number,
           TRY_CAST(string_split(replace(url, '/', '_'), '_')[-1] AS BIGINT) AS trailing
    FROM pages"""
)
def url_parts(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id",
        url_segment("url").alias("last_part"),
        url_segment("url", 2).alias("before"),
        url_segment("url", strip_query=True).alias("bare"),
        url_id("url").alias("id"),
        number_in("url").alias("number"),
        trailing_id(F.translate("url", "/", "_")).alias("trailing"),
    )


@check(
    """
    SELECT page_id, following, page, 24 * page < length(html) AS more FROM (
      SELECT page_id, html,
        CASE WHEN len(parts) = 2 THEN parts[1] || '=' || CAST(TRY_CAST(parts[2] AS BIGINT) + 1 AS VARCHAR)
             ELSE parts[1] || '?page=2' END AS following,
        CASE WHEN len(parts) = 1 THEN 1 ELSE TRY_CAST(parts[2] AS BIGINT) END AS page
      FROM (SELECT page_id, html, string_split(replace(url, '&ref=x', ''), '=') AS parts
            FROM pages))"""
)
def next_pages(spark, sf):
    pages = table(spark, sf, "pages").withColumn("url", F.replace("url", F.lit("&ref=x"), F.lit("")))
    page = page_number("url")
    return pages.select(
        "page_id",
        next_page_url("url").alias("following"),
        page.alias("page"),
        pages_remaining(page, F.length("html")).alias("more"),
    )


@check(
    """
    SELECT conv_id, turn, array_to_string(words[3:-2], ' ') AS middle, lower(words[2]) AS second
    FROM (SELECT conv_id, turn, string_split(text, ' ') AS words FROM conversations)"""
)
def token_slices(spark, sf):
    return table(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        F.array_join(slice_tokens("text"), " ").alias("middle"),
        second_token_lower("text").alias("second"),
    )


@check(
    """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
           '{"name":"' || event_type || '","k":' || json_extract_string(props, '$.k')
             || ',"none":null}' AS text
    FROM events"""
)
def json_fields(spark, sf):
    events = table(spark, sf, "events")
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "long")
    fields = F.struct(
        F.col("event_type").alias("name"), k.alias("k"), F.lit(None).cast("int").alias("none")
    )
    return events.select("event_id", k.alias("k"), to_json_text(fields).alias("text"))
