import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tagmill.functions.dates import iso_date, parse_document_date, parse_site_date, stamp_date
from tagmill.functions.infobox import infobox_subtype, infobox_type
from tagmill.functions.text import (
    convert_by_table,
    map_chars,
    normalize_tag,
    phrases_named,
    slice_tokens,
    strip_controls,
    strip_nul,
)
from tagmill.functions.urls import next_page_url, page_number, pages_remaining, url_segment
from tagmill.operators.subjects import resolve_type

AS_OF = dt.date(2026, 12, 1)


def values(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["v"] for r in df.select("i", expression(F.col("t")).alias("v")).orderBy("i").collect()]


def test_normalize_tag(spark):
    found = values(spark, ["Sci-Fi", "a_B", "第１季！", "!!!", None], normalize_tag)
    assert found == ["scifi", "a_b", "第１季", "", None]


def test_controls_and_nul(spark):
    assert values(spark, ["a\x00b\n"], strip_nul) == ["ab\n"]
    assert values(spark, ["a\x00b\n\x1f\x20"], strip_controls) == ["ab "]


def test_script_conversion(spark):
    chars = {"畫": "画", "學": "学"}
    assert values(spark, ["動畫學"], lambda c: map_chars(c, chars)) == ["動画学"]
    phrases = {"ab": "1", "abc": "2", "c": "3", "x": ""}
    found = values(spark, ["abcab", "cabx", "zz", None], lambda c: map_chars(c, phrases))
    assert found == ["21", "31", "zz", None]
    table = spark.createDataFrame([("畫", "画")], "a string, b string")
    found = convert_by_table(spark.createDataFrame([(1, "動畫"), (2, None), (3, "")], "i int, t string"), "t", table, "a", "b")
    assert sorted(tuple(r) for r in found.collect()) == [(1, "動画"), (2, None), (3, "")]


def test_conversion_by_table_equals_conversion_by_dict(spark):
    phrases = {"ab": "1", "abc": "2", "c": "3", "x": "", "bcd": "9"}
    table = spark.createDataFrame(list(phrases.items()), "source string, target string")
    texts = ["abcab", "cabx", "zz", None, "", "abcd", "xxabcx", "abcab"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r.t for r in convert_by_table(df, "t", table).orderBy("i").collect()]
    assert got == values(spark, texts, lambda c: map_chars(c, phrases))
    assert convert_by_table(df, "t", table.where("source = 'none'")).count() == len(texts)


def test_long_phrases_multiply_no_text(spark):
    rng = random.Random(3)
    letters = "abcd"
    phrases = {"".join(rng.choices(letters, k=rng.randrange(1, 5))): f"<{i}>" for i in range(20)}
    phrases["q" * 1_000] = "Q"
    texts = ["".join(rng.choices(letters + "eq", k=rng.randrange(60))) for _ in range(50)] + ["a" + "q" * 1_001 + "b"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    table = spark.createDataFrame(list(phrases.items()), "source string, target string")
    got = [r.t for r in convert_by_table(df, "t", table).orderBy("i").collect()]
    assert got == values(spark, texts, lambda c: map_chars(c, phrases)) and "Qq" in got[-1]
    rows = table.withColumnsRenamed({"source": "_phrase", "target": "_target"})
    short = rows.where("length(_phrase) < 1000")
    named = df.select(F.col("t").alias("_text")).where("length(t) < 100").distinct()
    assert phrases_named(named, rows).count() == phrases_named(named, short).count()


@pytest.mark.parametrize(
    "text, site, document",
    [
        ("2009-4-5", "2009-04-05", "2009-04-05"),
        ("2009年4月", "2009-04-01", "2009-04-30"),
        ("2009年", "2009-01-01", "2009-12-01"),
        ("2010年2月30日", "2010-02-03", None),
        ("2010-13-05", "2010-01-01", None),
        ("2010-11-31", None, None),
        ("2011-2-29", None, None),
        ("4-31 2010", "2010-01-01", None),
        ("2010-4-31", "2010-04-03", None),
        ("seen 2012.12.31.", "2012-12-31", None),
        ("text", None, None),
        ("April 5, 2009", "2009-01-01", "2009-04-05"),
        ("5 Apr 2009", "2009-01-01", "2009-04-05"),
        ("May 2009", "2009-01-01", "2009-05-31"),
        ("2009/4", "2009-04-01", "2009-04-30"),
        (None, None, None),
    ],
)
def test_dates(spark, text, site, document):
    assert values(spark, [text], lambda c: iso_date(parse_site_date(c))) == [site]
    assert values(spark, [text], lambda c: iso_date(parse_document_date(c, AS_OF))) == [document]


def test_date_of_a_leap_day_is_null_in_other_years(spark):
    leap = dt.date(2024, 2, 29)
    found = values(spark, ["2009年", "2008年"], lambda c: iso_date(parse_document_date(c, leap)))
    assert found == [None, "2008-02-29"]
    assert values(spark, ["2009-4-5"], lambda c: stamp_date(parse_site_date(c))) == ["2009_04_05"]


def test_types_from_headers(spark):
    rows = [
        (None, "{{Infobox animanga/Manga\r\n", "book", "animanga/Manga"),
        (None, "{{Infobox animanga/TV\n", "anime", "animanga/TV"),
        (None, "{{Infobox Album\n", "music", "Album"),
        (None, "{{Infobox Game\n", "game", "Game"),
        (None, "{{Infobox real/Television\n", "real", "real/Television"),
        (None, "{{Infobox None\n", None, None),
        (None, "{{Infobox\n|a=b\n", None, None),
        (None, "", None, None),
        (None, None, None, None),
        (2, "{{Infobox Game\n", "anime", "Game"),
        (5, "{{Infobox Game\n", None, "Game"),
        (6, None, "real", None),
    ]
    df = spark.createDataFrame(
        [(i, r[0], r[1]) for i, r in enumerate(rows)], "i int, type int, infobox string"
    )
    found = df.select("i", resolve_type().alias("t"), infobox_subtype("infobox").alias("s")).orderBy("i")
    assert [(r["t"], r["s"]) for r in found.collect()] == [(r[2], r[3]) for r in rows]
    parsed = df.where("type = 2").select(infobox_type("infobox")).first()[0]
    assert parsed == "game"


def test_addresses(spark):
    assert values(spark, ["x/collect", "x/collect?page=2", "a=b=c"], next_page_url) == [
        "x/collect?page=2",
        "x/collect?page=3",
        "a?page=2",
    ]
    assert values(spark, ["x/collect", "x/collect?page=2"], page_number) == [1, 2]
    assert values(spark, ["a/b?c"], lambda c: url_segment(c, strip_query=True)) == ["b"]
    assert values(spark, ["24", "25"], lambda c: pages_remaining(F.lit(1), c.cast("int"))) == [
        False,
        True,
    ]


def test_token_slice(spark):
    found = values(spark, [" tags: a b ", "x", "a b c"], slice_tokens)
    assert found == [["a", "b"], [], []]


def test_words_in_brackets_of_any_length(spark):
    texts = {"2009-4-5 12:30 (Sunday)": "2009-04-05", "2009年4月（" + "春" * 40 + "）": "2009-04-30", "(x) May 2010 7:05": "2010-05-31"}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", iso_date(parse_document_date("t", dt.date(2020, 2, 29))).alias("d")).collect()
    assert {r["t"]: r["d"] for r in got} == texts


def test_a_date_is_read_by_one_search(spark):
    plan = spark.createDataFrame([("x",)], "t string").select(parse_site_date("t").alias("d"))._jdf.queryExecution().toString()
    assert plan.split("Physical Plan")[1].count("regexp_extract(") == 1
