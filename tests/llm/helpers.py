"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing extra columns."""

from __future__ import annotations

from pyspark.sql import Row

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 701}x{i % 13}" for i in range(30_000))
TEXTS = [
    "The quick brown fox jumps over the lazy dog, and then it rests.",
    "The quick brown fox jumps over the lazy dog, and then it rests.",
    None,
    "",
    " \n\t ",
    "Straße café naïve, it's DON'T 12345 ½",
    "日本語 text <|endoftext|> and more<|startoftext|>",
    "x" * 3_000,
    LONG,
    "a b c",
]


def documents(spark, texts=TEXTS, first=1, extra=False):
    rows = [(first + i, t, "en", "src0", len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame([Row(*r) for r in rows], DOCUMENTS)
    if extra:  # names that the operators use inside
        names = ["id", "key", "ids", "fp", "block", "word", "copy", "place", "length", "piece", "start", "score", "n_tokens"]
        names += ["_id", "_toxic", "_text", "__rows", "__spans", "__id", "__copy", "__score", "row", "n", "d", "k", "s", "spans"]
        for name in names:
            df = df.selectExpr("*", f"'clash' AS {name}")
    return df


def awkward(spark, extra=True):
    """The texts above, a row without an id, and one row twice."""
    df = documents(spark, extra=extra)
    nameless = df.where("doc_id = 1").withColumn("doc_id", df["doc_id"].cast("long") * None)
    return df.unionByName(nameless).unionByName(df.where("doc_id = 6"))


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.select(*columns).collect()), key=repr)
