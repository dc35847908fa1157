"""Held-out accuracy of the toxicity score, and preference pairs by hand."""

import math
import random

import duckdb
import numpy as np
import zstandard
from helpers import DOCUMENTS, awkward
from pyspark.sql import functions as F

from tagmill.llm import queries
from tagmill.llm.preferences import conversation_turns, format_preferences, swapped_last_answers
from tagmill.llm.toxicity import WINDOW, fit_toxicity, is_held_out, toxicity_score, train, windows, with_toxicity

TURNS = "conv_id long, turn long, role string, text string"


def corpus(spark, n=600):
    rng = random.Random(2)
    plain = [f"{a}{b}" for a in ("an", "the", "or", "wh", "st", "ing") for b in ("on", "at", "ed", "li", "er", "tion")]
    bad = ["zograt", "mufkrel", "vishnakt"]
    docs, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        text = [rng.choice(plain) for _ in range(rng.randrange(20, 200))]
        if toxic:
            for k in range(0, len(text), 12):
                text[k] = rng.choice(bad)
        docs.append((i, " ".join(text), "en", "s", 0))
        labels.append((i, 0, int(toxic)))
    return spark.createDataFrame(docs, DOCUMENTS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = corpus(spark)
    scored = with_toxicity(docs, labels).join(labels, "doc_id").where(is_held_out(F.col("doc_id"))).collect()
    right = np.mean([(r.score >= 0.5) == bool(r.toxic) for r in scored])
    assert len(scored) > 80 and right > 0.95
    assert all(0 <= r.score <= 1 for r in scored)


def test_windows_cut_no_word():
    for n in range(1, 60):
        text = [f"w{i}" + "a" * (i % 9) for i in range(n)]
        found = windows(" ".join(text))
        assert all(any(w.encode() in part.split() for part in found) for w in text)
        assert all(any(f"{a} {b}".encode() in part for part in found) for a, b in zip(text, text[1:]))
    long = windows("ab" * 500)
    assert max(map(len, long)) <= WINDOW and all(a[WINDOW // 2 :] == b[: WINDOW // 2] for a, b in zip(long, long[1:-1]))
    assert sum(map(len, long[::2])) >= 1_000 - WINDOW // 2 and windows(" \n") == windows("") == [b""]


def test_few_short_marks_in_long_texts():
    rng = random.Random(4)
    parts = ("an", "the", "or", "wh", "st", "ing", "on", "at", "ed", "li", "er", "tion")

    def text(marks):
        found = ["".join(rng.choices(parts, k=rng.choice((1, 2, 3)))) for _ in range(300)]
        for at in rng.sample(range(300), marks):
            found[at] = rng.choice(("moruk", "zubidt", "glompf", "vuckix"))
        return " ".join(found)

    model = train([text(rng.choice((2, 4, 8))) for _ in range(150)], [text(0) for _ in range(500)], 0.2)
    assert (model.scores([text(4) for _ in range(100)]) >= 0.5).mean() > 0.9
    assert (model.scores([text(0) for _ in range(200)]) >= 0.5).mean() < 0.05


def plain_windows(text):
    """Four words at every second word with the white space between them; long ones at every half window."""
    data = text.lower().encode()
    words, at = [], 0
    for word in data.split():
        at = data.index(word, at)
        words.append((at, at + len(word)))
        at += len(word)
    out = []
    for i in range(0, max(1, len(words) - 2) if words else 0, 2):
        group = words[i : i + 4]
        end = words[i + 4][0] if i + 4 < len(words) else len(data)
        window = data[group[0][0] : end]
        if len(window) <= WINDOW:
            out.append(window)
        else:
            out += [window[a : a + WINDOW] for a in range(0, len(window) - WINDOW // 2, WINDOW // 2)]
    return out or [b""]


def plain_score(model, text):
    """One window after the other, each by a compressor of its own; all features and the logistic sum in plain Python."""
    prime = bytes([*range(1, 9), *range(14, 32)]) + b" "
    distances = []
    for window in plain_windows(text):
        sizes = []
        for content in (model.ordinary, model.toxic):
            known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            kind = zstandard.ZstdCompressionParameters.from_level(9, write_content_size=0, write_checksum=0, write_dict_id=0)
            known.precompute_compress(compression_params=kind)
            sizes.append(len(zstandard.ZstdCompressor(dict_data=known, compression_params=kind).compress(prime + window)))
        distances.append(sizes[0] - sizes[1] - model.expected[0] - model.expected[1] * sizes[0])
    n, top = len(distances), sorted(distances, reverse=True)
    over = [d - model.bar for d in top if d > model.bar]
    means = [sum(top[:k]) / min(k, n) for k in (n, 1, 3, 8)]
    given = [*means, math.log(1 + len(over)), len(over) / n, math.log(1 + n), math.log(1 + sum(over))]
    total = model.weights[0]
    for value, mean, scale, weight in zip(given, model.mean, model.scale, model.weights[1:]):
        total += (value - mean) / scale * weight
    return 1 / (1 + math.exp(-max(-50.0, min(50.0, total))))


def test_scores_equal_the_plain_version(spark):
    docs, labels = corpus(spark, 240)
    model = fit_toxicity(docs, labels)
    texts = [r.text for r in docs.orderBy("doc_id").limit(8).collect()]
    texts += [texts[0], "", "one", "A  B\tc\n", "x" * 500, "\u00c4b " * 9 + "zograt mufkrel", " \n lead"]
    assert [windows(t) for t in texts] == [plain_windows(t) for t in texts]
    expected = [plain_score(model, t) for t in texts]
    assert np.allclose(model.scores([*texts, None]), [*expected, plain_score(model, "")], rtol=1e-9, atol=1e-12)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    scored = with_toxicity(rows, labels.limit(0)).collect()  # nothing to learn from: one score for all
    assert {r.score for r in scored} == {0.0}
    found = rows.select("doc_id", toxicity_score("text", model).alias("score")).orderBy("doc_id").collect()
    assert np.allclose([r.score for r in found], expected, rtol=1e-9, atol=1e-12)


def test_labels_of_held_out_rows_teach_nothing(spark):
    docs, labels = corpus(spark)
    turned = labels.withColumn("toxic", F.when(is_held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = fit_toxicity(docs, labels), fit_toxicity(docs, turned)
    assert a.toxic == b.toxic and np.array_equal(a.weights, b.weights)


def test_awkward_rows_and_missing_labels(spark):
    df = awkward(spark)
    docs, labels = corpus(spark)
    model = fit_toxicity(docs, labels.unionByName(spark.createDataFrame([(None, 0, 1), (1, 0, None)], labels.schema)))
    rows = df.select("doc_id", toxicity_score("text", model).alias("s")).collect()
    assert len(rows) == df.count() and all(0 <= r.s <= 1 for r in rows)
    nothing = with_toxicity(df.drop("score"), labels.where("toxic > 1"))
    assert {r.score for r in nothing.collect()} == {0.0}
    assert with_toxicity(docs.where("doc_id < 0"), labels).count() == 0


def test_preferences_by_hand(spark):
    rows = [
        (0, 0, "user", "Hi"), (0, 1, "assistant", "Yes"), (0, 2, "user", "So?"),
        (1, 0, "system", "S"), (1, 2, "assistant", "No"), (1, 1, "user", None),
        (2, 0, "user", "alone"), (4, 0, "assistant", ""), (None, 0, "user", "x"), (5, 0, "user", "q"),
    ]
    out = format_preferences(swapped_last_answers(conversation_turns(spark.createDataFrame(rows, TURNS))))
    got = {r.conv_id: r for r in out.collect()}
    assert len(got) == 6
    turn = lambda role, text: f"<|im_start|>{role}\n{text}<|im_end|>\n"
    assert got[0].prompt == turn("user", "Hi") and got[0].common_turns == 1
    assert (got[0].chosen_text, got[0].rejected_text) == (turn("assistant", "Yes"), turn("assistant", "No"))
    assert [tuple(s) for s in got[0].chosen_spans] == [(22, 22 + 3 + 11)]
    assert got[1].prompt == turn("system", "S") + turn("user", "") and got[1].rejected_text == turn("assistant", "Yes")
    assert got[2].chosen_text == got[2].rejected_text == "" and got[2].prompt == turn("user", "alone")
    assert got[4].chosen_text == turn("assistant", "") and got[4].rejected_text == "" and got[4].rejected_spans == []
    assert got[None].prompt == turn("user", "x")


def test_preferences_of_null_and_equal_sides(spark):
    kind = "chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>, prompt2 string"
    pairs = spark.createDataFrame([(None, [("user", "a")], "x"), ([("user", "a")], [("user", "a")], "y"), (None, None, "z")], kind)
    got = {r.prompt2: r for r in format_preferences(pairs).collect()}
    assert got["x"].common_turns == 0 and got["x"].chosen_text == "" and got["x"].rejected_text != ""
    assert got["y"].common_turns == 1 and got["y"].chosen_text == got["y"].rejected_text == ""
    assert got["z"].prompt == ""
    assert format_preferences(pairs.where("prompt2 = 'none'")).count() == 0


def test_preferences_sql_agrees_on_nulls(spark, tmp_path):
    rows = [
        (4, 0, "user", "hi"), (4, None, "user", "early"), (4, 1, "assistant", None), (4, 1, "assistant", "yes"), (4, 2, None, "?"),
        (5, 0, "user", None), (5, 0, "user", "b"), (5, 1, "assistant", "no"), (8, None, None, None), (None, 0, "user", "x"),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    table.write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op10_preferences(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = con.execute(queries.SQL["op10_preferences"]).fetchall()
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
