"""Spelling variants, periodic runs and source mixing, against brute force."""

import hashlib
import random
from collections import Counter
from fractions import Fraction
from itertools import combinations
from zlib import crc32

import numpy as np
import pytest
from helpers import LONG, awkward, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from tagmill.llm import queries
from tagmill.llm.mixing import mix_sources, mixed_texts, permuted
from tagmill.llm.periods import periodic_runs, runs_of, word_numbers
from tagmill.llm.variants import letter_runs, letter_vectors, near_words, signatures, spelling_variants


# --------------------------------------------------------------------------- periodic runs
def plain_runs(words, least=6, repeats=4):
    n, out = len(words), []
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            stretch = words[i : i + length]
            smaller = any(all(stretch[x] == stretch[x + p] for x in range(length - p)) for p in range(1, q))
            if j > i and length >= max(least, repeats * q) and not smaller:
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


repetitive = st.lists(
    st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=9), st.integers(1, 7)), max_size=6
).map(lambda parts: [w for part, times in parts for w in part * times])


@settings(max_examples=200, deadline=None)
@given(st.lists(repetitive, min_size=1, max_size=3), st.sampled_from([(6, 4), (2, 3), (11, 3), (30, 5), (40, 3)]))
def test_runs_equal_brute_force(texts, limits):
    _, numbers, sizes = word_numbers([" ".join(t).encode() for t in texts])
    want, at = [], 0
    for text in texts:
        want += [(a + at, n, q) for a, n, q in plain_runs(text, *limits)]
        at += len(text)
    assert [tuple(r) for r in runs_of(numbers, int(sizes.max()), *limits).tolist()] == want


def plain_periods_row(doc_id, text):
    words = [] if text is None else text.encode().split()
    h = 1 if doc_id is None else crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else (None,) * 3
    dropped = {i for a, n, q in runs for i in range(a + q, a + n)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    listed = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_periods_query_equals_brute_force(spark, tmp_path):
    draw = random.Random(3)
    texts = [" ".join(draw.choices("abcdefgh", k=draw.randint(0, 150))) for _ in range(120)]
    texts += [None, "", " \n\t", "la " * 50, "ab ab ab ab ab ab c " * 9, "x\x0by\x0cx  y\r\nx  y", "Straße " * 7]
    rows = documents(spark, texts, extra=True)
    nameless = rows.where("doc_id = 124").withColumn("doc_id", rows["doc_id"] * None)
    rows.unionByName(nameless).unionByName(rows.where("doc_id = 125")).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_periodic_runs(spark, str(tmp_path))
    want = [plain_periods_row(1 + i, t) for i, t in enumerate(texts)]
    want += [plain_periods_row(None, texts[123]), want[124]]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert sum(r[1] > 0 for r in want) > 5


def test_periods_of_awkward_and_empty_tables(spark):
    rows = periodic_runs(awkward(spark)).collect()
    assert len(rows) == 12 and {r["n_words"] for r in rows if r["doc_id"] in (3, 4, 5)} == {0}
    assert all(r["collapsed"] == "" and r["runs"] == [] for r in rows if r["doc_id"] in (3, 4, 5))
    assert periodic_runs(documents(spark, [])).collect() == []
    long = periodic_runs(documents(spark, ["z " * 300_000, LONG + " " + LONG])).orderBy("doc_id").collect()
    assert [tuple(r) for r in long[0]["runs"]] == [(0, 300_000, 1)] and long[0]["collapsed"] == "z"
    assert long[1]["runs"] == []  # 9,113 words come three times and a part, and again from the beginning
    with pytest.raises(ValueError):
        periodic_runs(documents(spark), repeats=2)


# --------------------------------------------------------------------------- spelling variants
def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_variants(counts, times=10):
    near = {w: [] for w in counts}
    for a, b in combinations(counts, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    best = {w: min(near[w], key=lambda x: (-counts[x], x)) for w in counts if near[w]}
    form = {w: f for w, f in best.items() if counts[f] >= times * counts[w]}
    out = []
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), counts[form[w]] if w in form else None))
    return sorted(out, key=repr)


def varied(draw, letters, number):
    words = ["".join(draw.choices(letters, k=draw.randint(7, 11))) for _ in range(number)]
    for _ in range(4 * number):
        word = draw.choice(words)
        at = draw.randrange(len(word))
        words.append(draw.choice([word[:at] + word[at + 1 :], word[:at] + draw.choice(letters) + word[at:], word[:at] + draw.choice(letters) + word[at + 1 :]]))
    return {w: draw.choice([2, 3, 20, 31, 400, 5_000, 60_000]) for w in words}


@pytest.mark.parametrize("letters", ["ab", "abcdeé", "abcdefghijklmnopqrstuvwxyzàÿ÷"])
def test_variants_equal_brute_force(spark, letters):
    counts = varied(random.Random(5), letters, 60)
    counts |= {"x" * n: 2 * 11**k for k, n in enumerate((3_000, 3_001, 3_002, 3_003, 3_004))}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = sorted(map(tuple, spelling_variants(words).collect()), key=repr)
    assert got == plain_variants(counts)
    assert sum(r[2] != r[1] for r in got if r[1]) > 0  # chains of forms


def test_large_signature_groups_are_tiled(spark, monkeypatch, tmp_path):
    from tagmill.llm import variants

    monkeypatch.setattr(variants, "TILE_ROWS", 8)
    counts = varied(random.Random(6), "abc", 50)
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {(r["word"], r["near"]) for r in near_words(words, str(tmp_path)).collect()}
    assert got == {(a, b) for a in counts for b in counts if one_edit(a, b)}


@settings(max_examples=300, deadline=None)
@given(st.text("abcé", min_size=1, max_size=12), st.data())
def test_words_one_edit_apart_share_a_signature(word, data):
    at, letter = data.draw(st.integers(0, len(word) - 1)), data.draw(st.sampled_from("abcdé"))
    for other in (word[:at] + word[at + 1 :], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :]):
        held, sketch = letter_vectors([word, other])
        assert (signatures(held)[0] == signatures(held)[1]).any()
        assert int(sketch[0] ^ sketch[1]).bit_count() <= 4
    held, _ = letter_vectors([word, word[::-1]])
    assert (held[0] == held[1]).all()


def plain_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        run = ""
        for c in (text or "") + " ":
            if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c.lower() if c < "\u0080" else c
                continue
            if run:
                h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                counts[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
            run = ""
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def test_variants_query_equals_brute_force(spark, tmp_path):
    draw = random.Random(7)
    names = ["Mountain", "fountain", "ÉLÉPHANT", "elephant", "besançon", "×÷×÷×÷×÷", "shortest", "shortes", "rivière"]
    texts = [" ".join(draw.choices(names, k=60)) + ", short1word" for _ in range(300)] + [None, "", LONG[:50], "12 34"]
    rows = documents(spark, texts, extra=True)
    rows.unionByName(rows.where("doc_id = 9").withColumn("doc_id", rows["doc_id"] * None)).write.parquet(f"{tmp_path}/documents.parquet")
    want = plain_variants(plain_words([*enumerate(texts, 1), (None, texts[8])]))
    got = sorted(map(tuple, queries.op11_spelling_variants(spark, str(tmp_path)).collect()), key=repr)
    assert got == want and any(r[1] for r in want)


def test_letter_runs_and_empty_words(spark):
    rows = spark.createDataFrame([("Éa-B1ü×", 1), (None, 2), ("", 3)], "t string, i int").select("i", letter_runs("t").alias("r"))
    assert {r["i"]: r["r"] for r in rows.collect()} == {1: ["Éa", "b", "ü×"], 2: [], 3: []}
    assert spelling_variants(spark.createDataFrame([], "word string, n long")).collect() == []
    with pytest.raises(ValueError):
        spelling_variants(spark.createDataFrame([("a", 1)], "word string, n long"), times=1)


# --------------------------------------------------------------------------- mixing
def plain_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        shared = sum(weight[s] for s in names if s not in full) or 1
        target = {s: most * sizes[s] if s in full else rest * weight[s] / shared for s in names}
        above = {s for s in names if s not in full and target[s] > most * sizes[s]}
        if not above:
            return target
        full |= above


def sourced(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, source string, key string, size int")


def mixture(spark, seed=1):
    draw = random.Random(seed)
    rows = []
    for i in range(400):
        source = draw.choice(["a", "a", "a", "b", "B", "é", None, "tiny"])
        size = draw.choice([0, 1, 3, 40]) if source == "tiny" and i % 50 else draw.randint(0, 300)
        rows.append((i, " ".join(f"w{i}_{k}" for k in range(0 if source == "tiny" and i > 40 else size)), source))
    return rows + [(7, "again and again", "a"), (7, "again and again", "a"), (None, "no key here", "b"), (500, None, "b"), (501, "", "z")]


@pytest.mark.parametrize("block", [1, 7, 64, 100_000])
def test_mix_meets_its_targets(spark, block):
    rows = mixture(spark)
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    want, taken = plain_targets(sizes), Counter()
    mix = mix_sources(sourced(spark, rows), block=block, shard_blocks=3 if block > 1 else 50)
    got = mix.taken().collect()
    assert sorted((r["key"], r["size"]) for r in got if r["key"] is not None) == sorted(
        (k, len((t or "").split())) for k, t, _ in rows if k is not None
    )
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]], rel=1e-12)
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - t) <= 0.5 + 1e-6 for s, t in want.items())
    assert want["tiny"] == 3 * sizes["tiny"]  # one source is full


def test_mix_rows_are_whole_blocks_and_texts(spark):
    rows = [r for r in mixture(spark) if r[0] is not None and r[0] != 7]
    docs = sourced(spark, rows)
    mix = mix_sources(docs, block=16, shard_blocks=20)
    placed = mix.rows().toPandas()
    slots = mix.slots.toPandas()
    assert slots.groupby(["rank", "slot"]).size().max() == 1
    assert slots.groupby(["rank", "shard"])["slot"].agg(lambda s: s.max() - s.min() + 1 == len(s)).all()
    words = placed.groupby(["rank", "slot"])["words"].sum()
    assert (words == slots.set_index(["rank", "slot"])["words"].loc[words.index]).all()
    per_document = placed.groupby(["rank", "first"])["words"].sum()
    taken = mix.taken().toPandas()
    assert per_document.sum() == taken["taken"].sum() > 0
    # Within one pass over a source no block comes twice.
    size = mix.targets.toPandas().set_index("rank")["source_size"]
    slots["turn"] = slots["slot"] // -(-slots["rank"].map(size) // 16)
    assert slots.groupby(["rank", "turn"])["block"].agg(lambda b: b.is_unique).all()
    texts = {(r["rank"], r["slot"]): r["text"].split() for r in mixed_texts(mix, docs).collect()}
    of = {i: (t or "").split() for i, t, _ in rows}
    for (rank, slot), part in placed.sort_values("at").groupby(["rank", "slot"]):
        assert texts[rank, slot] == [w for r in part.itertuples() for w in of[r.key][r.begin : r.begin + r.words]]


def test_mix_reruns_agree_and_follow_the_seed(spark):
    docs = sourced(spark, mixture(spark))
    first = sorted(map(tuple, mix_sources(docs, block=16).taken().collect()), key=repr)
    again = sorted(map(tuple, mix_sources(docs.repartition(3), block=16).taken().collect()), key=repr)
    other = sorted(map(tuple, mix_sources(docs, block=16, seed=9).taken().collect()), key=repr)
    assert first == again != other


def test_shards_are_multinomial(spark):
    rows = [(i, "w " * 10, "ab"[i % 2]) for i in range(4_000)]
    mix = mix_sources(sourced(spark, rows), weights=(1, 3), block=10, shard_blocks=100)
    counts = mix.slots.groupBy("shard").pivot("rank", [0, 1]).count().toPandas().set_index("shard").sort_index()
    counts.columns = [0, 1]
    assert list(counts.index) == list(range(40)) and counts[0].sum() == 1_000 and counts[1].sum() == 3_000
    spread = ((counts[1] - 75) ** 2 / 75).sum()
    assert 15 < spread < 75  # chi-square with 39 degrees of freedom


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 16, 17, 1_000])
def test_permutations_hit_every_index(size):
    seen = set()
    for key in range(20):
        out = permuted(np.arange(size), size, np.full(size, key * 7919 + 1, np.uint64))
        assert sorted(out) == list(range(size))
        seen.add(tuple(out))
    assert size < 4 or len(seen) > 10


def test_mix_of_empty_tables(spark):
    mix = mix_sources(sourced(spark, []))
    assert mix.taken().collect() == [] and mix.rows().collect() == []
    none = mix_sources(sourced(spark, [(1, None, "a"), (2, "", None)])).taken().collect()
    assert [(r["size"], r["target"], r["taken"]) for r in none] == [(0, 0.0, 0)] * 2
    with pytest.raises(ValueError):
        mix_sources(sourced(spark, []), weights=(1, 0))
