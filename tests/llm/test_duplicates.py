"""Near duplicates, repeated passages, links of vectors and top-k against brute force."""

import random
import re
from collections import defaultdict

import numpy as np
from helpers import DOCUMENTS, awkward, documents, rows_of
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

import corpus_pipeline
from tagmill.llm import binary_codes, similar, simhash
from tagmill.llm.binary_codes import near_vectors
from tagmill.llm.graphs import components
from tagmill.llm.simhash import chain_links, drop_near_duplicates, fingerprint_groups, simhash_components, text_fingerprint
from tagmill.llm.suffixes import cut_spans, drop_repeats, repeated_spans
from tagmill.llm.topk import top_k

VECTORS = "vec_id long, embedding array<float>, label int"


class Sets:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    for text in ("", " \t\n", "One", "Ab cd EF gh ij kl", "É a b c d É a b c d\x0bx", "a " * 50):
        assert text_fingerprint(text) == plain_fingerprint(text)


def test_chain_links_lose_no_pair():
    rng = np.random.default_rng(3)
    for bits in range(7):
        flips = [sum(1 << int(b) for b in rng.choice(64, bits, False)) for _ in range(300)]
        passed = set()
        for start in range(5):
            passed |= set(chain_links(np.full(300, start), np.array(flips, np.uint64)).tolist())
        assert len(passed) == (300 if bits <= 4 else 0)


def test_groups_of_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE_ROWS", 16)  # many tiles and cells
    rng = random.Random(7)
    values = {rng.getrandbits(64) for _ in range(60)}
    for value in list(values)[:12]:  # dense groups and chains
        for _ in range(40):
            value ^= sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 4, 5])))
            values.add(value)
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    sets = Sets(signed)
    for i, a in enumerate(signed):
        for b in signed[:i]:
            if (a ^ b).bit_count() <= 4 or ((a ^ b) & (1 << 64) - 1).bit_count() <= 4:
                sets.join(a, b)
    sizes = defaultdict(list)
    for v in signed:
        sizes[sets.find(v)].append(v)
    want = {v: root for root, members in sizes.items() if len(members) > 1 for v in members}
    got = fingerprint_groups(spark.createDataFrame([(v,) for v in signed], "fp long"))
    assert {r.fp: r.group for r in got.collect()} == want


def test_simhash_rows_and_ties(spark):
    df = awkward(spark)
    rows = simhash_components(df).collect()
    assert len(rows) == df.count()
    by_text = {r.doc_id: r for r in rows if r.doc_id}
    assert by_text[1].component_id == by_text[2].component_id == 1
    assert {r.component_id for r in rows if r.doc_id is None} == {1}
    assert by_text[3].fingerprint == "0" * 16 and by_text[4].component_id == by_text[5].component_id == 3
    assert all(r.fingerprint == format(plain_fingerprint(t), "016x") for r in rows for i, t in rows_of(df, "doc_id", "text") if i == r.doc_id)
    kept = drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert [r.doc_id for r in kept.orderBy("doc_id").collect()] == [None, 1, 3, 6, 7, 8, 9, 10]


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(0, 300)]
    star = [(1_000, 1_000 + i) for i in range(1, 200)]
    edges = spark.createDataFrame([*chain, *star, (5, 5)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(301)}, **{i: 1_000 for i in range(1_000, 1_200)}}
    assert components(edges.where("a < 0")).count() == 0


def words(rng, n):
    return [f"w{rng.randrange(5_000)}" for _ in range(n)]


def plain_repeats(texts):
    places = defaultdict(list)
    for i, t in sorted(texts.items()):
        w = t.encode().lower().split()
        for s in range(len(w) - 49):
            places[tuple(w[s : s + 50])].append((i, s))
    out = {i: set() for i in texts}
    for found in places.values():
        for i, s in found:
            if (i, s) != min(found):
                out[i].update(range(s, s + 50))
    return out


def test_repeated_passages(spark):
    rng = random.Random(11)
    shared, mosaic = words(rng, 60), words(rng, 120)
    texts = {
        1: words(rng, 200) + shared + words(rng, 30),
        2: shared + words(rng, 100),
        3: words(rng, 10) + shared[:49] + words(rng, 80),  # a word too short
        4: words(rng, 40) + mosaic + shared,
        5: mosaic[20:100] + words(rng, 20) + mosaic[60:],
        6: words(rng, 300),
        7: ["same"] * 130,
        8: [w.upper() for w in mosaic] + words(rng, 3),
    }
    texts = {i: " \n".join(w) for i, w in texts.items()} | {9: " \n".join(words(rng, 70))}
    texts[10] = texts[9]
    rows = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in texts.items()], DOCUMENTS)
    want, got = plain_repeats(texts), {i: set() for i in texts}
    spans = repeated_spans(rows)
    for r in spans.where("not kept").collect():
        got[r.id].update(range(r.begin, r.end))
    assert got == want
    kept = {r.id for r in spans.where("kept").collect()}
    assert {1, 4, 9} <= kept and not {3, 6, 10} & kept
    cut = {r.doc_id: r.text for r in drop_repeats(rows).collect()}
    for i, t in texts.items():
        assert cut[i].split() == [w for k, w in enumerate(t.split()) if k not in want[i]]
    assert cut[6] == texts[6] and cut[10] == ""


def test_passages_of_awkward_rows(spark):
    df = awkward(spark)
    out = drop_repeats(df)
    assert out.columns == df.columns and out.count() == df.count()
    assert rows_of(out.where("doc_id < 9"), "doc_id", "text") == rows_of(df.where("doc_id < 9"), "doc_id", "text")
    assert repeated_spans(spark.createDataFrame([], DOCUMENTS)).count() == 0
    assert cut_spans("  é a b\tc ", [(1, 3)]) == "  é c "


def vectors(spark, extra=()):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=16).tolist(), i % 3) for i in range(120)]
    for i in range(120, 170):  # near copies, some of copies
        base = np.array(rows[rng.integers(0, i)][1])
        rows.append((i, (base + rng.normal(size=16) * 0.15).tolist(), 1))
    rows += [(170, rows[5][1], 2), (171, rows[5][1], 2), (172, rows[5][1], None), (173, None, 1), (174, [0.0] * 16, 1)]
    rows += [(175, [float("nan")] + [1.0] * 15, 1), (176, [None] + [1.0] * 15, 1), (177, [], 1), (178, [1.0, 2.0], 1)]
    return spark.createDataFrame([*rows, *extra], VECTORS)


def whole(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v)


def test_near_vectors(spark, monkeypatch):
    monkeypatch.setattr(binary_codes, "TILE_ROWS", 20)
    rows = vectors(spark).collect()
    sets, links = Sets([r.vec_id for r in rows]), defaultdict(int)
    for a in rows:
        for b in rows:
            good = a.label is not None and a.label == b.label and whole(a.embedding) and whole(b.embedding)
            if a.vec_id < b.vec_id and good and len(a.embedding) == len(b.embedding):
                x, y = np.array(a.embedding, float), np.array(b.embedding, float)
                if x.any() and y.any() and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.9:
                    sets.join(a.vec_id, b.vec_id)
                    links[a.vec_id] += 1
                    links[b.vec_id] += 1
    assert sum(links.values()) > 60
    got = near_vectors(vectors(spark).withColumn("node", F.lit("x")), threshold=0.9).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_links, r.component_id, r.kept) == (links[r.vec_id], sets.find(r.vec_id), sets.find(r.vec_id) == r.vec_id)
    assert near_vectors(vectors(spark).where("vec_id < 0")).count() == 0


def test_top_k(spark, monkeypatch):
    for name, size in (("QUERY_ROWS", 4), ("CANDIDATE_ROWS", 30)):
        monkeypatch.setattr(f"tagmill.llm.topk.{name}", size)
    ties = [(200 + i, [1.0] * 16, 0) for i in range(9)] + [(None, [1.0] * 16, 0)]
    df = vectors(spark, ties).where("vec_id is null or vec_id <> 178")
    rows = [(r.vec_id, [int(np.floor(256 * float(x))) for x in r.embedding]) for r in df.collect() if r.vec_id is not None and (whole(r.embedding) or r.embedding == [])]
    want = []
    for q, w in rows:
        if q % 10 == 0:
            scores = sorted((-sum(a * b for a, b in zip(w, v)), i) for i, v in rows if i != q)[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    got = top_k(df, F.col("vec_id") % 10 == 0)
    assert rows_of(got, "query_id", "rank", "vec_id", "score") == sorted(want, key=repr)
    assert top_k(df.where("vec_id = 10"), F.col("vec_id") % 10 == 0).count() == 0


def test_empty_documents(spark):
    none = documents(spark).where("doc_id < 0")
    assert simhash_components(none).count() == 0 and drop_near_duplicates(none).count() == 0 and drop_repeats(none).count() == 0


def test_near_copies_at_a_similarity_of_four_fifths(spark):
    rng = random.Random(11)
    texts = []
    for _ in range(30):
        base = words(rng, 120)
        texts.append(base)
        for edits in (1, 2, 3, 4, 5, 8):  # up to far below the threshold
            copy = list(base)
            for at in rng.sample(range(120), edits):
                copy[at] = f"x{rng.randrange(10**6)}"
            texts.append(copy)
    sets = {i: {tuple(t[k : k + 5]) for k in range(116)} for i, t in enumerate(texts)}
    near = [(i, j) for i in sets for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    trees = Sets(sets)
    for i, j in near:
        trees.join(i, j)
    assert len(near) > 60
    docs = spark.createDataFrame([(i, " ".join(t), "en", "s", 0) for i, t in enumerate(texts)], DOCUMENTS)
    got = {r.doc_id: r.component_id for r in similar.similar_components(docs).collect()}
    assert got == {i: trees.find(i) for i in sets}
    kept = {r.doc_id for r in corpus_pipeline.drop_copies(spark, docs, "").collect()}
    assert kept == {trees.find(i) for i in sets}


def test_near_copies_of_awkward_rows_and_large_groups(spark, monkeypatch):
    kept = similar.drop_similar(awkward(spark))
    assert [r.doc_id for r in kept.orderBy("doc_id").collect()] == [None, 1, 3, 6, 7, 8, 9, 10]
    monkeypatch.setattr(similar, "TILE_ROWS", 8)
    rng, base = random.Random(5), words(random.Random(6), 200)
    texts = [" ".join(base[:k] + [f"y{rng.random()}"] + base[k + 1 :]) for k in range(60)]
    assert similar.drop_similar(documents(spark, texts)).count() == 1
