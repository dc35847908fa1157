"""The stages one after the other over a given table, each beside what it must do."""

from collections import defaultdict

from helpers import awkward
from test_duplicates import plain_repeats

import corpus_pipeline
from tagmill.llm.simhash import shingle_hashes, text_fingerprint

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs, folder = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        folder[name] = docs
        docs = stage(spark, docs, SF)
        if name != "packing":
            assert docs.columns == folder["toxicity"].columns
            docs = spark.createDataFrame(docs.collect(), docs.schema)
    before = {r.doc_id: r.text for r in folder["suffix_array"].collect()}
    after = {r.doc_id: r.text for r in folder["packing"].collect()}
    removed = plain_repeats(before)
    for i, text in before.items():
        left = [w for k, w in enumerate(text.encode().split()) if k not in removed[i]]
        assert after[i].encode().split() == left
    places = defaultdict(int)
    for r in docs.collect():
        places[r.sequence_id] += r.length
        assert r.doc_id in after
    assert max(places.values()) <= 1024
    assert {r.doc_id for r in docs.collect()} == set(after)
    whole = corpus_pipeline.run(spark, SF)
    columns = [c for c in docs.columns if c not in ("sequence_id", "offset")]
    assert sorted(whole.select(columns).collect()) == sorted(docs.select(columns).collect())


def test_stages_take_awkward_rows(spark):
    docs = awkward(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.collect()
        if name != "packing":
            assert out.columns == docs.columns


def test_fingerprint_links_without_shared_shingles(spark):
    """What only the fingerprints link: most shingles are repeats of one, the other shingles differ."""
    rows = [(1, "a " * 100 + "p q r s t u"), (2, "a " * 100 + "f g h i j k"), (3, "quite another text it is")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    prints, sets = [text_fingerprint(t) for _, t in rows], [set(shingle_hashes(t, 5)) for _, t in rows]
    assert (prints[0] ^ prints[1]).bit_count() <= 4
    assert len(sets[0] & sets[1]) < 0.8 * len(sets[0] | sets[1])
    assert {r.doc_id for r in corpus_pipeline.drop_copies(spark, docs, SF).collect()} == {1, 3}
