import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagmill.operators.numbering import numbered

from tagmill.operators.pairs import co_rating_pairs, compare_items, compare_pairs, user_cdf
from tagmill.operators.skew import fan_out, heavy_keys, spread
from tagmill.operators.tags import tag_confidence, tag_edges, tag_rows, tag_table, user_authority
from tagmill.schemas import COLLECTIONS, LONG, struct
from tagmill.session import written


def collections(spark, rows):
    empty = {f.name: None for f in COLLECTIONS}
    return spark.createDataFrame([tuple({**empty, **r}.values()) for r in rows], COLLECTIONS)


TAGGED = [
    dict(user_id="a", subject_id=1, tags=["Sci-Fi", "scifi"]),
    dict(user_id="b", subject_id=1, tags=["SciFi\x00"]),
    dict(user_id="b", subject_id=2, tags=[]),
    dict(user_id="c", subject_id=3, tags=["x"]),
    dict(user_id="c", subject_id=2, tags=None),
]


def test_tag_table_by_hand(spark):
    records = collections(spark, TAGGED)
    archive = spark.createDataFrame([(1,), (2,)], struct(id=LONG))
    edges = {tuple(r) for r in tag_edges(tag_rows(records, archive)).collect()}
    assert edges == {("a", 1, "scifi", 2), ("b", 1, "scifi", 1)}
    rows = sorted(tuple(r) for r in tag_table(records, archive).collect())
    assert [(r[0], r[1], r[2], r[4], r[5]) for r in rows] == [
        (1, "Sci-Fi", "scifi", 1, 3),
        (1, "SciFi", "scifi", 1, 3),
        (1, "scifi", "scifi", 1, 3),
    ]
    assert all(r[3] == pytest.approx(5 / 3) for r in rows)


def brute_authority(edges, tol=1e-6):
    users = {e[0] for e in edges}
    score = {u: 1 / len(users) for u in users}
    for _ in range(1000):
        hub, new = defaultdict(float), defaultdict(float)
        for u, s, t, n in edges:
            hub[s, t] += n * score[u]
        norm = sum(hub.values())
        for u, s, t, n in edges:
            new[u] += n * hub[s, t] / norm
        total = sum(new.values())
        new = {u: v / total for u, v in new.items()}
        change = sum((new[u] - score[u]) ** 2 for u in users) ** 0.5
        score = new
        if change < tol:
            break
    return score


def random_edges(seed=1, users=30, hubs=12, rows=200, hot=0):
    chance = random.Random(seed)
    counts = defaultdict(int)
    for _ in range(rows):
        counts[f"u{chance.randrange(users)}", chance.randrange(hubs), "t"] += chance.randint(1, 3)
    for i in range(hot):  # one user and one hub hold most rows
        counts["hot", i, "t"] += 1
        counts[f"v{i}", 0, "t"] += 1
    return [(*k, n) for k, n in counts.items()]


@pytest.mark.parametrize("hot", [0, 300])
def test_authority_settles_like_brute_force(spark, hot):
    edges = random_edges(hot=hot)
    df = spark.createDataFrame(edges, "user_id string, subject_id long, tags_normalized string, n long")
    found = {r["user_id"]: r["score"] for r in user_authority(df, tol=1e-12).collect()}
    expected = brute_authority(edges, tol=1e-16)
    assert set(found) == set(expected)
    assert sum(found.values()) == pytest.approx(1)
    assert all(found[u] == pytest.approx(expected[u], abs=1e-9) for u in found)
    hubs = {r["subject_id"]: r for r in tag_confidence(df, tol=1e-12).collect()}
    for h in {e[1] for e in edges}:
        assert hubs[h]["tagnorm_cnt"] == sum(e[3] for e in edges if e[1] == h)
        total = sum(e[3] * expected[e[0]] for e in edges if e[1] == h)
        assert hubs[h]["confidence"] == pytest.approx(total, abs=1e-9)


def dense_authority(edges):
    users, hubs = sorted({e[0] for e in edges}), sorted({e[1:3] for e in edges})
    counts = np.zeros((len(users), len(hubs)))
    for u, s, t, n in edges:
        counts[users.index(u), hubs.index((s, t))] += n
    main = np.abs(np.linalg.eigh(counts @ counts.T)[1][:, -1])
    return dict(zip(users, main / main.sum()))


def grouped_edges(size, joined, seed=4):
    """Two groups of users with their own hubs and, if ``joined``, one shared tag."""
    chance, rows = random.Random(seed), []
    for g in "ab":
        for i in range(size):
            rows += [(f"{g}{i}", h, g, chance.randint(1, 3)) for h in chance.sample(range(60), 5)]
    return rows + ([("a0", 0, "shared", 1), ("b0", 0, "shared", 1)] if joined else [])


@pytest.mark.parametrize("joined", [True, False])
def test_authority_of_two_groups_settles_in_few_rounds(spark, joined):
    """Plain rounds need thousands here, or stop far from the vector."""
    edges, rounds = grouped_edges(300, joined), []
    df = spark.createDataFrame(edges, "user_id string, subject_id long, tags_normalized string, n long")
    found = {r["user_id"]: r["score"] for r in user_authority(df, tol=1e-9, rounds=rounds).collect()}
    expected = dense_authority(edges)
    assert all(found[u] == pytest.approx(expected[u], rel=1e-4, abs=1e-7 * max(expected.values())) for u in expected)
    assert rounds[-1] <= 1e-9 and len(rounds) < 60


def test_rounds_carry_numbers_only(spark, monkeypatch):
    """No text in what a round writes; keys may have any names, also those used inside."""
    from tagmill.operators import tags

    stored = []

    def spy(df, path, *rest):
        stored.append((path.rsplit("/", 1)[1], df.schema, df._jdf.queryExecution().toString()))
        return written(df, path, *rest)

    monkeypatch.setattr(tags, "written", spy)
    rows = [(u, s, t, n) for u, s, t, n in random_edges()]
    df = spark.createDataFrame(rows, "user string, hub long, name string, n long")
    found = tag_confidence(df, "user", "hub", "name", tol=1e-12)
    assert found.columns == ["hub", "name", "confidence", "tagnorm_cnt"] and found.count() > 5
    rounds = [(schema, plan) for name, schema, plan in stored if name.startswith("scores-")]
    assert rounds and all("string" not in schema.simpleString() and "name#" not in plan for schema, plan in rounds)


def test_rounds_join_no_edges_and_cut_large_hubs(spark, monkeypatch):
    """A round moves one number per user and block: no join of edges, nor a sum per edge, is left in it."""
    from tagmill.operators import tags

    plans, bundled = [], []

    def spy(df, path, *rest):
        plans.append((path.rsplit("/", 1)[1], df._jdf.queryExecution().toString()))
        return written(df, path, *rest)

    class Kept(tags._Bundles):
        def __init__(self, *given):
            super().__init__(*given)
            bundled.append((self.blocks.count(), len(self.cut)))

    monkeypatch.setattr(tags, "written", spy)
    monkeypatch.setattr(tags, "_Bundles", Kept)
    edges = random_edges(hot=300)
    df = spark.createDataFrame(edges + [("w", None, None, 2), ("u1", None, None, 1)], "u string, s long, t string, n long")
    found = {(r["s"], r["t"]): r["tagnorm_cnt"] for r in tag_confidence(df, "u", "s", "t", tol=1e-9).collect()}
    expected = defaultdict(int, {(None, None): 3})
    for _, s, t, n in edges:
        expected[s, t] += n
    assert found == expected
    rounds = [plan for name, plan in plans if name.startswith("scores-")]
    assert rounds and not any("Join" in plan or "HashAggregate" in plan for plan in rounds)
    blocks, cuts = bundled[0]
    assert cuts > 1 and blocks < 30 < len(edges)


def test_numbers_are_dense(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 301).alias("a"), F.lit(None).cast("string").alias("b"))
    found, size = numbered(df, ["a", "b"], "number", f"{tmp_path}/n")
    rows = found.collect()
    assert size == 301 and sorted(r["number"] for r in rows) == list(range(301)) and len({r["a"] for r in rows}) == 301
    none, size = numbered(df.where("a < 0"), ["a"], "number", f"{tmp_path}/none")
    assert size == 0 and none.collect() == []


def test_no_edges(spark):
    df = spark.createDataFrame([], "user_id string, subject_id long, tags_normalized string, n long")
    assert user_authority(df).count() == 0
    assert tag_confidence(df).count() == 0


def test_heavy_keys_are_few_and_lose_nothing(spark):
    rows = [(1, i) for i in range(1000)] + [(k, k) for k in range(2, 200)]
    df = spark.createDataFrame(rows, "k long, v long")
    heavy = heavy_keys(df, ["k"], 8)
    assert [(r["k"], r["_slots"]) for r in heavy.collect()] == [(1, 7)]
    side = spark.createDataFrame([(k, k * 10) for k in range(1, 200)], "k long, w long")
    placed = spread(df, ["k"], heavy, ["v"])
    assert placed.where("k = 1").select("slot").distinct().count() == 7
    joined = placed.join(fan_out(side, ["k"], heavy), ["k", "slot"])
    assert joined.count() == len(rows)
    assert joined.agg(F.sum("w")).first()[0] == sum(k * 10 for k, _ in rows)
    assert heavy_keys(side, ["k"], 8) is None


RATED = [
    dict(user_order=1, subject_id=10, rate=5),
    dict(user_order=1, subject_id=20, rate=8),
    dict(user_order=1, subject_id=30, rate=8),
    dict(user_order=2, subject_id=10, rate=9),
    dict(user_order=2, subject_id=20, rate=6),
    dict(user_order=2, subject_id=30, rate=0),
    dict(user_order=2, subject_id=40, rate=7),
]


def test_pairs_by_hand(spark):
    subjects = spark.createDataFrame(
        [(i, "anime", 1, 0) for i in (10, 20, 30)] + [(40, "game", 1, 99)],
        "id long, type string, rank long, rate_count long",
    )
    pairs = compare_pairs(collections(spark, RATED), subjects)
    rows = {(r["item1"], r["item2"]): tuple(r)[2:] for r in pairs.collect()}
    assert set(rows) == {(10, 20), (10, 30), (20, 30)}
    assert rows[10, 20] == pytest.approx((7, 7, 0.5, 0.5, 2 / 3, 3 / 4))
    assert rows[10, 30] == pytest.approx((5, 8, 0, 1, 1 / 3, 1))
    assert rows[20, 30] == pytest.approx((8, 8, 0, 0, 1, 1))
    cut = compare_pairs(collections(spark, RATED), subjects, max_item_exclusive=30)
    assert [(r["item1"], r["item2"]) for r in cut.collect()] == [(10, 20)]


def test_cdf(spark):
    df = spark.createDataFrame(
        [(1, 10, 5), (1, 20, 8), (1, 30, 8), (2, 10, 9), (2, 20, 6), (None, 1, 1)],
        "user_order long, subject_id long, rate int",
    )
    rows = {(r["user_order"], r["subject_id"]): r["cdf"] for r in user_cdf(df).collect()}
    assert rows[1, 10] == pytest.approx(1 / 3) and rows[1, 20] == 1 and rows[2, 20] == 0.5
    assert len(rows) == 6  # a row without a user stays


def brute_pairs(rows):
    by_user = defaultdict(list)
    for u, i, r in rows:
        by_user[u].append((i, r))
    sums = defaultdict(lambda: [0] * 7)
    for given in by_user.values():
        share = {r: sum(x <= r for _, x in given) / len(given) for _, r in given}
        for a, ra in given:
            for b, rb in given:
                if a < b:
                    s = sums[a, b]
                    for at, value in enumerate((1, ra, rb, ra > rb, ra < rb, share[ra], share[rb])):
                        s[at] += value
    return {k: [x / s[0] for x in s[1:]] for k, s in sums.items()}


@pytest.mark.parametrize("block", [1000, 7])
def test_pairs_of_a_heavy_user(spark, block):
    """One user holds most rows, some of them repeated; small blocks split the user over many cells."""
    chance = random.Random(3)
    rows = [(0, chance.randrange(60), chance.randint(1, 10)) for _ in range(150)]
    rows += [(u, chance.randrange(60), chance.randint(1, 10)) for u in range(1, 30) for _ in range(4)]
    df = spark.createDataFrame(rows, "user_order long, subject_id long, rate int")
    found = {
        (r["item1"], r["item2"]): list(r)[2:] for r in compare_items(df, block=block).collect()
    }
    expected = brute_pairs(rows)
    assert set(found) == set(expected)
    for key, means in expected.items():
        assert found[key] == pytest.approx(means)
    met = co_rating_pairs(df, block=block)
    count = sum(
        1
        for u, i, _ in rows
        for v, j, _ in rows
        if u == v and i < j
    )
    assert met.count() == count


def test_items_left_out(spark):
    df = spark.createDataFrame([(1, i, 1) for i in range(5)], "user_order long, subject_id long, rate int")
    assert co_rating_pairs(df).count() == 10
    assert co_rating_pairs(df, max_item_exclusive=3).count() == 3


def sent_rows(spark, make):
    """Rows that the exchanges of a query write."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = make()
        df.collect()
        plans, sent = [df._jdf.queryExecution().executedPlan()], 0
        while plans:
            plan = plans.pop()
            if plan.nodeName() == "Exchange":
                sent += plan.metrics().apply("shuffleRecordsWritten").value()
            plans += [plan.children().apply(i) for i in range(plan.children().size())]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    return sent


def alike(found, expected):
    assert set(found) == set(expected)
    for key, means in expected.items():
        assert found[key] == pytest.approx(means)


def test_pairs_are_made_behind_the_exchange(spark):
    """Rows and lists move, not sums per pair: here 7,600 pairs that one user each has."""
    rows = [(u, 20 * u + i, i % 10 + 1) for u in range(40) for i in range(20)]
    df = spark.createDataFrame(rows, "user_order long, subject_id long, rate int")
    found = []
    assert sent_rows(spark, lambda: found.append(compare_items(df)) or found[0]) < 4_000
    alike({(r["item1"], r["item2"]): list(r)[2:] for r in found[0].collect()}, brute_pairs(rows))


def test_an_item_of_most_rows(spark):
    """The pairs of an item that all users rated are dealt over slots."""
    rows = [(u, i, (u + i) % 10 + 1) for u in range(60) for i in (0, u + 1, u + 2)]
    df = spark.createDataFrame(rows, "user_order long, subject_id long, rate int")
    found = {(r["item1"], r["item2"]): list(r)[2:] for r in compare_items(df).collect()}
    alike(found, brute_pairs(rows))


def test_small_blocks_send_rows_once(spark):
    df = spark.createDataFrame([(1, i, i) for i in range(100)], "user_order long, subject_id long, rate int")
    assert sent_rows(spark, lambda: co_rating_pairs(df, block=5)) < 500
    assert co_rating_pairs(df, block=5).distinct().count() == 4_950


def sent_bytes(spark, make):
    """Bytes that the exchanges of a query write."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = make()
        df.collect()
        plans, sent = [df._jdf.queryExecution().executedPlan()], 0
        while plans:
            plan = plans.pop()
            if plan.nodeName() == "Exchange":
                sent += plan.metrics().apply("shuffleBytesWritten").value()
            plans += [plan.children().apply(i) for i in range(plan.children().size())]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    return sent


def test_pairs_cost_no_disk(spark):
    """A row moves to a few cells, not to every row that it meets: here 897,000 pairs, for which 806,344 bytes were sent before."""
    chance = random.Random(9)
    rows = [(u, chance.randrange(10**6), chance.randint(1, 10)) for u in range(20) for i in range(300)]
    df = spark.createDataFrame(rows, "user_order long, subject_id long, rate int")
    assert sent_bytes(spark, lambda: compare_items(df).groupBy().count()) < 400_000


@pytest.mark.parametrize("block", [None, 20])
def test_pairs_of_named_items_and_users(spark, block):
    """Items and users of any name, rates of any size; names meet in their order."""
    chance = random.Random(4)
    rows = [(f"u{chance.randrange(9)}", f"i{chance.randrange(40)}", chance.choice([0.1, 2.5, -3.0, 1e9])) for _ in range(200)]
    df = spark.createDataFrame(rows + [(None, "i1", 1.0), ("u1", None, 1.0), ("u1", "i1", None)], "u string, i string, r double")
    found = {(r["item1"], r["item2"]): list(r)[2:] for r in compare_items(df, "u", "i", "r", block=block).collect()}
    alike(found, brute_pairs(rows))


def test_an_item_with_more_pairs_than_a_run(spark, monkeypatch):
    """Runs are of whole items; one that is too large is added up in parts."""
    from tagmill.operators import meetings

    chance = random.Random(6)
    rows = [(u, i, chance.randint(1, 10)) for u in range(12) for i in {0, 1, *chance.sample(range(30), 9)}] * 2
    batch = pa.RecordBatch.from_pydict({
        "block": pa.array([i % 2 for _, i, _ in rows], pa.int32()), "met": [3] * len(rows), "user": [u for u, _, _ in rows],
        "item": [i for _, i, _ in rows], "rate": [float(r) for _, _, r in rows],
        "upto": [sum(v == u and x <= r for v, _, x in rows) for u, _, r in rows],
        "of": [sum(v == u for v, _, _ in rows) for u, _, _ in rows], "n": [1] * len(rows),
    })
    monkeypatch.setattr(meetings, "PAIRS_AT_ONCE", 30)
    bundles = list(meetings.bundled(2, meetings.even_keys(3))([batch]))
    found = pa.Table.from_batches(meetings.pairs_of_cells(pa.int64())(bundles)).to_pylist()
    alike({(r["item1"], r["item2"]): list(r.values())[2:] for r in found}, brute_pairs(rows))


def test_packed_integers():
    from tagmill.operators.meetings import packed, unpacked

    for values in ([], [5], [-(2**63), 2**63 - 1, 0], [3, 3, 3], [1 << 40, 7, -9]):
        assert unpacked(packed(np.array(values, np.int64)), len(values)).tolist() == values
    assert len(packed(np.full(1_000, 8))) < 10


def test_even_keys_fill_all_partitions(spark):
    from tagmill.operators.meetings import even_keys

    df = spark.createDataFrame([(k,) for k in even_keys(28)], "k int").repartition(28, "k")
    assert df.select(F.spark_partition_id()).distinct().count() == 28
