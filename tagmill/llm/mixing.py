"""Mixing sources to target weights, in blocks of words.

The texts of a source, in order of their keys, are one stream of words, cut into blocks of ``BLOCK_WORDS``. What a
source gives to the mix is a number of slots, one block each. Slots are dealt to the output shards by multinomial
draws: first to groups of shards, then to the shards of a group, so no task holds a draw of more than a few
thousand numbers. Slot k of a source with b blocks asks for block p(k mod b), where p is a pseudorandom permutation of the
indices (a Feistel network that walks until it is back in range), another one for every k div b: no block
is taken twice before all were taken once. Slots and blocks meet in a join by index.

Draws and permutations depend on the seed, the source's rank and the slot only, so reruns agree whatever the
partitions. Prefix sums of sizes come in two steps, within ranges of (source, key) and over the ranges, so a source that holds
most rows is spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tagmill.session import scratch_folder, shuffle_partitions, written

BLOCK_WORDS = 256
SHARD_BLOCKS = 4_096
GROUP_SHARDS = 1_024  # shards of one draw
MOST_TIMES = 3
SEED = 42
_ROUNDS = 6
_SPANS = 65_536  # layout only: slots of one row before they are listed


def n_words(text: Column | str) -> Column:
    """The number of words, runs without ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


# --------------------------------------------------------------------------- targets
def source_targets(sources: DataFrame, weights: Sequence[float], most_times: int, folder: str) -> DataFrame:
    """(rank, source, source_size, target) from (source, source_size), one row per source.

    Sources by code point, null last, take the weights in turn and share the sum of all sizes by them. A target ends at
    ``most_times`` its source's size; what is left is shared again among the others until none is above. Only sums
    reach the driver; the level rises from round to round, so the loop ends when no further source is full.
    """
    ranked = written(_ranked(sources, folder), f"{folder}/ranked")
    weight = F.element_at(F.lit([float(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("most", F.col("source_size") * most_times)
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        above = F.col("weight") * level > F.col("most")
        open_, held, now = ranked.agg(
            F.sum(F.when(~above, F.col("weight"))), F.sum(F.when(above, F.col("most"))), F.count_if(above)
        ).first()
        if now == full or not open_:
            break
        level, full = (total - (held or 0)) / open_, now
    target = F.least(F.col("weight") * level, F.col("most").cast("double"))
    return ranked.select("rank", "source", "source_size", target.alias("target"))


def _ranked(sources: DataFrame, folder: str) -> DataFrame:
    """Adds ``rank``, from 0: counted within ranges, then moved by the sizes of the ranges before."""
    late = F.col("source").isNull()
    parts = shuffle_partitions(sources.sparkSession)
    dealt = sources.repartitionByRange(parts, late, "source").withColumn("part", F.spark_partition_id())
    dealt = written(dealt, f"{folder}/sources")
    parts_before = _before(dealt.groupBy("part").agg(F.count(F.lit(1)).alias("rows")), "rows", [])
    within = F.row_number().over(Window.partitionBy("part").orderBy(late, "source"))
    joined = dealt.withColumn("within", within).join(parts_before, "part")
    return joined.select((F.col("within") - 1 + F.col("before")).alias("rank"), "source", "source_size")


def _before(parts: DataFrame, what: str, by: list[str]) -> DataFrame:
    """``before``: the sum of ``what`` in the parts ahead. One row per range and key, so small enough for a window."""
    window = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(*by, "part", F.coalesce(F.sum(what).over(window), F.lit(0)).alias("before"))


# --------------------------------------------------------------------------- streams and blocks
def placed_documents(sized: DataFrame, targets: DataFrame, folder: str) -> DataFrame:
    """Adds ``first``, the words of its source ahead of each row, and its source's row of ``targets`` to (key, source, size,
    mark); order: key, size, mark.

    Rows that agree in all four may change places, which changes nothing in the result. Sums and targets are
    joined by source and range, so no task meets more of a source than its range.
    """
    order = ["key", "size", "mark"]
    dealt = sized.repartitionByRange(shuffle_partitions(sized.sparkSession), "source", *order)
    dealt = written(dealt.withColumn("part", F.spark_partition_id()), f"{folder}/dealt")
    # A null source is a source: its key in joins is the flag beside its name.
    keys = {"nameless": F.col("source").isNull(), "name": F.coalesce("source", F.lit(""))}
    by = ["nameless", "name"]
    sums = dealt.withColumns(keys).groupBy(*by, "part").agg(F.sum("size").alias("words"))
    ranges = _before(sums, "words", by).join(targets.withColumns(keys).drop("source"), by)
    ahead = Window.partitionBy(*by, "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = dealt.withColumns(keys).withColumn("within", F.coalesce(F.sum("size").over(ahead), F.lit(0)))
    first = (F.col("within") + F.col("before")).alias("first")
    return within.join(ranges, [*by, "part"]).select("key", "source", "size", first, "rank", "source_size", "target")


def block_pieces(placed: DataFrame, block: int) -> DataFrame:
    """One row per block that a row of ``placed`` has words in: rank, key, first, block, begin (its first word there),
    at (that word's place in the block), words."""
    last = F.expr(f"(first + size - 1) div {block}")
    each = placed.where("size > 0").withColumn("block", F.explode(F.sequence(F.expr(f"first div {block}"), last)))
    start = F.greatest(F.col("first"), F.col("block") * block)
    end = F.least(F.col("first") + F.col("size"), (F.col("block") + 1) * block)
    return each.select(
        "rank", "key", "first", "block", (start - F.col("first")).alias("begin"),
        (start - F.col("block") * block).alias("at"), (end - start).alias("words"),
    )


# --------------------------------------------------------------------------- slots
def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)  # fixed values: a published mixing function
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, size: int, keys: np.ndarray) -> np.ndarray:
    """Where pseudorandom permutations of 0 to ``size`` - 1, one for each of ``keys``, take each index.

    A Feistel network permutes the numbers below the next power of four; a number out of range goes through it again.
    """
    half = np.uint64(max(1, ((size - 1).bit_length() + 1) // 2))
    low = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    with np.errstate(over="ignore"):
        while len(todo):
            left, right, key = out[todo] >> half, out[todo] & low, keys[todo]
            for turn in range(_ROUNDS):
                mark = _mixed(key + right * np.uint64(0x9E3779B97F4A7C15) + np.uint64(turn << 56))
                left, right = right, left ^ (mark & low)
            out[todo] = left << half | right
            todo = todo[out[todo] >= size]
    return out.astype(np.int64)


def slots_of(target: float, size: int, block: int, most_times: int) -> tuple[int, int]:
    """Words that a source gives, and the slots that hold them: whole passes over all its blocks, then single blocks,
    of which the last may be cut."""
    words = min(int(np.floor(target + 0.5)), most_times * size)
    if not size:
        return 0, 0
    passes, rest = divmod(words, size)
    return words, passes * -(-size // block) + -(-rest // block)


def shard_counts(targets: DataFrame, block: int, shard_blocks: int, most_times: int, seed: int) -> DataFrame:
    """(rank, source_size, words, shard, slot, count): multinomial draws of how many slots of a source each shard holds,
    and the first of them. Shards have about ``shard_blocks`` slots."""
    shape = "rank long, source_size long, words long, low long, high long, slot long, count long"

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [slots_of(t, s, block, most_times) for t, s in zip(*(batch.column(c).to_pylist() for c in ("target", "source_size")))]
            columns = [batch.column("rank"), batch.column("source_size")] + [pa.array(x, pa.int64()) for x in zip(*rows)]
            yield pa.RecordBatch.from_arrays(columns, ["rank", "source_size", "words", "slots"])

    given = targets.mapInArrow(counted, "rank long, source_size long, words long, slots long").where("slots > 0")
    total = given.agg(F.sum("slots")).first()[0] or 0
    shards = max(1, -(-total // shard_blocks))

    def drawn(width: int, parent: int):
        """Deals counts from ranges of ``parent`` shards to ranges of ``width`` shards."""

        def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    lows = np.arange(row["low"], row["high"], width)
                    highs = np.minimum(lows + width, row["high"])
                    draws = np.random.default_rng([seed, row["rank"], parent, row["low"]])
                    counts = draws.multinomial(row["count"], (highs - lows) / (row["high"] - row["low"]))
                    slots, some = row["slot"] + np.cumsum(counts) - counts, counts > 0
                    n = int(some.sum())
                    fixed = [pa.array([row[c]] * n, pa.int64()) for c in ("rank", "source_size", "words")]
                    moving = [pa.array(x[some].astype(np.int64)) for x in (lows, highs, slots, counts)]
                    yield pa.RecordBatch.from_arrays(
                        fixed + moving, ["rank", "source_size", "words", "low", "high", "slot", "count"]
                    )

        return draw

    whole = given.select(
        "rank", "source_size", "words", F.lit(0).cast("long").alias("low"), F.lit(shards).cast("long").alias("high"),
        F.lit(0).cast("long").alias("slot"), F.col("slots").alias("count"),
    )
    parts, width = shuffle_partitions(targets.sparkSession), shards
    while width > 1:  # a range of 1,024^k shards is dealt to 1,024 ranges; as many turns as k
        below = 1
        while below * GROUP_SHARDS < width:
            below *= GROUP_SHARDS
        whole = whole.repartition(parts, "rank", "low").mapInArrow(drawn(below, width), shape)
        width = below
    return whole.select("rank", "source_size", "words", F.col("low").alias("shard"), "slot", "count")


def block_slots(counts: DataFrame, block: int, seed: int) -> DataFrame:
    """(rank, shard, slot, block, words): the block that every slot takes, and how many of its words."""
    spans = F.sequence(F.lit(0).cast("long"), F.expr(f"(count - 1) div {_SPANS}"))
    listed = counts.withColumn("span", F.explode(spans))
    first = F.col("slot") + F.col("span") * _SPANS
    listed = listed.select(
        "rank", "source_size", "words", "shard", first.alias("slot"),
        F.least(F.lit(_SPANS).cast("long"), F.col("count") - F.col("span") * _SPANS).alias("count"),
    )
    listed = listed.repartition(shuffle_partitions(counts.sparkSession), "rank", "slot")

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                size, slots = row["source_size"], np.arange(row["slot"], row["slot"] + row["count"])
                whole, tail = divmod(size, block)
                per_pass = whole + (tail > 0)
                turn, index = np.divmod(slots, per_pass)
                rest = row["words"] - turn * size  # words still to be given when the pass begins
                words = np.clip(rest - index * block, 0, np.where(index < whole, block, tail or block))
                # The short block comes last in a pass, so all slots before it are full.
                chosen = index.copy()
                inner = np.flatnonzero(index < whole)
                with np.errstate(over="ignore"):
                    keys = _mixed(turn[inner].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(seed))
                    keys = _mixed(keys + np.uint64(row["rank"]))
                chosen[inner] = permuted(index[inner], whole, keys)
                n = len(slots)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[c]] * n, pa.int64()) for c in ("rank", "shard")]
                    + [pa.array(x.astype(np.int64)) for x in (slots, chosen, words)],
                    ["rank", "shard", "slot", "block", "words"],
                )

    return listed.mapInArrow(take, "rank long, shard long, slot long, block long, words long")


# --------------------------------------------------------------------------- the mix
class Mix:
    """A mix of ``docs``: ``targets``, ``documents`` (placed in their source's stream), ``pieces`` and ``slots``."""

    def __init__(
        self, docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[float] = (1, 2, 3), most_times: int = MOST_TIMES, block: int = BLOCK_WORDS,
        shard_blocks: int = SHARD_BLOCKS, seed: int = SEED,
    ):
        if block < 1 or shard_blocks < 1 or most_times < 1 or not weights or min(weights) <= 0:
            raise ValueError("blocks, shards, the limit and all weights are positive")
        self.block, folder = block, scratch_folder(docs.sparkSession, "mix")
        sized = written(
            docs.select(
                F.col(key).alias("key"), F.col(source).cast("string").alias("source"), n_words(text).alias("size"),
                F.xxhash64(text).alias("mark"),
            ),
            f"{folder}/sized",
        )
        sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
        self.targets = written(source_targets(sums, weights, most_times, folder), f"{folder}/targets")
        self.documents = written(placed_documents(sized, self.targets, folder), f"{folder}/documents")
        self.pieces = block_pieces(self.documents, block)
        counts = shard_counts(self.targets, block, shard_blocks, most_times, seed)
        self.slots = written(block_slots(counts, block, seed), f"{folder}/slots")

    def rows(self) -> DataFrame:
        """The mix in full: shard, slot, rank (of the source), key, first (the document's place in its stream), begin, words
        (the part of the document) and at (its place in the slot)."""
        pieces, slots = self.pieces.alias("p"), self.slots.alias("s")
        same = (F.col("p.rank") == F.col("s.rank")) & (F.col("p.block") == F.col("s.block"))
        words = F.least(F.col("p.words"), F.col("s.words") - F.col("p.at"))
        joined = pieces.join(slots, same).withColumn("taken", words).where("taken > 0")
        return joined.select(
            "s.shard", "s.slot", "p.rank", "p.key", "p.first", "p.begin", F.col("taken").alias("words"), "p.at"
        )

    def taken(self) -> DataFrame:
        """One row per row of the documents: key, source, size, source_size, target, taken (words, repeats counted)."""
        # A block's slots are counted first; a cut slot is a row of its own.
        slots = self.slots.groupBy("rank", "block", "words").agg(F.count(F.lit(1)).alias("times")).alias("s")
        same = (F.col("p.rank") == F.col("s.rank")) & (F.col("p.block") == F.col("s.block"))
        words = F.greatest(F.least(F.col("p.words"), F.col("s.words") - F.col("p.at")), F.lit(0)) * F.col("s.times")
        sums = self.pieces.alias("p").join(slots, same).groupBy("p.rank", "p.first").agg(F.sum(words).alias("taken"))
        # Rows with words have a place of their own; those without share one and take nothing.
        joined = self.documents.alias("d").join(
            sums.alias("m"),
            (F.col("d.rank") == F.col("m.rank")) & (F.col("d.first") == F.col("m.first")) & (F.col("d.size") > 0),
            "left",
        )
        return joined.select(
            "d.key", "d.source", "d.size", "d.source_size", "d.target", F.coalesce("m.taken", F.lit(0)).alias("taken")
        )


def mix_sources(docs: DataFrame, **options) -> Mix:
    """Mix the sources of ``docs`` to target weights; see ``Mix`` for what it holds and for the options.

    Size is the number of words; null and wordless texts have size 0 and take no part, nor does a source without
    words. Null sources are one source, the last; null and repeated keys are rows like others. Every source gives its
    target, rounded to a word; a document is taken at most ``most_times`` times over. Extra columns are ignored. An
    empty table gives an empty mix.
    """
    return Mix(docs, **options)


def mixed_texts(mix: Mix, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(shard, slot, rank, text): the words of every slot, joined by single spaces. Keys must be distinct and not null."""
    rows = mix.rows().alias("m").join(docs.select(F.col(key).alias("k"), F.col(text).alias("t")).alias("d"), F.col("m.key") == F.col("d.k"))
    words = F.filter(F.split("t", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    part = F.array_join(F.slice(words, (F.col("begin") + 1).cast("int"), F.col("words").cast("int")), " ")
    parts = rows.select("shard", "slot", "rank", "at", part.alias("part"))
    joined = parts.groupBy("shard", "slot", "rank").agg(F.array_sort(F.collect_list(F.struct("at", "part"))).alias("parts"))
    return joined.select("shard", "slot", "rank", F.array_join(F.transform("parts", lambda p: p["part"]), " ").alias("text"))
