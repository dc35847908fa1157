"""Exact top-k by integer inner product, term at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

QUERY_ROWS, CANDIDATE_ROWS = 1_024, 16_384  # rows of a block; layout only
_DENSE = 0.25


def integer_weights(vector: str, scale: int = 256) -> Column:
    """floor(scale * x) for every component, null if the vector is null or holds null or non-finite numbers."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(whole, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of weights; shorter vectors have weight 0 beyond their end."""
    lists = column.combine_chunks()
    sizes = lists.value_lengths().to_numpy()
    width = int(sizes.max()) if len(sizes) else 0
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy()
    return out


def _postings(weights: np.ndarray) -> list[tuple[np.ndarray | None, np.ndarray]]:
    """For every term the candidates that have it and their weights; (None, all weights) if many have it."""
    out = []
    for column in weights.T:
        rows = np.flatnonzero(column)
        many = len(rows) > _DENSE * len(column)
        out.append((None, np.ascontiguousarray(column)) if many else (rows, column[rows]))
    return out


def best_of_block(query: np.ndarray, postings, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the k best candidates; ``own`` are left out, ties go to the first place."""
    size = len(own)
    scores = np.zeros(size, np.int64)
    for term in np.flatnonzero(query):
        if term < len(postings):
            rows, weights = postings[term]
            if rows is None:
                scores += query[term] * weights
            else:
                scores[rows] += query[term] * weights
    places = np.flatnonzero(~own)
    found = scores[places]
    if len(found) > k:
        bar = np.partition(found, len(found) - k)[len(found) - k]
        above, level = np.flatnonzero(found > bar), np.flatnonzero(found == bar)
        chosen = np.concatenate([above, level[: k - len(above)]])
        places, found = places[chosen], found[chosen]
    return places, found


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), ``key``, score: for each query row the k best other rows, all if there are fewer.

    Score is the inner product of integer weights; ties go to the smaller key. Rows without a key or a whole vector
    take no part. Rows of one key are the same vector to a query: none of them answers itself, and a repeated
    query is answered once. Queries and candidates are dealt into blocks by hash; every block of queries meets
    every block of candidates once, and k rows per query and block go on to be ranked.
    """
    rows = vectors.select(F.col(key).alias("id"), integer_weights(vector).alias("weights"), is_query.alias("asks"))
    rows = rows.where("id is not null and weights is not null")
    number, asking = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    c_blocks, q_blocks = max(1, -(-number // CANDIDATE_ROWS)), max(1, -(-asking // QUERY_ROWS))

    def block(blocks: int) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")

    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    queries = rows.where("asks").dropDuplicates(["id"]).withColumn("q", block(q_blocks)).withColumn("c", every(c_blocks))
    candidates = rows.withColumn("c", block(c_blocks)).withColumn("q", every(q_blocks))
    columns = ["q", "c", "asking", "id", "weights"]
    both = queries.withColumn("asking", F.lit(True)).select(columns).unionByName(
        candidates.withColumn("asking", F.lit(False)).select(columns)
    )
    kind = vectors.schema[key].dataType.simpleString()

    def search(cell: pa.Table) -> pa.Table:
        asking = cell["asking"].to_numpy()
        asked, held = cell.filter(pa.array(asking)), cell.filter(pa.array(~asking)).sort_by("id")
        ids, wanted = held["id"].to_numpy(), asked["id"].to_numpy()
        postings = _postings(_matrix(held["weights"]))
        parts = [([], [], [])]
        for query, weights in zip(wanted, _matrix(asked["weights"])):
            places, scores = best_of_block(weights, postings, ids == query, k)
            parts.append((np.full(len(places), query), ids[places], scores))
        query, found, score = (np.concatenate(x) for x in zip(*parts))
        key_type = held.schema.field("id").type
        return pa.table({"query_id": pa.array(query.astype(ids.dtype), key_type), "found": pa.array(found.astype(ids.dtype), key_type), "score": pa.array(score.astype(np.int64))})

    found = both.groupBy("q", "c").applyInArrow(search, f"query_id {kind}, found {kind}, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "found")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("found").alias(key), "score")
