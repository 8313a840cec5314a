"""Exact inner-product search by block-at-a-time pruning.

Components are terms with whole-number weights. Vectors stand in ranges of ids, cut
into blocks with a forward index (the weights of each vector) and the largest and
smallest weight of every term. For a query, a block's summed term maxima (minima
where the query's weight is negative) bound every score in it, so blocks are scored
in descending order of their bounds until the next bound is below the k-th score.

Tasks pair a bounded chunk of queries with a bounded range of vectors; a last step
keeps the best k of the k that each range gives.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintagemart.sources.scratch import materialize

BLOCK = 256
RANGE = 64 * BLOCK
CHUNK = 1024

VECTOR = "id long, weights array<long>"


def _quantised(scale: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = [], []
            for key, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key is None or vector is None or None in vector:
                    continue
                weights = np.floor(np.array(vector, np.float64) * scale)
                if np.isfinite(weights).all():
                    ids.append(key)
                    rows.append([int(w) for w in weights])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(rows, pa.list_(pa.int64()))], names=["id", "weights"]
            )

    return run


def _matrix(rows: list, width: int) -> np.ndarray:
    """Rows as one array, missing terms as zeros. Floats are exact as long as no
    sum can leave 53 bits; otherwise Python's whole numbers are used."""
    out = np.zeros((len(rows), width), object)
    for at, row in enumerate(rows):
        out[at, : len(row)] = row
    return out


def _typed(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    top = lambda m: int(max(abs(m.max(initial=0)), abs(m.min(initial=0))))
    exact = top(one) * top(two) * max(one.shape[1], 1) < 1 << 53
    return (one.astype(np.float64), two.astype(np.float64)) if exact else (one, two)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row: higher scores first, then smaller ids."""
    order = np.argsort(ids, axis=1, kind="stable")
    scores, ids = np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)
    order = np.argsort(-scores, axis=1, kind="stable")[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def search_range(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int
) -> list[tuple[int, int, int]]:
    """(query row, vector id, score) of the k best vectors of a range per query, not
    counting vectors of the query's own id. ``ids`` ascend."""
    queries, vectors = _typed(queries, vectors)
    starts = range(0, len(ids), BLOCK)
    high = np.stack([vectors[s : s + BLOCK].max(axis=0) for s in starts])
    low = np.stack([vectors[s : s + BLOCK].min(axis=0) for s in starts])
    positive = np.where(queries > 0, queries, 0)
    bounds = positive @ high.T + (queries - positive) @ low.T
    order = np.argsort(-bounds, axis=1, kind="stable")

    nothing = -np.inf
    best = np.full((len(queries), k), nothing, vectors.dtype)
    best_ids = np.full((len(queries), k), np.iinfo(np.int64).max)
    going = np.ones(len(queries), bool)
    for turn in range(len(starts)):
        block = order[:, turn]
        going &= bounds[np.arange(len(queries)), block] >= best[:, -1]
        if not going.any():
            break
        for at in np.unique(block[going]):
            rows = np.flatnonzero(going & (block == at))
            own = ids[starts[at] : starts[at] + BLOCK]
            scores = queries[rows] @ vectors[starts[at] : starts[at] + BLOCK].T
            scores = np.where(query_ids[rows][:, None] == own[None, :], nothing, scores)
            hit = (scores >= best[rows][:, -1:]).any(axis=1)
            rows, scores = rows[hit], scores[hit]
            if not len(rows):
                continue
            all_ids = np.hstack([best_ids[rows], np.broadcast_to(own, scores.shape)])
            best[rows], best_ids[rows] = _best(np.hstack([best[rows], scores]), all_ids, k)
    found = [np.flatnonzero(row != nothing) for row in best]
    return [
        (row, int(best_ids[row, place]), int(best[row, place]))
        for row, places in enumerate(found)
        for place in places
    ]


def _search(k: int) -> Callable:
    def run(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        rows, ids, scores, weights = [], [], [], []
        if len(queries) and len(vectors):
            vectors = vectors.sort_by("id")
            asked, there = queries.column("weights").to_pylist(), vectors.column("weights").to_pylist()
            width = max(map(len, asked + there))
            own = queries.column("id").to_numpy()
            found = search_range(
                own, _matrix(asked, width), vectors.column("id").to_numpy(), _matrix(there, width), k
            )
            keys = queries.column("key").to_pylist()
            for row, vector, score in found:
                rows.append(int(own[row]))
                weights.append(keys[row])
                ids.append(vector)
                scores.append(score)
        return pa.table(
            {
                "query_id": pa.array(rows, pa.int64()),
                "key": pa.array(weights, pa.int64()),
                "id": pa.array(ids, pa.int64()),
                "score": pa.array(scores, pa.int64()),
            }
        )

    return run


def top_k(
    vectors: DataFrame,
    k: int,
    is_query,
    scale: int = 64,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` rows with the highest inner product of
    ``floor(scale * component)`` for every row that meets ``is_query``, a condition on
    ``id``; equal scores go by the smaller id.

    Rows with a null id or vector, or a null, infinite or undefined component, take
    no part. Of vectors of unlike length the shorter one ends in zeros. All rows with
    the query's id are its own and aren't candidates; other repeated rows are
    candidates each. Unlike vectors under one query id are separate queries. A score
    must fit into 64 bits. Other columns aren't read; an empty table gives no rows.
    """
    clean = vectors.select(F.col(id_col).cast("long"), F.col(vector_col)).mapInArrow(_quantised(scale), VECTOR)
    clean = materialize(clean, "vectors")
    asked = clean.where(is_query).distinct().withColumn("key", F.xxhash64("weights"))
    n, n_asked = clean.count(), asked.count()
    chunks = -(-n_asked // CHUNK) or 1
    ranges = -(-n // RANGE) or 1
    ranged = clean.repartitionByRange(ranges, "id").withColumn("range", F.spark_partition_id())
    ranged = materialize(ranged, "ranged")

    # One copy of a query per range, and one of a vector per chunk of queries.
    chunk = F.pmod(F.xxhash64("id", "key"), F.lit(chunks)).cast("int").alias("chunk")
    numbers = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    asked = asked.select("*", chunk).withColumn("range", numbers(ranges))
    there = ranged.withColumn("chunk", numbers(chunks))
    found = (
        asked.groupBy("chunk", "range")
        .cogroup(there.groupBy("chunk", "range"))
        .applyInArrow(_search(k), "query_id long, key long, id long, score long")
    )
    best = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score")
