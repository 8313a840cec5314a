"""Approximate nearest neighbours by random projections, in several hash tables.

A hash is the cell of width ``width`` into which a random direction puts a vector; near
vectors share cells. A bucket of a table is a run of equal hashes, as short as its size
allows: buckets that hold more points than a task should compare are split by the next
hash, and so on, so that dense regions get longer keys and sparse ones keep short keys.
Points that agree in all hashes are compared in blocks, none is left out. Distances of
candidates are exact; what may be missed is a neighbour that shares no bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vintagemart.operators.joins import broadcast_if, has_at_most
from vintagemart.operators.sampling import (
    BLOCK_ROWS,
    NEIGHBOURS,
    _closest,
    _each,
    _found_schema,
    _ranked,
    nearest_neighbours,
)
from vintagemart.sources.scratch import materialize

TABLES = 12
DEPTH = 3
MOST_DEPTH = 12
# Keys of overfull buckets that may be broadcast.
LISTED_BUCKETS = 50_000


def directions(dimensions: int, tables: int, depth: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions and offsets (in cells), a row per hash, table by table."""
    rng = np.random.default_rng(seed)
    return rng.normal(size=(tables * depth, dimensions)), rng.random(tables * depth)


def _hashed(tables: int, depth: int, width: float, seed: int) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for start in range(0, len(whole), 1024):
                batch = whole.iloc[start : start + 1024]
                rows = np.stack(batch["features"].to_numpy()).astype("float64")
                towards, offset = directions(rows.shape[1], tables, depth, seed)
                codes = np.floor(rows @ towards.T / width + offset).astype("int64")
                codes = codes.reshape(len(rows), tables, depth)
                for table in range(tables):
                    yield batch.assign(table=np.int32(table), codes=list(codes[:, table]))

    return run


def near_vectors(
    width: float,
    tables: int = TABLES,
    depth: int = DEPTH,
    most_depth: int = MOST_DEPTH,
    block_rows: int = BLOCK_ROWS,
    seed: int = 42,
) -> Callable[[DataFrame, int], DataFrame]:
    """A search among distinct vectors (id, features, ask) for ``nearest_neighbours``."""
    if width <= 0 or tables < 1 or not 1 <= depth <= most_depth:
        raise ValueError("width and tables must be positive, and depth from 1 to most_depth")

    def search(points: DataFrame, k: int) -> DataFrame:
        added = StructType.fromDDL("table int, codes array<bigint>")
        schema = StructType(points.schema.fields + added.fields)
        hashed = points.mapInPandas(_hashed(tables, most_depth, width, seed), schema)
        left = materialize(hashed, "lsh-hashed")
        ready = []
        for length in range(depth, most_depth + 1):
            key = F.xxhash64(F.slice("codes", 1, length))
            keyed = left.withColumn("bucket", key).withColumn("length", F.lit(length))
            sizes = keyed.groupBy("table", "bucket").agg(F.count("*").alias("n"))
            full = materialize(sizes.where(F.col("n") > block_rows), "lsh-full")
            few = has_at_most(full, ["table", "bucket"], LISTED_BUCKETS)
            if length == most_depth or full.isEmpty():
                # What all hashes leave together is cut into blocks.
                blocks = F.ceil(F.col("n") / F.lit(block_rows)).alias("n_sub")
                cut = broadcast_if(full.select("table", "bucket", blocks), few)
                ready.append(
                    keyed.join(cut, ["table", "bucket"], "left").withColumn(
                        "n_sub", F.coalesce("n_sub", F.lit(1))
                    )
                )
                break
            listed = broadcast_if(full.select("table", "bucket"), few)
            done = keyed.join(listed, ["table", "bucket"], "left_anti")
            ready.append(done.withColumn("n_sub", F.lit(1).cast("bigint")))
            left = materialize(
                keyed.join(listed, ["table", "bucket"], "left_semi").select(*left.columns), "lsh-left"
            )
        placed = reduce(DataFrame.unionByName, ready)
        block = ["table", "length", "bucket", "sub", "part"]
        at = lambda name: F.pmod(F.xxhash64(F.lit(name), "id"), F.col("n_sub")).alias(name)
        columns = ["table", "length", "bucket", "id", "features"]
        queries = placed.where("ask").select(*columns, at("part"), _each(F.col("n_sub")).alias("sub"))
        # Named anew, so that the two sides are told apart.
        anew = [F.col(c).alias(c) for c in columns]
        others = placed.select(*anew, at("sub"), _each(F.col("n_sub")).alias("part"))
        found = (
            queries.groupBy(*block)
            .cogroup(others.groupBy(*block))
            .applyInArrow(_closest(k), _found_schema(points))
        )
        # The same neighbour may be found in several tables.
        once = found.groupBy("id", "neighbour_id").agg(F.min("distance").alias("distance"))
        return _ranked(once, k)

    return search


def lsh_neighbours(
    points: DataFrame,
    width: float,
    k: int = NEIGHBOURS,
    id_col: str = "id",
    features_col: str = "features",
    wanted: DataFrame | None = None,
    **options,
) -> DataFrame:
    """Near points of every point: id, rank, neighbour_id, distance, at most ``k`` each.

    Like ``nearest_neighbours``, copies of a vector included, but a neighbour that never
    shares a bucket is missed; ``recall`` measures how many are. Wider cells, more tables
    and fewer hashes find more and compare more.
    """
    return nearest_neighbours(
        points, k, id_col, features_col, wanted=wanted, search=near_vectors(width, **options)
    )


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: neighbours of the exact search, how many of them were found, the share."""
    hit = found.select("id", "neighbour_id", F.lit(1).alias("hit"))
    joined = exact.join(hit, ["id", "neighbour_id"], "left")
    return joined.agg(F.count("*").alias("n_exact"), F.count("hit").alias("n_found")).withColumn(
        "recall", F.try_divide("n_found", "n_exact")
    )
