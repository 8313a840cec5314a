"""Pearson correlations of wide tables, in tiles of the matrix.

Tasks turn each batch of rows into tiles of cross products; these are summed by one
grouped aggregate, with partial sums before the shuffle. Rows are never shuffled, and no
task or driver holds the matrix: the driver sees three numbers per feature.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagemart.sources.scratch import materialize

# Columns of a tile.
TILE = 32
# Numbers that a task works on at once.
VALUES = 1 << 22

# Row of a tile that holds the sums of its columns.
TOTAL = -1

_SUMMARY = "j int, n long, unfit long, total double, low double, high double"


def _matrices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    rows = max(1, VALUES // width)
    for batch in batches:
        for start in range(0, len(batch), rows):
            values = batch.slice(start, rows).column(0).flatten()
            yield values.to_numpy(zero_copy_only=False).reshape(-1, width)


def _summaries(width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _matrices(batches, width):
            columns = [
                pa.array(np.arange(width), pa.int32()),
                pa.array(np.full(width, len(x))),
                pa.array((~np.isfinite(x)).sum(axis=0)),
                *[pa.array(reduce(x, axis=0)) for reduce in (np.sum, np.min, np.max)],
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["j", "n", "unfit", "total", "low", "high"])

    return run


def _tiles(mean: np.ndarray, scale: np.ndarray) -> Callable:
    width = len(mean)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _matrices(batches, width):
            z = (x - mean) * scale
            for block, first in enumerate(range(0, width, TILE)):
                right = z[:, first : first + TILE]
                last = first + right.shape[1]
                sums = np.zeros((last + 1, TILE))
                sums[:last, : right.shape[1]] = z[:, :last].T @ right
                sums[last, : right.shape[1]] = right.sum(axis=0)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([*range(last), TOTAL], pa.int32()),
                        pa.array(np.full(len(sums), block), pa.int32()),
                        *[pa.array(np.ascontiguousarray(c)) for c in sums.T],
                    ],
                    names=["i", "block", *[f"s{k}" for k in range(TILE)]],
                )

    return run


def tiled_correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(earlier, later, corr) of every pair of features, in the order of ``columns``.

    Features are shifted by their mean and divided by their range before products are
    summed, and what rounding left of the mean is taken off afterwards, so neither large
    offsets nor large values lose digits. A constant feature,
    and every feature of an empty table, has no correlation: null. Nulls, NaN and
    infinite values are an error that names the features; fill them first. Other columns
    of ``df`` aren't read.
    """
    spark = df.sparkSession
    width = len(columns)
    if width < 2:
        return spark.createDataFrame([], "earlier string, later string, corr double")
    rows = df.select(F.array(*[F.col(c).cast("double") for c in columns]).alias("v"))
    summary = rows.mapInArrow(_summaries(width), _SUMMARY).groupBy("j").agg(
        F.sum("unfit").alias("unfit"),
        F.sum("n").alias("n"),
        (F.sum("total") / F.sum("n")).alias("mean"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )
    mean, scale, unfit, n = np.zeros(width), np.zeros(width), [], 0
    for row in summary.collect():
        n = row["n"]
        if row["unfit"]:
            unfit.append(row["j"])
        elif row["high"] > row["low"]:
            # A mean of constants need not be exact, so the range tells them.
            mean[row["j"]], scale[row["j"]] = row["mean"], 1 / (row["high"] - row["low"])
    if unfit:
        raise ValueError(f"null or not finite: {[columns[j] for j in sorted(unfit)]}")
    if not scale.any():
        # Constants only, or no rows: nothing to sum.
        place = F.posexplode(F.array(*map(F.lit, columns)))
        one = spark.range(1).select(place.alias("i", "earlier"))
        two = spark.range(1).select(place.alias("j", "later"))
        return one.join(two, F.col("i") < F.col("j")).select("earlier", "later", F.lit(None).cast("double").alias("corr"))
    schema = "i int, block int, " + ", ".join(f"s{k} double" for k in range(TILE))
    sums = [F.sum(f"s{k}").alias(f"s{k}") for k in range(TILE)]
    tiles = rows.mapInArrow(_tiles(mean, scale), schema).groupBy("i", "block").agg(*sums)
    # Read twice: for the spreads and for the pairs.
    tiles = materialize(tiles, "correlation-tiles")
    cells = tiles.select("i", "block", F.posexplode(F.array(*[f"s{k}" for k in range(TILE)])).alias("k", "s"))
    cells = cells.select("i", (F.col("block") * TILE + F.col("k")).alias("j"), "s")
    square, off = np.zeros(width), np.zeros(width)
    for row in cells.where((F.col("i") == F.col("j")) | (F.col("i") == TOTAL) & (F.col("j") < width)).collect():
        if row["i"] == TOTAL:
            off[row["j"]] = row["s"] / np.sqrt(n)
        else:
            square[row["j"]] = row["s"]
    spread = np.sqrt(square - off**2)
    # One row per feature, however long the table is.
    features = [
        (j, c, float(off[j]), float(spread[j]) if scale[j] else None) for j, c in enumerate(columns)
    ]
    features = F.broadcast(spark.createDataFrame(features, "j int, name string, off double, spread double"))
    one = features.toDF("i", "earlier", "off_i", "spread_i")
    two = features.toDF("j", "later", "off_j", "spread_j")
    pairs = cells.where(F.col("i").between(0, F.col("j") - 1)).join(one, "i").join(two, "j")
    corr = F.try_divide(F.col("s") - F.col("off_i") * F.col("off_j"), F.col("spread_i") * F.col("spread_j"))
    # Null stays null; rounding can pass 1.
    bounded = F.when(corr > 1, 1.0).when(corr < -1, -1.0).otherwise(corr)
    return pairs.select("earlier", "later", bounded.alias("corr"))


def tiled_correlated_features(df: DataFrame, columns: Sequence[str], limit: float) -> list[str]:
    """Features whose absolute correlation with any earlier one exceeds ``limit``; only
    their names reach the driver."""
    if len(columns) < 2:
        return []
    strongest = tiled_correlations(df, columns).groupBy("later").agg(F.max(F.abs("corr")).alias("most"))
    found = {r["later"] for r in strongest.where(F.col("most") > limit).collect()}
    return [c for c in columns if c in found]
