"""Exact ranks without a global sort.

Rows are ordered by ``md5(id:seed)``. The first hex digits of that text are an
order-preserving bucket, and because md5 is uniform the buckets are balanced
however skewed the ids or classes are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintagemart.operators.joins import broadcast_if, has_at_most

# Rows that one bucket holds on average, at most.
BUCKET_ROWS = 100_000

# Up to this many groups, the offsets (a row per group and bucket) are broadcast.
MAX_GROUPS = 16


def shuffle_key(ids: Sequence[str], seed: int | str) -> Column:
    """Reproducible pseudo-random text per id, independent of the partitioning."""
    return F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in ids], F.lit(str(seed))))


def bucket_digits(rows: int) -> int:
    """Hex digits of the key that cut so many rows into bounded buckets."""
    digits = 1
    while rows > BUCKET_ROWS * 16**digits:
        digits += 1
    return digits


def unit_interval(text: Column) -> Column:
    """Uniform number in [0, 1) from the first 12 hex digits of an md5 text."""
    return F.conv(F.substring(text, 1, 12), 16, 10).cast("double") / F.lit(float(16**12))


def small_int(text: Column, modulus: int | Column) -> Column:
    """Integer in [0, modulus) from hex digits 13-24 of an md5 text."""
    bound = modulus if isinstance(modulus, Column) else F.lit(modulus)
    return F.pmod(F.conv(F.substring(text, 13, 12), 16, 10).cast("bigint"), bound)


def shuffled_row_number(
    df: DataFrame,
    ids: Sequence[str],
    seed: int | str,
    groups: Sequence[str] = (),
    name: str = "row_number",
) -> DataFrame:
    """Dense 1-based position of every row in md5 order, per group.

    Position = rows in earlier buckets + position inside the bucket; the window
    sorts one bucket at a time, and there are as many buckets as a count of the
    rows asks for.
    """
    keyed = df.withColumn("__key", shuffle_key(ids, seed)).withColumn(
        "__bucket", F.substring("__key", 1, bucket_digits(df.count()))
    )
    sizes = keyed.groupBy(*groups, "__bucket").agg(F.count("*").alias("__n"))
    earlier = (
        Window.partitionBy(*groups)
        .orderBy("__bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.select(
        *[F.col(g).alias(f"__g_{g}") for g in groups],
        F.col("__bucket").alias("__b"),
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__offset"),
    )
    inside = Window.partitionBy(*groups, "__bucket").orderBy("__key", *ids)
    ranked = keyed.withColumn("__position", F.row_number().over(inside))
    same = ranked["__bucket"] == offsets["__b"]
    for g in groups:
        same = same & ranked[g].eqNullSafe(offsets[f"__g_{g}"])
    few = has_at_most(df, groups, MAX_GROUPS)
    return (
        ranked.join(broadcast_if(offsets, few), same)
        .withColumn(name, F.col("__offset") + F.col("__position"))
        .drop("__key", "__bucket", "__b", "__offset", "__position", *[f"__g_{g}" for g in groups])
    )
