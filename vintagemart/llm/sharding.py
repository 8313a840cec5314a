"""Contiguous shards of near equal byte size by global prefix sums.

Rows get one global order, by a hash of the text and the id, so that equal texts
stand together. Range partitions of that order are summed up, the totals of earlier
partitions (one row per partition) are added to running sums within partitions, and
the running total is cut at equal targets. The order ends in the id, so a group of
copies of any size spreads over partitions; a group is summed up inside each, and
those at a partition's ends (two at most) over all. DataFrame operations only; what
moves is the columns asked for, not the texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintagemart.sources.scratch import materialize


def shard_by_bytes(
    docs: DataFrame,
    shards: int,
    columns: list[str],
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``columns`` of every row of ``docs`` with ``shard_size`` (UTF-8 bytes of the
    text plus 1), ``shard`` (0 .. shards - 1) and ``slot`` (0, 1, ... in each shard).

    A row belongs to the shard in whose equal part of all bytes it begins, so shards
    differ by the largest document at most. A group of equal texts no larger than that
    document stays whole, in the shard where the group begins; larger groups are cut
    like other rows, as a group may be larger than a shard.

    A null text counts as none (size 1) and is in no group. Null and
    repeated ids are rows like others; which of fully equal rows comes first is open.
    Shards may be empty if there are few rows, as all are for an empty table. Names
    that the result adds are refused among ``columns``.
    """
    added = {"shard_size", "shard", "slot"}
    if added & set(columns):
        raise ValueError(f"there are such columns already: {sorted(added & set(columns))}")
    if shards < 1:
        raise ValueError("at least one shard is needed")
    names = [f"c{i}" for i in range(len(columns))]
    text, size = F.col(text_col), F.coalesce(F.octet_length(text_col), F.lit(0)) + F.lit(1)
    rows = docs.select(
        *[F.col(c).alias(n) for c, n in zip(columns, names)],
        F.when(text.isNotNull(), F.xxhash64(text)).alias("text_key"),
        F.col(id_col).alias("row_id"),
        size.cast("long").alias("size"),
    )
    order = ["text_key", "row_id"]
    ranged = rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    ranged = materialize(ranged, "ranged")

    totals = ranged.groupBy("part").agg(
        F.sum("size").alias("bytes"),
        F.count("*").alias("rows"),
        F.max("size").alias("largest"),
        F.min("text_key").alias("first_key"),
        F.max("text_key").alias("last_key"),
    )
    whole = totals.agg(F.sum("bytes"), F.max("largest")).first()
    total, largest = whole[0] or 1, whole[1] or 1
    # One row per partition, so one task is enough for this window.
    earlier = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"),
    )
    within = Window.partitionBy("part").orderBy(*order)
    so_far = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    same = Window.partitionBy("part", "text_key")
    placed = (
        ranged.withColumn("bytes_here", F.sum("size").over(so_far) - F.col("size"))
        .withColumn("rows_here", F.row_number().over(within) - 1)
        .withColumn("group_size", F.sum("size").over(same))
        .withColumn("group_here", F.min("bytes_here").over(same))
        .join(starts, "part")
        .withColumn("start", F.col("bytes_before") + F.col("bytes_here"))
        .withColumn("group_start", F.col("bytes_before") + F.col("group_here"))
        .withColumn("rank", F.col("rows_before") + F.col("rows_here"))
    )
    placed = materialize(
        placed.select(*names, "text_key", "size", "start", "rank", "group_size", "group_start"), "placed"
    )

    # Only the first and the last group of a partition can go on in another one.
    ends = totals.select(F.explode(F.array("first_key", "last_key")).alias("text_key"))
    ends = ends.where(F.col("text_key").isNotNull()).distinct()
    across = placed.join(F.broadcast(ends), "text_key", "left_semi").groupBy("text_key")
    across = across.agg(F.sum("size").alias("all_size"), F.min("start").alias("all_start"))
    grouped = placed.join(F.broadcast(across), "text_key", "left")
    size, start = F.coalesce("all_size", "group_size"), F.coalesce("all_start", "group_start")
    stays = (size <= largest) & F.col("text_key").isNotNull()
    grouped = grouped.withColumn("begins", F.when(stays, start).otherwise(F.col("start")))
    # Whole numbers throughout: a target is never met a rounding error early.
    shard = F.expr(f"cast(begins as decimal(20, 0)) * {shards} div {total}")
    sharded = grouped.select(*names, "size", "rank", shard.cast("int").alias("shard"))
    first = sharded.groupBy("shard").agg(F.min("rank").alias("first"))
    return sharded.join(F.broadcast(first), "shard").select(
        *[F.col(n).alias(c) for c, n in zip(columns, names)],
        F.col("size").alias("shard_size"),
        "shard",
        (F.col("rank") - F.col("first")).alias("slot"),
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """Store the rows of ``shard_by_bytes`` in one folder per shard, in slot order
    within each file; a shard is dealt over several files by ranges of slots."""
    ranged = sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ranged.write.partitionBy("shard").parquet(path)
