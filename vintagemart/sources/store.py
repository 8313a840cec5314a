"""Snapshot stores: one parquet table per name, partitioned by snapshot date."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from vintagemart.operators.snapshots import snapshot_range


def write_snapshots(
    df: DataFrame, path: str, partition_by: Sequence[str] = ("snapshot_date",)
) -> None:
    """Replace exactly the partitions that occur in ``df``; re-running a month is
    idempotent.

    The rebalance hint groups rows by partition before the write, and AQE then
    splits a month that is far larger than the others over several files.
    """
    (
        df.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def read_snapshots(
    spark: SparkSession,
    path: str,
    first: date | str | None = None,
    last: date | str | None = None,
    schema: StructType | None = None,
    date_col: str = "snapshot_date",
) -> DataFrame:
    """All snapshots, or the pruned range ``[first, last]``."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    return snapshot_range(df, first, last, date_col=date_col)


def read_snapshot(spark: SparkSession, path: str, snapshot: date | str) -> DataFrame:
    return read_snapshots(spark, path, snapshot, snapshot)


def union_by_name(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of tables whose columns may differ; absent columns are null."""
    if not parts:
        raise ValueError("nothing to read")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def scan_files(spark: SparkSession, root: str) -> DataFrame:
    """Every parquet file below a folder, whatever its directory depth."""
    return spark.read.option("recursiveFileLookup", "true").parquet(root)
