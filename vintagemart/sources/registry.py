"""Model registry: one row per saved model, the model itself beside it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintagemart import schemas
from vintagemart.sources import files


def register(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The registered models; no rows while there is no registry."""
    if not files.exists(spark, path):
        return spark.createDataFrame([], schemas.MODEL_REGISTRY)
    return spark.read.schema(schemas.MODEL_REGISTRY).parquet(path)


def latest(
    registry: DataFrame,
    keys: Sequence[str] = (),
    timestamp: str = "timestamp",
    tie: str = "model_path",
) -> DataFrame:
    """The newest row, of the registry or per key, by its own timestamp.

    ``max_by`` keeps one row per key while it scans; nothing is sorted.
    """
    # Maps cannot be compared but can be carried along.
    newest = F.max_by(F.struct(*registry.columns), F.struct(F.col(timestamp), F.col(tie)))
    picked = registry.groupBy(*keys).agg(newest.alias("row")).where("row is not null")
    return picked.select("row.*")


def latest_or(registry: DataFrame, fallback: DataFrame | None) -> DataFrame:
    """The newest registered model, else the given record."""
    found = latest(registry)
    if found.isEmpty():
        if fallback is None or fallback.isEmpty():
            raise ValueError("no model is registered")
        return fallback
    return found
