"""Score whole ranges of snapshots with a registered model."""

from __future__ import annotations

from datetime import date

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from vintagemart.functions.dates import as_date
from vintagemart.operators import aggregates, columns, modelling, snapshots
from vintagemart.plans.lake import Lake
from vintagemart.sources import files, registry, store


def latest_model(spark: SparkSession, lake: Lake, fallback: DataFrame | None = None) -> Row:
    """The newest registered model, else the given record, else an error."""
    return registry.latest_or(registry.read_registry(spark, lake.registry), fallback).first()


def _version(model: Row) -> str:
    """The model's AUC; a record without metrics has none."""
    return str(model["metrics"]["auc"]) if model["metrics"] else "unknown"


def prepare_inference_data(
    features: DataFrame,
    first: date | str,
    last: date | str,
    feature_columns: list[str] | None,
) -> DataFrame:
    """Ids and the feature array; ids travel with their row, nothing is aligned by position."""
    rows = snapshots.snapshot_range(features, first, last)
    rows = columns.rename_first_present(
        rows, columns.CUSTOMER_ID_NAMES, "Customer_ID", "customer id"
    )
    names = feature_columns or columns.feature_columns(
        rows, exclude=columns.ID_COLUMNS + columns.LABEL_NAMES
    )
    keep = [c for c in ("Customer_ID", "loan_id", "snapshot_date") if c in rows.columns]
    aligned = columns.align_features(rows, names, keep)
    return aligned.select(*keep, F.array(*names).alias("features"))


def execute_predictions(
    model: Row, inference: DataFrame, prediction_date: date | str
) -> DataFrame:
    """Probability and class per row; the version column holds the model's AUC."""
    keep = [c for c in inference.columns if c != "features"]
    fitted = PipelineModel.load(model["model_path"])
    scored = modelling.predict(fitted, modelling.with_vector(inference), keep)
    return modelling.stamp_predictions(
        scored, model["model_name"], _version(model), prediction_date
    )


def run(
    spark: SparkSession,
    lake: Lake,
    features: DataFrame,
    first: date | str,
    last: date | str,
    prediction_date: date | str,
    fallback: DataFrame | None = None,
) -> DataFrame:
    """All snapshots of the range in one job; returns the summary row.

    Predictions of other prediction dates stay. ``fallback`` is the record of the
    model to use while none is registered, such as the one just trained.
    """
    model = latest_model(spark, lake, fallback)
    inference = prepare_inference_data(features, first, last, model["feature_columns"])
    columns.require_rows(inference, 1, f"features from {first} to {last}")
    predictions = execute_predictions(model, inference, prediction_date)
    path = lake.path("gold", "predictions")
    store.write_snapshots(predictions, path, ["model_name", "prediction_date", "snapshot_date"])
    stored = store.read_snapshots(spark, path, first, last).where(
        (F.col("model_name") == model["model_name"])
        & (F.col("prediction_date") == F.lit(as_date(prediction_date)))
    )
    summary = aggregates.prediction_summary(stored).select(
        F.lit(as_date(prediction_date)).alias("prediction_date"),
        "*",
        F.lit(model["model_name"]).alias("model_name"),
        F.lit(model["metrics"]["auc"] if model["metrics"] else None)
        .cast("double")
        .alias("model_auc"),
    )
    files.write_json_record(
        summary, lake.path("gold", f"prediction_summary/{as_date(prediction_date):%Y%m%d}")
    )
    return summary


def score_version(
    spark: SparkSession,
    lake: Lake,
    version: str,
    features: DataFrame,
    first: date | str,
    last: date | str,
    prefix: str = "fe_",
) -> DataFrame:
    """Probabilities of a model saved under its version, for a range of snapshots.

    One month and a backfill of years are the same job; a re-run replaces the
    months it scores. Returns the stored rows of the range.
    """
    rows = snapshots.snapshot_range(features, first, last)
    names = [c for c in rows.columns if c.startswith(prefix)]
    model = PipelineModel.load(lake.model(version))
    keys = ["Customer_ID", "snapshot_date"]
    scored = modelling.predict(model, columns.coerce_numeric(rows, names), keys)
    path = lake.path("gold", "model_predictions")
    store.write_snapshots(
        scored.select(
            *keys,
            F.lit(version).alias("model_name"),
            F.col("prediction_probability").alias("model_predictions"),
        ),
        path,
        ["model_name", "snapshot_date"],
    )
    return store.read_snapshots(spark, path, first, last).where(F.col("model_name") == version)
