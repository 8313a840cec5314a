"""Predictions against actuals: performance, drift, decision, report."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintagemart.functions.dates import as_date
from vintagemart.operators import columns, decisions, drift, evaluation, joins, monitoring_state
from vintagemart.operators.snapshots import snapshot_range
from vintagemart.plans.lake import Lake
from vintagemart.sources import files, store
from vintagemart.sources.scratch import materialize


@dataclass(frozen=True)
class Monitoring:
    matched: DataFrame
    performance: DataFrame
    skipped: DataFrame
    drift: DataFrame
    decision: DataFrame
    report: DataFrame


def load_actuals(features: DataFrame) -> DataFrame:
    """Keys and ``actual_label`` under whatever names the table uses."""
    df = columns.rename_first_present(
        features, columns.CUSTOMER_ID_NAMES, "Customer_ID", "customer id"
    )
    df = columns.rename_first_present(df, columns.LABEL_NAMES, "actual_label", "label")
    keep = [c for c in ("Customer_ID", "loan_id", "snapshot_date") if c in df.columns]
    return df.select(*keep, "actual_label")


def monitor(
    predictions: DataFrame,
    actuals: DataFrame,
    baseline: date | str,
    report_date: date | str,
    row_id: list[str] | None = None,
    auc_limit: float = decisions.RETRAIN_AUC,
    psi_limit: float = decisions.RETRAIN_PSI,
    **options,
) -> Monitoring:
    """The join is written once; performance and drift read the written rows.

    Without a single snapshot that has metrics there is nothing to decide on: an error.
    """
    matched = materialize(
        joins.align_predictions(predictions, actuals, row_id=row_id), "matched"
    )
    columns.require_rows(matched, 1, "predictions with actuals")
    performance = materialize(evaluation.performance_by_group(matched), "performance")
    columns.require_rows(performance, 1, "snapshots with valid metrics")
    skipped = materialize(evaluation.skipped_groups(matched), "skipped")
    shifts = materialize(drift.psi_by_snapshot(matched, baseline), "drift")
    return _judged(matched, performance, skipped, shifts, report_date, auc_limit, psi_limit, **options)


def _judged(
    matched: DataFrame,
    performance: DataFrame,
    skipped: DataFrame,
    shifts: DataFrame,
    report_date: date | str,
    auc_limit: float = decisions.RETRAIN_AUC,
    psi_limit: float = decisions.RETRAIN_PSI,
    **options,
) -> Monitoring:
    """Decision and report from the metrics of the snapshots."""
    summary = decisions.monitoring_summary(performance, shifts)
    decision = decisions.retraining_decision(summary, auc_limit, psi_limit, **options)
    decision = decision.withColumn("checked_timestamp", F.current_timestamp())
    report = decisions.decide(summary, auc_limit, psi_limit, **options).select(
        F.lit(as_date(report_date)).alias("report_date"),
        F.current_timestamp().alias("generated_timestamp"),
        F.struct("avg_auc", "avg_precision", "avg_recall", "avg_f1").alias("performance_summary"),
        F.struct("max_psi", "avg_psi").alias("drift_summary"),
        "needs_retraining",
        F.col("reasons").alias("retraining_reasons"),
    )
    return Monitoring(matched, performance, skipped, shifts, decision, report)


def update_state(
    spark: SparkSession,
    lake: Lake,
    predictions: DataFrame,
    actuals: DataFrame,
    row_id: list[str] | None = None,
) -> DataFrame:
    """Match the predictions, replace the stored state of the snapshots they are of, and
    give back the matched rows."""
    matched = materialize(joins.align_predictions(predictions, actuals, row_id=row_id), "matched")
    state = monitoring_state.score_state(matched)
    store.write_snapshots(state, lake.path("gold", "monitoring/state"), monitoring_state.KEYS)
    return matched


def run(
    spark: SparkSession,
    lake: Lake,
    features: DataFrame,
    baseline: date | str,
    report_date: date | str,
    first: date | str | None = None,
    last: date | str | None = None,
    model_name: str | None = None,
    prediction_date: date | str | None = None,
    row_id: list[str] | None = None,
    **options,
) -> Monitoring:
    """Merge the predictions of ``[first, last]`` (all, if open) into the stored state and
    report on all snapshots in it. Months that aren't named are not read again.

    ``model_name`` and ``prediction_date`` choose among predictions; without them each
    snapshot counts once, as it was predicted last. What a report found is stored under
    its date, beside that of other dates.
    """
    predictions = store.read_snapshots(spark, lake.path("gold", "predictions"), first, last)
    if model_name is not None:
        predictions = predictions.where(F.col("model_name") == model_name)
    if prediction_date is not None:
        predictions = predictions.where(F.col("prediction_date") == F.lit(as_date(prediction_date)))
    actuals = snapshot_range(load_actuals(features), first, last)
    matched = update_state(spark, lake, predictions, actuals, row_id)
    columns.require_rows(matched, 1, "predictions with actuals")

    stored = store.read_snapshots(spark, lake.path("gold", "monitoring/state"))
    state = materialize(monitoring_state.chosen_state(stored, model_name, prediction_date), "state")
    counts = materialize(evaluation.summed_counts(state, ["snapshot_date"]), "counts")
    performance = evaluation.performance_of(counts, ["snapshot_date"])
    columns.require_rows(performance, 1, "snapshots with valid metrics")
    skipped = monitoring_state.skipped_from_state(state, counts)
    shifts = drift.psi_of_histogram(monitoring_state.histogram_from_state(state), baseline)
    shifts = materialize(shifts, "drift")
    result = _judged(matched, performance, skipped, shifts, report_date, **options)

    dated = {
        "performance_metrics": result.performance,
        "skipped_snapshots": result.skipped,
        "drift_metrics": result.drift,
    }
    day = F.lit(as_date(report_date)).alias("report_date")
    for name, rows in dated.items():
        path = lake.path("gold", f"monitoring/{name}")
        store.write_snapshots(rows.select("*", day), path, ["report_date"])
    text = f"{as_date(report_date):%Y%m%d}"
    summary = joins.match_summary(predictions, actuals)
    records = {"threshold_check": result.decision, "report": result.report, "data_summary": summary}
    for name, row in records.items():
        files.write_json_record(row, lake.path("gold", f"monitoring/{name}_{text}"))
    return result


def retraining_needed(result: Monitoring) -> bool:
    return bool(result.decision.first()["needs_retraining"])
