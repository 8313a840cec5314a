"""Predictions against actuals, drift, decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from querybook import views
from querybook.registry import query
from querybook.views import day_text, psi_sql
from vintagemart.operators import (
    aggregates,
    columns,
    decisions,
    drift,
    evaluation,
    joins,
    monitoring_state,
    snapshots,
)
from vintagemart.plans import monitoring as monitoring_plan
from vintagemart.sources import store
from vintagemart.sources.scratch import scratch_path

BASELINE = "2024-01-10"
ABSENT = "2020-01-01"


def _predictions(spark, sf_dir):
    return views.prediction(spark, sf_dir).drop("actual_label")


def _raw_actuals(spark, sf_dir):
    """Actuals under other column names; sign-ups have none yet."""
    events = views.table(spark, sf_dir, "events").where(F.col("event_type") != "signup")
    return events.select(
        F.concat(F.lit("CUS_"), F.col("user_id").cast("string")).alias("user_id"),
        F.concat(F.lit("LOAN_"), F.col("event_id").cast("string")).alias("loan_id"),
        F.col("ts").cast("date").alias("snapshot_date"),
        (F.col("event_type") == "error").cast("int").alias("label"),
    )


def _actuals(spark, sf_dir):
    df = columns.rename_first_present(
        _raw_actuals(spark, sf_dir), columns.CUSTOMER_ID_NAMES, "Customer_ID", "customer id"
    )
    return columns.rename_first_present(df, columns.LABEL_NAMES, "actual_label", "label")


_ACTUALS = """
    SELECT 'CUS_' || user_id AS Customer_ID, 'LOAN_' || event_id AS loan_id,
           CAST(ts AS DATE) AS snapshot_date, CAST(event_type = 'error' AS INTEGER) AS actual_label
    FROM events WHERE event_type <> 'signup'"""


@query(
    "resolve_column_alias",
    f"""SELECT Customer_ID, loan_id, CAST(snapshot_date AS VARCHAR) AS snapshot_date, actual_label
        FROM ({_ACTUALS})""",
)
def resolve_column_alias(spark, sf_dir):
    return day_text(_actuals(spark, sf_dir), "snapshot_date")


@query(
    "align_predictions_actuals",
    f"""SELECT p.Customer_ID, p.loan_id, CAST(p.snapshot_date AS VARCHAR) AS snapshot_date,
               p.prediction_probability, p.prediction_binary, a.actual_label
        FROM v_pred p JOIN ({_ACTUALS}) a
             ON p.Customer_ID IS NOT DISTINCT FROM a.Customer_ID
            AND p.loan_id IS NOT DISTINCT FROM a.loan_id
            AND p.snapshot_date IS NOT DISTINCT FROM a.snapshot_date""",
)
def align_predictions_actuals(spark, sf_dir):
    merged = joins.align_predictions(
        _predictions(spark, sf_dir), _actuals(spark, sf_dir), row_id=["loan_id"]
    )
    return day_text(merged, "snapshot_date")


@query(
    "match_summary",
    f"""SELECT (SELECT count(*) FROM v_pred) AS n_predictions,
               (SELECT count(*) FROM ({_ACTUALS})) AS n_actuals, count(*) AS n_matched,
               count(*)::DOUBLE / (SELECT count(*) FROM v_pred) AS match_rate,
               CAST(min(p.snapshot_date) AS VARCHAR) AS min_date,
               CAST(max(p.snapshot_date) AS VARCHAR) AS max_date
        FROM v_pred p JOIN ({_ACTUALS}) a
             ON p.Customer_ID = a.Customer_ID AND p.loan_id = a.loan_id
            AND p.snapshot_date = a.snapshot_date""",
)
def match_summary(spark, sf_dir):
    df = joins.match_summary(_predictions(spark, sf_dir), _actuals(spark, sf_dir))
    return day_text(df, "min_date", "max_date")


@query(
    "extract_inference_window",
    """SELECT Customer_ID, loan_id, CAST(snapshot_date AS VARCHAR) AS snapshot_date
       FROM v_pred WHERE snapshot_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-12'""",
)
def extract_inference_window(spark, sf_dir):
    df = snapshots.snapshot_range(
        views.prediction(spark, sf_dir), first="2024-01-08", last="2024-01-12"
    )
    return day_text(df.select("Customer_ID", "loan_id", "snapshot_date"), "snapshot_date")


@query(
    "prediction_summary",
    """SELECT count(*) AS n_predictions, round(avg(prediction_probability), 8) AS mean_probability,
              round(stddev_pop(prediction_probability), 8) AS std_probability,
              CAST(sum(prediction_binary) AS BIGINT) AS predicted_defaults,
              sum(prediction_binary)::DOUBLE / count(*) AS default_rate
       FROM v_pred""",
)
def prediction_summary(spark, sf_dir):
    df = aggregates.prediction_summary(views.prediction(spark, sf_dir))
    return df.withColumns(
        {
            "mean_probability": F.round("mean_probability", 8),
            "std_probability": F.round("std_probability", 8),
        }
    )


@query(
    "score_histogram",
    """SELECT CAST(snapshot_date AS VARCHAR) AS snapshot_date, CAST(bin AS INTEGER) AS bin, n_rows
       FROM v_hist""",
)
def score_histogram(spark, sf_dir):
    histogram = drift.score_histogram(views.prediction(spark, sf_dir))
    return day_text(drift.histogram_long(histogram), "snapshot_date")


@query(
    "score_histogram_edges",
    """SELECT CAST(snapshot_date AS VARCHAR) AS snapshot_date, CAST(bin AS INTEGER) AS bin, n_rows
       FROM v_hist_edge""",
)
def score_histogram_edges(spark, sf_dir):
    histogram = drift.score_histogram(views.prediction_edge(spark, sf_dir))
    return day_text(drift.histogram_long(histogram), "snapshot_date")


def _psi(df):
    return day_text(df.withColumn("psi", F.round("psi", 8)), "snapshot_date")


_PSI_COLUMNS = """SELECT CAST(snapshot_date AS VARCHAR) AS snapshot_date, round(psi, 8) AS psi,
                         drift_status, num_samples"""


@query("psi_by_snapshot", f"{_PSI_COLUMNS} FROM v_psi")
def psi_by_snapshot(spark, sf_dir):
    return _psi(drift.psi_by_snapshot(views.prediction(spark, sf_dir), BASELINE))


@query("psi_by_snapshot_edges", f"{_PSI_COLUMNS} FROM ({psi_sql('v_hist_edge', '1998-01-01')})")
def psi_by_snapshot_edges(spark, sf_dir):
    return _psi(drift.psi_by_snapshot(views.prediction_edge(spark, sf_dir), "1998-01-01"))


@query("psi_baseline_fallback", f"{_PSI_COLUMNS} FROM ({psi_sql('v_hist', ABSENT)})")
def psi_baseline_fallback(spark, sf_dir):
    """The requested baseline has no rows: the earliest day serves and has no row itself."""
    return _psi(drift.psi_by_snapshot(views.prediction(spark, sf_dir), ABSENT))


@query(
    "drift_status_counts",
    "SELECT drift_status, count(*) AS n_snapshots FROM v_psi GROUP BY 1",
)
def drift_status_counts(spark, sf_dir):
    return drift.drift_status_counts(
        drift.psi_by_snapshot(views.prediction(spark, sf_dir), BASELINE)
    )


def _summary(spark, sf_dir):
    scored = views.prediction(spark, sf_dir)
    return decisions.monitoring_summary(
        evaluation.performance_by_group(scored), drift.psi_by_snapshot(scored, BASELINE)
    )


_SUMMARY = """
    SELECT (SELECT avg(auc) FROM v_performance) AS avg_auc,
           (SELECT avg("precision") FROM v_performance) AS avg_precision,
           (SELECT avg(recall) FROM v_performance) AS avg_recall,
           (SELECT avg(f1) FROM v_performance) AS avg_f1,
           (SELECT max(psi) FROM v_psi) AS max_psi, (SELECT avg(psi) FROM v_psi) AS avg_psi"""
_SUMMARY_NAMES = ("avg_auc", "avg_precision", "avg_recall", "avg_f1", "max_psi", "avg_psi")


@query(
    "monitoring_summary",
    f"SELECT {', '.join(f'round({c}, 8) AS {c}' for c in _SUMMARY_NAMES)} FROM ({_SUMMARY})",
)
def monitoring_summary(spark, sf_dir):
    return _summary(spark, sf_dir).select([F.round(c, 8).alias(c) for c in _SUMMARY_NAMES])


@query(
    "retraining_decision",
    f"""SELECT avg_auc < 0.5 OR max_psi > 0.2 AS needs_retraining,
               concat_ws('; ',
                   CASE WHEN avg_auc < 0.5
                        THEN printf('AUC below threshold: %.4f < 0.5', avg_auc) END,
                   CASE WHEN max_psi > 0.2
                        THEN printf('PSI above threshold: %.4f > 0.2', max_psi) END) AS reasons,
               0.5::DOUBLE AS auc_threshold, 0.5::DOUBLE AS precision_threshold,
               0.2::DOUBLE AS drift_threshold, round(avg_auc, 8) AS avg_auc,
               round(max_psi, 8) AS max_psi
        FROM ({_SUMMARY})""",
)
def retraining_decision(spark, sf_dir):
    decision = decisions.retraining_decision(_summary(spark, sf_dir))
    return decision.withColumns(
        {
            "reasons": F.concat_ws("; ", "reasons"),
            "avg_auc": F.round("avg_auc", 8),
            "max_psi": F.round("max_psi", 8),
        }
    )


_REPORT = (
    _SUMMARY.replace("v_performance", "m_performance").replace("v_psi", "m_psi")
)


@query(
    "monitoring_report",
    f"""SELECT '2024-02-01' AS report_date,
               {", ".join(f"round({c}, 8) AS {c}" for c in _SUMMARY_NAMES)},
               avg_auc < 0.5 OR max_psi > 0.2 AS needs_retraining
        FROM ({_REPORT})""",
)
def monitoring_report(spark, sf_dir):
    """The whole monitoring job: aligned rows, performance, drift, decision, report."""
    result = monitoring_plan.monitor(
        _predictions(spark, sf_dir),
        monitoring_plan.load_actuals(_raw_actuals(spark, sf_dir)),
        BASELINE,
        "2024-02-01",
        row_id=["loan_id"],
    )
    flat = result.report.select(
        "report_date", "performance_summary.*", "drift_summary.*", "needs_retraining"
    )
    return day_text(
        flat.withColumns({c: F.round(c, 8) for c in _SUMMARY_NAMES}), "report_date"
    )


_POLICY = """
    SELECT (SELECT avg(auc) FROM v_performance) AS avg_auc,
           (SELECT avg("precision") FROM v_performance) AS avg_precision,
           (SELECT max(psi) FROM v_psi) AS max_psi,
           (SELECT date_diff('month', min(snapshot_date), max(snapshot_date))
            FROM v_performance) AS age_months,
           (SELECT sum(num_samples) FROM v_performance) AS n_samples,
           (SELECT arg_min(auc, snapshot_date) - arg_max(auc, snapshot_date)
            FROM v_performance) AS auc_drop"""


@query(
    "refresh_policy_check",
    f"""WITH p AS ({_POLICY})
        SELECT 'auc' AS rule, round(avg_auc, 8) AS measured, 0.65::DOUBLE AS allowed,
               avg_auc < 0.65 AS breached FROM p
        UNION ALL SELECT 'precision', round(avg_precision, 8), 0.70::DOUBLE, avg_precision < 0.70
        FROM p
        UNION ALL SELECT 'psi', round(max_psi, 8), 0.1::DOUBLE, max_psi > 0.1 FROM p
        UNION ALL SELECT 'max_age_months', age_months::DOUBLE, 6::DOUBLE, age_months > 6 FROM p
        UNION ALL SELECT 'min_samples', n_samples::DOUBLE, 1000::DOUBLE, n_samples < 1000 FROM p
        UNION ALL SELECT 'rollback_auc_drop', round(auc_drop, 8), 0.05::DOUBLE, auc_drop > 0.05
        FROM p""",
)
def refresh_policy_check(spark, sf_dir):
    scored = views.prediction(spark, sf_dir)
    inputs = decisions.policy_inputs(
        evaluation.performance_by_group(scored), drift.psi_by_snapshot(scored, BASELINE)
    )
    return decisions.refresh_policy_check(inputs).withColumn("measured", F.round("measured", 8))


@query(
    "monitoring_skipped",
    """SELECT CAST(snapshot_date AS VARCHAR) AS snapshot_date, count(*) AS n_rows,
              count(*) FILTER (actual_label IS NULL) AS n_bad,
              CASE WHEN count(*) FILTER (actual_label IS NULL) > 0
                   THEN 'rows without a label, score or class' ELSE 'only one class' END AS reason
       FROM (SELECT snapshot_date,
                    CASE WHEN day(snapshot_date) % 3 = 0 AND event_id % 50 = 0 THEN NULL
                         WHEN day(snapshot_date) % 3 = 1 THEN 0
                         ELSE actual_label END AS actual_label FROM v_pred)
       GROUP BY snapshot_date
       HAVING count(*) FILTER (actual_label IS NULL) > 0
              OR max(actual_label) = min(actual_label)""",
)
def monitoring_skipped(spark, sf_dir):
    """Days without metrics: a label is missing, or all rows have one class."""
    third = F.dayofmonth("snapshot_date") % 3
    number = F.regexp_extract("loan_id", "[0-9]+", 0).cast("bigint")
    label = (
        F.when((third == 0) & (number % 50 == 0), F.lit(None).cast("int"))
        .when(third == 1, 0)
        .otherwise(F.col("actual_label"))
    )
    scored = views.prediction(spark, sf_dir).withColumn("actual_label", label)
    return day_text(evaluation.skipped_groups(scored), "snapshot_date")


# The one day whose state is stored twice, first from half of its rows.
RERUN = "2024-01-12"


@query(
    "monitoring_incremental",
    """SELECT CAST(p.snapshot_date AS VARCHAR) AS snapshot_date, p.num_samples,
              p.actual_default_rate, p.predicted_default_rate, round(p.auc, 10) AS auc,
              p."precision", p.recall, p.f1, p.tn, p.fp, p.fn, p.tp, round(v.psi, 8) AS psi,
              v.drift_status, (SELECT count(*) FROM v_pred) AS n_rows
       FROM v_performance p LEFT JOIN v_psi v ON v.snapshot_date = p.snapshot_date""",
)
def monitoring_incremental(spark, sf_dir):
    """State stored day range by day range, one day of it a second time; metrics and PSI
    of all days from the state alone."""
    scored = views.prediction(spark, sf_dir).select(
        F.lit("model").alias("model_name"), F.lit("2024-03-01").cast("date").alias("prediction_date"), "*"
    )
    path = scratch_path(spark, "monitoring-state")
    day = F.col("snapshot_date")
    half = F.pmod(F.xxhash64("loan_id"), F.lit(2)) == 0
    parts = [day < BASELINE, (day == RERUN) & half, (day >= BASELINE) & (day != RERUN), day == RERUN]
    for part in parts:
        state = monitoring_state.score_state(scored.where(part))
        store.write_snapshots(state, path, monitoring_state.KEYS)
    state = monitoring_state.chosen_state(store.read_snapshots(spark, path))
    performance = monitoring_state.performance_from_state(state)
    shifts = drift.psi_of_histogram(monitoring_state.histogram_from_state(state), BASELINE)
    rows = state.agg(F.sum("n_rows").alias("n_rows"))
    joined = performance.join(shifts.select("snapshot_date", "psi", "drift_status"), "snapshot_date", "left")
    rounded = joined.withColumns({"auc": F.round("auc", 10), "psi": F.round("psi", 8)})
    return day_text(rounded.join(F.broadcast(rows)), "snapshot_date")
