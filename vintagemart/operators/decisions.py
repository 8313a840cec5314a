"""Model selection, retraining decision, refresh policy."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Limits the monitoring job tests, and the declared refresh policy.
RETRAIN_AUC = 0.50
RETRAIN_PRECISION = 0.50
RETRAIN_PSI = 0.2
REFRESH_POLICY = {
    "auc": 0.65,
    "precision": 0.70,
    "psi": 0.1,
    "max_age_months": 6,
    "min_samples": 1000,
    "rollback_auc_drop": 0.05,
}
TIE_ORDER = ("logistic_regression", "random_forest")


def select_best_model(
    metrics: DataFrame, name: str = "model_name", tie_order: Sequence[str] = TIE_ORDER
) -> DataFrame:
    """The row with the highest AUC; ties go to the earlier name in ``tie_order``."""
    rank = F.lit(len(tie_order))
    for i in reversed(range(len(tie_order))):
        rank = F.when(F.col(name) == tie_order[i], F.lit(i)).otherwise(rank)
    best = F.max_by(
        F.struct(*metrics.columns),
        F.struct(F.col("auc"), -rank, F.lit(0)),
    )
    return metrics.agg(best.alias("best")).where("best is not null").select("best.*")


def monitoring_summary(performance: DataFrame, drift: DataFrame) -> DataFrame:
    """Unweighted means of the per-snapshot metrics, largest and mean PSI: one row."""
    metrics = performance.select("auc", "precision", "recall", "f1")
    rows = metrics.unionByName(drift.select("psi"), allowMissingColumns=True)
    return rows.agg(
        F.avg("auc").alias("avg_auc"),
        F.avg("precision").alias("avg_precision"),
        F.avg("recall").alias("avg_recall"),
        F.avg("f1").alias("avg_f1"),
        F.max("psi").alias("max_psi"),
        F.avg("psi").alias("avg_psi"),
    )


def _reason(breached: Column, text: str, value: Column, sign: str, limit: float) -> Column:
    shown = F.format_string(f"{text}: %.4f {sign} {limit}", value)
    return F.when(breached, shown)


def decide(
    summary: DataFrame,
    auc_limit: float = RETRAIN_AUC,
    psi_limit: float = RETRAIN_PSI,
    precision_limit: float = RETRAIN_PRECISION,
    test_precision: bool = False,
) -> DataFrame:
    """Add ``needs_retraining`` and ``reasons`` to the summary row.

    Retrain if the mean AUC is below or the largest PSI above its limit; the
    precision limit is only tested on request. A missing metric triggers nothing.
    """
    auc, psi, precision = F.col("avg_auc"), F.col("max_psi"), F.col("avg_precision")
    reasons = [
        _reason(auc < auc_limit, "AUC below threshold", auc, "<", auc_limit),
        _reason(psi > psi_limit, "PSI above threshold", psi, ">", psi_limit),
    ]
    if test_precision:
        below = precision < precision_limit
        reasons.append(_reason(below, "Precision below threshold", precision, "<", precision_limit))
    return summary.withColumn("reasons", F.array_compact(F.array(*reasons))).withColumn(
        "needs_retraining", F.size("reasons") > 0
    )


def retraining_decision(
    summary: DataFrame,
    auc_limit: float = RETRAIN_AUC,
    psi_limit: float = RETRAIN_PSI,
    precision_limit: float = RETRAIN_PRECISION,
    test_precision: bool = False,
) -> DataFrame:
    """The decision with the limits and metrics it rests on."""
    decided = decide(summary, auc_limit, psi_limit, precision_limit, test_precision)
    return decided.select(
        "needs_retraining",
        "reasons",
        F.lit(auc_limit).alias("auc_threshold"),
        F.lit(precision_limit).alias("precision_threshold"),
        F.lit(psi_limit).alias("drift_threshold"),
        "avg_auc",
        "max_psi",
    )


def refresh_policy_check(
    summary: DataFrame,
    policy: Mapping[str, float] | None = None,
) -> DataFrame:
    """One row per policy rule: measured value, limit, and whether it is breached.

    ``summary`` needs ``avg_auc, avg_precision, max_psi, age_months, n_samples,
    auc_drop``; a missing value breaches nothing.
    """
    limits = dict(REFRESH_POLICY, **(policy or {}))
    rules = [
        ("auc", "avg_auc", "<", limits["auc"]),
        ("precision", "avg_precision", "<", limits["precision"]),
        ("psi", "max_psi", ">", limits["psi"]),
        ("max_age_months", "age_months", ">", limits["max_age_months"]),
        ("min_samples", "n_samples", "<", limits["min_samples"]),
        ("rollback_auc_drop", "auc_drop", ">", limits["rollback_auc_drop"]),
    ]
    entries = []
    for rule, source, sign, limit in rules:
        value = F.col(source).cast("double")
        breached = value < F.lit(float(limit)) if sign == "<" else value > F.lit(float(limit))
        entries.append(
            F.struct(
                F.lit(rule).alias("rule"),
                value.alias("measured"),
                F.lit(float(limit)).alias("allowed"),
                F.coalesce(breached, F.lit(False)).alias("breached"),
            )
        )
    return summary.select(F.inline(F.array(*entries)))


def policy_inputs(
    performance: DataFrame, drift: DataFrame, date_col: str = "snapshot_date"
) -> DataFrame:
    """The values ``refresh_policy_check`` tests, as one row.

    Age counts whole months between the first and the last evaluated snapshot;
    the AUC drop is first minus last.
    """
    rows = performance.select(date_col, "auc", "precision", "num_samples").unionByName(
        drift.select("psi"), allowMissingColumns=True
    )
    evaluated = F.when(F.col("auc").isNotNull(), F.col(date_col))
    return rows.agg(
        F.avg("auc").alias("avg_auc"),
        F.avg("precision").alias("avg_precision"),
        F.max("psi").alias("max_psi"),
        F.floor(F.months_between(F.max(evaluated), F.min(evaluated))).alias("age_months"),
        F.sum("num_samples").alias("n_samples"),
        (F.min_by("auc", evaluated) - F.max_by("auc", evaluated)).alias("auc_drop"),
    )
