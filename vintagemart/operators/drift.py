"""Score histograms and the population stability index."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintagemart.functions.dates import as_date

N_BINS = 10
# Additive guard of empty bins and the status limits.
EMPTY_BIN = 1e-10
MINOR_DRIFT = 0.1
MAJOR_DRIFT = 0.2


def bin_edges(n_bins: int = N_BINS) -> list[float]:
    """Equal edges on [0, 1] as multiples of the step, so 3 * 0.1 is not 0.3."""
    step = 1.0 / n_bins
    return [i * step for i in range(n_bins)] + [1.0]


def bin_counts(score: Column, edges: Sequence[float]) -> list[Column]:
    """Count per bin ``[lo, hi)``, the last one closed; other values count nowhere."""
    last = len(edges) - 2
    out = []
    for i in range(last + 1):
        below = score <= edges[i + 1] if i == last else score < edges[i + 1]
        out.append(F.count_if((score >= edges[i]) & below))
    return out


def score_histogram(
    df: DataFrame,
    groups: Sequence[str] = ("snapshot_date",),
    score: str = "prediction_probability",
    n_bins: int = N_BINS,
) -> DataFrame:
    """Per group the row count and the array of its bin counts, empty bins included."""
    counts = bin_counts(F.col(score).cast("double"), bin_edges(n_bins))
    return df.groupBy(*groups).agg(
        F.count("*").alias("num_samples"), F.array(*counts).alias("bins")
    )


def histogram_long(histogram: DataFrame, groups: Sequence[str] = ("snapshot_date",)) -> DataFrame:
    return histogram.select(*groups, F.posexplode("bins").alias("bin", "n_rows"))


def psi_column(actual: Column, n_actual: Column, base: Column, n_base: Column, n_bins: int) -> Column:
    total = F.lit(0.0)
    for i in range(n_bins):
        a = actual[i].cast("double") / n_actual.cast("double") + F.lit(EMPTY_BIN)
        e = base[i].cast("double") / n_base.cast("double") + F.lit(EMPTY_BIN)
        total = total + (a - e) * F.ln(a / e)
    return total


def drift_status(psi: Column) -> Column:
    return (
        F.when(psi >= MAJOR_DRIFT, "major_drift")
        .when(psi >= MINOR_DRIFT, "minor_drift")
        .otherwise("stable")
    )


def psi_by_snapshot(
    df: DataFrame,
    baseline: date | str,
    date_col: str = "snapshot_date",
    score: str = "prediction_probability",
    n_bins: int = N_BINS,
    models: Sequence[str] = (),
    keep_baseline_row: bool = True,
) -> DataFrame:
    """PSI of every snapshot against the baseline snapshot, or the earliest one if
    the baseline has no rows.

    A requested baseline that exists keeps its own row (PSI 0); after the
    fallback the baseline row is left out. ``keep_baseline_row=False`` leaves it
    out in both cases. The rows are read once; the baseline is picked by a
    window over the finished histograms, one row per snapshot.
    """
    histogram = score_histogram(df, [*models, date_col], score, n_bins)
    return psi_of_histogram(histogram, baseline, date_col, n_bins, models, keep_baseline_row)


def psi_of_histogram(
    histogram: DataFrame,
    baseline: date | str,
    date_col: str = "snapshot_date",
    n_bins: int = N_BINS,
    models: Sequence[str] = (),
    keep_baseline_row: bool = True,
) -> DataFrame:
    """``psi_by_snapshot`` from finished histograms."""
    requested = F.col(date_col) == F.lit(as_date(baseline))
    preference = F.struct(F.when(requested, 0).otherwise(1), F.col(date_col))
    snapshots = Window.partitionBy(*(models or [F.lit(0)]))
    chosen = F.min_by(F.struct(date_col, "num_samples", "bins"), preference).over(snapshots)
    joined = histogram.withColumn("base", chosen)
    is_baseline = F.col(date_col) == F.col(f"base.{date_col}")
    dropped = is_baseline & ~requested if keep_baseline_row else is_baseline
    psi = psi_column(
        F.col("bins"), F.col("num_samples"), F.col("base.bins"), F.col("base.num_samples"), n_bins
    )
    return (
        joined.where(~dropped)
        .withColumn("psi", psi)
        .select(
            *models, date_col, "psi", drift_status(F.col("psi")).alias("drift_status"), "num_samples"
        )
    )


def drift_status_counts(drift: DataFrame) -> DataFrame:
    return drift.groupBy("drift_status").agg(F.count("*").alias("n_snapshots"))
