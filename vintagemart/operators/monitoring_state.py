"""Monitoring metrics from a stored state that months are merged into.

The state has a row per model, prediction date, snapshot and distinct score with the
confusion cells, unusable rows and all rows of that score. Cells, score bins and exact AUCs are sums over
such rows, so any months can be put together, and a month that is scored again replaces
its own rows. Predictions and actuals of other months are not read again.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagemart.functions.dates import as_date
from vintagemart.operators import drift, evaluation

KEYS = ("model_name", "prediction_date", "snapshot_date")


def score_state(
    matched: DataFrame,
    keys: Sequence[str] = KEYS,
    label: str = "actual_label",
    score: str = "prediction_probability",
    predicted: str = "prediction_binary",
) -> DataFrame:
    """``keys``, score, cells, and unusable rows: one row per distinct score."""
    return evaluation.score_counts(matched, keys, label, score, predicted)


def merged(stored: DataFrame, new: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Both states as one; keys that ``new`` has are taken from it alone."""
    replaced = new.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return stored.join(replaced, same, "left_anti").unionByName(new)


def chosen_state(
    state: DataFrame, model_name: str | None = None, prediction_date: date | str | None = None
) -> DataFrame:
    """Each snapshot once: as the named model and date predicted it, else as predicted
    last (of several models on that date, the last by name)."""
    if model_name is not None:
        state = state.where(F.col("model_name") == model_name)
    if prediction_date is not None:
        state = state.where(F.col("prediction_date") == F.lit(as_date(prediction_date)))
    last = state.groupBy("snapshot_date").agg(
        F.max(F.struct("prediction_date", "model_name")).alias("last")
    )
    last = last.select("snapshot_date", "last.*")
    # One row per snapshot.
    return state.join(F.broadcast(last), list(KEYS), "left_semi")


def performance_from_state(
    state: DataFrame, groups: Sequence[str] = ("snapshot_date",)
) -> DataFrame:
    """The rows of ``evaluation.performance_by_group``; fewer groups pool more months."""
    return evaluation.performance_of(evaluation.summed_counts(state, groups), groups)


def skipped_from_state(
    state: DataFrame, counts: DataFrame, groups: Sequence[str] = ("snapshot_date",)
) -> DataFrame:
    """The rows of ``evaluation.skipped_groups``; ``counts`` are the state's sums."""
    found = counts.withColumn("reason", evaluation.skip_reason()).where("reason is not null")
    return evaluation.with_rows(found, state.groupBy(*groups).agg(F.sum("n_rows").alias("n_rows")), groups)


def histogram_from_state(
    state: DataFrame, groups: Sequence[str] = ("snapshot_date",), n_bins: int = drift.N_BINS
) -> DataFrame:
    """The rows of ``drift.score_histogram``: each score counts as often as it occurs."""
    edges = drift.bin_edges(n_bins)
    score, bins = F.col("score"), []
    for i in range(n_bins):
        below = score <= edges[i + 1] if i == n_bins - 1 else score < edges[i + 1]
        inside = F.when((score >= edges[i]) & below, F.col("n_rows")).otherwise(0)
        bins.append(F.sum(inside))
    return state.groupBy(*groups).agg(F.sum("n_rows").alias("num_samples"), F.array(*bins).alias("bins"))
