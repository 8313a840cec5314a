"""Grouped counts and means; every one combines on the map side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_per_key(
    df: DataFrame,
    keys: Sequence[str] = ("Customer_ID", "snapshot_date"),
    name: str = "total_clicks",
) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def event_breakdown_long(
    df: DataFrame,
    keys: Sequence[str] = ("user_id",),
    event_type: str = "event_type",
    event_id: str | None = None,
) -> DataFrame:
    """One row per key and event type: events with an id, and events."""
    counted = F.count(event_id) if event_id else F.count("*")
    return df.groupBy(*keys, event_type).agg(
        counted.alias("n_ids"), F.count("*").alias("n_events")
    )


def event_breakdown(
    df: DataFrame,
    keys: Sequence[str] = ("user_id",),
    event_type: str = "event_type",
    event_id: str | None = None,
) -> DataFrame:
    """Per key: event count and a map event type -> count (null types left out).

    Events are counted per (key, type) first, so the collected list has one
    entry per event type, not per event.
    """
    per_type = event_breakdown_long(df, keys, event_type, event_id)
    entry = F.when(F.col(event_type).isNotNull(), F.struct(event_type, "n_events"))
    return per_type.groupBy(*keys).agg(
        F.sum("n_ids").alias("total_events"),
        F.map_from_entries(F.collect_list(entry)).alias("event_breakdown"),
    )


def event_pivot(
    df: DataFrame,
    event_types: Sequence[str],
    keys: Sequence[str] = ("user_id",),
    event_type: str = "event_type",
) -> DataFrame:
    """One count column per named event type, in a single aggregation."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("total_events"),
        *[
            F.count_if(F.col(event_type) == F.lit(t)).alias(f"n_{t}")
            for t in event_types
        ],
    )


def customer_loan_features(
    loans: DataFrame, keys: Sequence[str] = ("user_id", "snapshot_date")
) -> DataFrame:
    """Means, total and number of loans per customer."""
    return loans.groupBy(*keys).agg(
        F.avg("loan_amount").alias("avg_loan_amount"),
        F.sum("loan_amount").alias("total_loan_amount"),
        F.count("loan_amount").alias("num_loans"),
        F.avg("interest_rate").alias("avg_interest_rate"),
        F.avg("monthly_payment").alias("avg_monthly_payment"),
        F.avg("loan_age_days").alias("avg_loan_age_days"),
    )


def bad_rate_by(df: DataFrame, group: str = "mob", flag: str = "dpd_flag") -> DataFrame:
    """Share of flagged rows per group."""
    return df.groupBy(group).agg(F.avg(flag).alias("bad_rate"), F.count("*").alias("n_rows"))


def class_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows per class; null labels are not a class."""
    return df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n_rows"))


def minority_size(df: DataFrame, label: str = "label") -> int:
    return class_distribution(df, label).agg(F.min("n_rows")).first()[0]


def split_stats(df: DataFrame, split: str = "split", label: str = "label") -> DataFrame:
    """Row count and label mean, rounded to 2 places, per split."""
    return df.groupBy(split).agg(
        F.count("*").alias("n_rows"), F.round(F.avg(label), 2).alias("label_mean")
    )


def prediction_summary(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Count, mean and population spread of the probability, and predicted positives."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("n_predictions"),
        F.avg("prediction_probability").alias("mean_probability"),
        F.stddev_pop("prediction_probability").alias("std_probability"),
        F.sum("prediction_binary").alias("predicted_defaults"),
        F.avg("prediction_binary").alias("default_rate"),
    )


def row_audit(tables: dict[tuple[str, str], DataFrame], date_col: str = "snapshot_date") -> DataFrame:
    """Rows per (layer, table, snapshot); tables without the date count as one group."""
    parts = []
    for (layer, table), df in tables.items():
        day = F.col(date_col).cast("date") if date_col in df.columns else F.lit(None).cast("date")
        counts = df.groupBy(day.alias(date_col)).agg(F.count("*").alias("n_rows"))
        parts.append(
            counts.select(F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "*")
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def missing_snapshots(
    spine: DataFrame, df: DataFrame, date_col: str = "snapshot_date"
) -> DataFrame:
    """Dates of the spine for which the table has no row."""
    present = df.select(F.col(date_col).cast("date").alias(date_col)).distinct()
    return spine.join(present, date_col, "left_anti")
