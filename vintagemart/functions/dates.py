"""Month spines and window boundaries."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def as_date(value: date | str) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def shift_months(day: date, months: int) -> date:
    """Same day ``months`` later, clamped to the length of that month."""
    first = date(day.year + (day.month - 1 + months) // 12, (day.month - 1 + months) % 12 + 1, 1)
    after = date(first.year + first.month // 12, first.month % 12 + 1, 1)
    return first.replace(day=min(day.day, (after - first).days))


def months_between(start: Column, end: Column) -> Column:
    """Array of all first-of-months from the month of ``start`` up to ``end``."""
    first = F.trunc(start, "MM")
    return F.when(
        first <= end, F.sequence(first, end, F.expr("interval 1 month"))
    ).otherwise(F.array().cast("array<date>"))


def month_spine(spark: SparkSession, start: date | str, end: date | str) -> DataFrame:
    """One row per month of a literal range."""
    bounds = F.explode(
        months_between(F.lit(as_date(start)), F.lit(as_date(end)))
    ).alias("snapshot_date")
    return spark.range(1).select(bounds)


def month_spine_of(df: DataFrame, date_col: str = "snapshot_date") -> DataFrame:
    """One row per month between the first and last date of a table."""
    bounds = df.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    return bounds.select(
        F.explode(months_between(F.col("lo").cast("date"), F.col("hi").cast("date"))).alias(
            "snapshot_date"
        )
    )


@dataclass(frozen=True)
class TrainingWindows:
    """Closed date windows before a training date: train/test, then out of time."""

    train_test_start: date
    train_test_end: date
    oot_start: date
    oot_end: date

    @classmethod
    def before(
        cls, train_date: date | str, train_test_months: int = 12, oot_months: int = 2
    ) -> TrainingWindows:
        day = as_date(train_date)
        oot_start = shift_months(day, -oot_months)
        return cls(
            train_test_start=shift_months(oot_start, -train_test_months),
            train_test_end=oot_start - timedelta(days=1),
            oot_start=oot_start,
            oot_end=day - timedelta(days=1),
        )
