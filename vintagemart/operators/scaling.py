"""Standard scaling with the population spread of the training rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALED = "scaled_"


@dataclass(frozen=True)
class StandardScaling:
    columns: tuple[str, ...]
    means: tuple[float, ...]
    spreads: tuple[float, ...]

    @classmethod
    def fit(cls, train: DataFrame, columns: Sequence[str]) -> StandardScaling:
        """One aggregation; a few numbers per column come back.

        A constant column, recognised by its range, scales by 1; an all-null one
        is left as it is.
        """
        parts = [
            F.struct(
                F.avg(c).alias("mean"),
                F.stddev_pop(c).alias("spread"),
                F.min(c).cast("double").alias("low"),
                F.max(c).cast("double").alias("high"),
            ).alias(f"c{i}")
            for i, c in enumerate(columns)
        ]
        means, spreads = [], []
        for found in train.agg(*parts).first():
            constant = found["low"] == found["high"]
            means.append((found["low"] if constant else found["mean"]) or 0.0)
            spreads.append(1.0 if constant else found["spread"])
        return cls(tuple(columns), tuple(means), tuple(spreads))

    def apply(self, df: DataFrame) -> DataFrame:
        scaled = {
            c: (F.col(c) - F.lit(m)) / F.lit(s)
            for c, m, s in zip(self.columns, self.means, self.spreads)
        }
        return df.select([scaled[c].alias(c) if c in scaled else F.col(c) for c in df.columns])

    def transformer(self) -> SQLTransformer:
        """The same scaling as a pipeline stage that is saved with its model; it
        adds ``scaled_<column>``."""
        scaled = [
            f"(`{c}` - {m!r}D) / {s!r}D AS `{SCALED}{c}`"
            for c, m, s in zip(self.columns, self.means, self.spreads)
        ]
        return SQLTransformer(statement=f"SELECT *, {', '.join(scaled)} FROM __THIS__")
