"""Schema enforcement, column selection and feature-frame preparation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    FloatType,
    NumericType,
    StringType,
    StructType,
)

from vintagemart.functions.cleaning import number_in_text

# Candidate names, in order of preference.
CUSTOMER_ID_NAMES = ("Customer_ID", "user_id", "customer_id", "cust_id")
LABEL_NAMES = ("label_default_30dpd", "default_flag", "label", "target")

# Columns known only after the outcome, and identifiers.
LEAKAGE_COLUMNS = (
    "dpd", "overdue_amt", "installments_missed", "first_missed_date",
    "balance", "paid_amt", "payment_status", "delinquency_status",
    "default_flag", "charged_off", "settlement_amt", "recovery_amt",
    "mob", "installment_num", "days_since_last_payment",
    "last_payment_date", "maturity_date", "payment_delay_days",
    "late_payment_count", "missed_payment_count",
)
ID_COLUMNS = ("user_id", "loan_id", "snapshot_date", "Customer_ID", "loan_start_date")
PERSONAL_COLUMNS = ("Name", "SSN")

MIN_TRAINING_ROWS = 100
MAX_CORRELATION = 0.95


def require_columns(df: DataFrame, names: Iterable[str], what: str = "table") -> DataFrame:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"{what} has no column {missing}; columns are {df.columns}")
    return df


def require_rows(df: DataFrame, at_least: int = 1, what: str = "table") -> DataFrame:
    """Raise if there are too few rows; reads no more than ``at_least`` of them."""
    found = df.limit(at_least).count()
    if found < at_least:
        raise ValueError(f"{what}: {found} rows, need at least {at_least}")
    return df


def first_present(columns: Sequence[str], candidates: Sequence[str], what: str) -> str:
    for name in candidates:
        if name in columns:
            return name
    raise ValueError(f"no {what} column among {list(candidates)}; columns are {list(columns)}")


def rename_first_present(
    df: DataFrame, candidates: Sequence[str], target: str, what: str
) -> DataFrame:
    return df.withColumnRenamed(first_present(df.columns, candidates, what), target)


def enforce_schema(
    df: DataFrame, types: Mapping[str, str | DataType] | StructType
) -> DataFrame:
    """Cast the named columns in one projection; junk becomes null."""
    if isinstance(types, StructType):
        types = {field.name: field.dataType for field in types.fields}
    require_columns(df, types)
    return df.select(
        [
            F.col(name).try_cast(types[name]).alias(name) if name in types else F.col(name)
            for name in df.columns
        ]
    )


def select_by_prefix(df: DataFrame, prefix: str = "fe_", keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, *[c for c in df.columns if c.startswith(prefix) and c not in keep])


def feature_columns(
    df: DataFrame,
    label: str | None = None,
    exclude: Sequence[str] = LEAKAGE_COLUMNS + ID_COLUMNS + PERSONAL_COLUMNS,
) -> list[str]:
    """All columns but ids, personal data, the label and post-outcome columns."""
    return [c for c in df.columns if c not in exclude and c != label]


def drop_leakage(df: DataFrame, label: str | None = None) -> DataFrame:
    return df.select(feature_columns(df, label))


def fill_numeric_nulls(df: DataFrame, value: float = 0, nan_too: bool = True) -> DataFrame:
    """Every numeric null (and NaN, for float columns) of the frame becomes ``value``."""
    if nan_too:
        return df.fillna(value)
    numeric = [f for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    filled = {f.name: F.coalesce(F.col(f.name), F.lit(value).cast(f.dataType)) for f in numeric}
    return df.withColumns(filled) if filled else df


def zero_infinite(df: DataFrame) -> DataFrame:
    """Every infinite value of the frame becomes 0."""
    floats = [f for f in df.schema.fields if isinstance(f.dataType, (FloatType, DoubleType))]
    finite = {
        f.name: F.when(F.abs(f.name) != F.lit(float("inf")), F.col(f.name)).when(
            F.col(f.name).isNotNull(), F.lit(0.0).cast(f.dataType)
        )
        for f in floats
    }
    return df.withColumns(finite) if finite else df


def _numeric_reading(df: DataFrame, name: str) -> Column:
    """Numbers and flags as they are, texts if they read as a number; anything else,
    null and NaN are 0."""
    kind = df.schema[name].dataType
    if isinstance(kind, (NumericType, BooleanType)):
        value = F.col(name).cast("double")
    elif isinstance(kind, StringType):
        value = number_in_text(F.col(name))
    else:
        return F.lit(0.0)
    return F.nanvl(F.coalesce(value, F.lit(0.0)), F.lit(0.0))


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Numeric reading of the features; junk, null, NaN and other types become 0."""
    return df.select(
        [_numeric_reading(df, c).alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def align_features(
    df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """The model's feature list in its order; features the frame lacks are 0."""
    return df.select(
        *keep,
        *[(_numeric_reading(df, c) if c in df.columns else F.lit(0.0)).alias(c) for c in columns],
    )


def feature_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per feature: rows, distinct values, range and whether it is constant.

    Exact distinct counts come from two grouped stages, (feature, value) and
    then feature, so each value set is deduplicated on the map side and spread
    over all tasks.
    """
    long = df.unpivot(
        [], [F.col(c).cast("double").alias(c) for c in columns], "feature", "value"
    )
    values = long.groupBy("feature", "value").agg(F.count("*").alias("n"))
    return values.groupBy("feature").agg(
        F.sum("n").alias("n_rows"),
        F.count("value").alias("n_distinct"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        (F.count("value") <= 1).alias("is_constant"),
    )


def constant_features(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Features with at most one distinct non-null value, by one min/max pass."""
    row = df.agg(
        *[
            F.coalesce(F.min(c) == F.max(c), F.lit(True)).alias(f"c{i}")
            for i, c in enumerate(columns)
        ]
    ).first()
    return [c for i, c in enumerate(columns) if row[i]]


def _correlation_matrix(df: DataFrame, columns: Sequence[str]):
    """The Gram matrix is summed on the executors; only features x features numbers
    come back."""
    vectors = VectorAssembler(inputCols=list(columns), outputCol="v").transform(df).select("v")
    return Correlation.corr(vectors, "v").first()[0].toArray()


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair (earlier, later) of features without nulls.

    A constant column has no correlation: null. It is recognised by its range,
    as merged partial sums need not be exact and its spread not quite zero.
    """
    spark = df.sparkSession
    schema = "earlier string, later string, corr double"
    if len(columns) < 2:
        return spark.createDataFrame([], schema)
    constant = set(constant_features(df, columns))
    matrix = _correlation_matrix(df, columns)
    rows = [
        (a, b, None if {a, b} & constant else float(matrix[i][j]))
        for j, b in enumerate(columns)
        for i, a in enumerate(columns[:j])
    ]
    return spark.createDataFrame(rows, schema)


def correlated_features(
    df: DataFrame, columns: Sequence[str], limit: float = MAX_CORRELATION
) -> list[str]:
    """Features whose absolute correlation with any earlier one exceeds ``limit``."""
    if len(columns) < 2:
        return []
    matrix = _correlation_matrix(df, columns)
    return [
        name
        for j, name in enumerate(columns)
        if any(abs(matrix[i][j]) > limit for i in range(j))
    ]
