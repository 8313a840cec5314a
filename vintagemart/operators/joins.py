"""Snapshot joins that stay balanced when one key holds much of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintagemart.sources.scratch import materialize

# Left rows of one key that a task gets on average, at most: larger keys are salted.
TASK_ROWS = 100_000
# Up to this many hot keys, their list is broadcast (a few MB); a longer one is joined
# like any table.
BROADCAST_KEYS = 50_000
# Sub-keys over which rows that match nothing are spread.
NULL_SALTS = 256

_SALT = "__salt"
_HOT = "__hot"


def _same(left: Column, right: Column, null_safe: bool) -> Column:
    return left.eqNullSafe(right) if null_safe else left == right


def broadcast_if(df: DataFrame, few: bool) -> DataFrame:
    """Broadcast a side whose size was checked; otherwise Spark picks the join."""
    return F.broadcast(df) if few else df


def has_at_most(df: DataFrame, columns: Sequence[str], limit: int) -> bool:
    """Whether the columns have at most ``limit`` distinct values; duplicates are
    dropped on the map side and no more than ``limit + 1`` values are fetched."""
    if not columns:
        return True
    return df.select(*columns).distinct().limit(limit + 1).count() <= limit


def hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    row_id: Sequence[str],
    task_rows: int = TASK_ROWS,
    one_in: int = 16,
) -> DataFrame:
    """Every key with more than ``task_rows`` rows, and the number of sub-keys
    (``n_salts``) that bring each of them below that.

    Estimated on every row whose id hashes to 0 modulo ``one_in``. The list
    only decides which keys are salted; the joined rows are the same for any
    list.
    """
    seen = df.where(F.pmod(F.xxhash64(*row_id), F.lit(one_in)) == 0)
    counts = seen.groupBy(*keys).agg((F.count("*") * one_in).alias("n"))
    salts = F.ceil(F.col("n") / task_rows).cast("int").alias("n_salts")
    return counts.where(F.col("n") > task_rows).select(*keys, salts)


def _mark_hot(
    df: DataFrame, hot: DataFrame, few: bool, keys: Sequence[str], null_safe: bool
) -> DataFrame:
    renamed = hot.select([F.col(k).alias(f"__h_{k}") for k in keys] + [F.col("n_salts").alias(_HOT)])
    match = [_same(df[k], renamed[f"__h_{k}"], null_safe) for k in keys]
    return df.join(broadcast_if(renamed, few), match, "left").drop(*[f"__h_{k}" for k in keys])


def salted_join(
    left: DataFrame,
    rights: Sequence[DataFrame],
    keys: Sequence[str],
    row_id: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    **hot_options,
) -> DataFrame:
    """Join ``left`` with each of ``rights`` on the same keys.

    One narrow scan of the left table finds the keys that are too large for a
    task. Their rows are spread over as many sub-keys as their size asks for, by
    a hash of ``row_id``, and the matching right rows are repeated per sub-key;
    the left table is shuffled once for all joins. Without such keys the joins
    are plain ones. Left rows with a null key match nothing (unless
    ``null_safe``) and are spread as well.
    """
    hot = materialize(hot_keys(left, keys, row_id, **hot_options), "hot-keys")
    n_hot = hot.count()
    few = n_hot <= BROADCAST_KEYS
    spread = lambda n: F.pmod(F.xxhash64(*row_id), n).cast("int")
    salt = F.lit(0)
    if n_hot:
        left = _mark_hot(left, hot, few, keys, null_safe)
        salt = F.when(F.col(_HOT).isNotNull(), spread(F.col(_HOT))).otherwise(salt)
    if not null_safe:
        missing = F.lit(False)
        for k in keys:
            missing = missing | F.col(k).isNull()
        salt = F.when(missing, spread(F.lit(NULL_SALTS))).otherwise(salt)
    out = left.withColumn(_SALT, salt).drop(_HOT)
    for right in rights:
        if n_hot:
            salts = F.sequence(F.lit(0), F.coalesce(F.col(_HOT), F.lit(1)) - 1)
            side = _mark_hot(right, hot, few, keys, null_safe)
            side = side.withColumn(_SALT, F.explode(salts)).drop(_HOT)
        else:
            side = right.withColumn(_SALT, F.lit(0))
        if null_safe:
            side = side.withColumnsRenamed({k: f"__r_{k}" for k in (*keys, _SALT)})
            match = [out[k].eqNullSafe(side[f"__r_{k}"]) for k in (*keys, _SALT)]
            out = out.join(side, match, how).drop(*[f"__r_{k}" for k in (*keys, _SALT)])
        else:
            out = out.join(side, [*keys, _SALT], how)
    return out.drop(_SALT)


def gold_feature_join(
    loans: DataFrame,
    clicks: DataFrame,
    attributes: DataFrame,
    financials: DataFrame,
    keys: Sequence[str] = ("Customer_ID", "snapshot_date"),
    row_id: Sequence[str] = ("loan_id",),
) -> DataFrame:
    """Loans left-joined with the three customer tables of the same snapshot."""
    return salted_join(loans, [clicks, attributes, financials], keys, row_id)


def training_set_join(
    labels: DataFrame,
    features: DataFrame,
    keys: Sequence[str] = ("Customer_ID", "snapshot_date"),
    row_id: Sequence[str] = ("loan_id",),
) -> DataFrame:
    return salted_join(labels, [features], keys, row_id)


def shared_keys(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str] = ("Customer_ID", "loan_id", "snapshot_date"),
) -> list[str]:
    common = [k for k in keys if k in left.columns and k in right.columns]
    if not common:
        raise ValueError(f"no common key: {left.columns} and {right.columns}")
    return common


def align_predictions(
    predictions: DataFrame,
    actuals: DataFrame,
    keys: Sequence[str] = ("Customer_ID", "loan_id", "snapshot_date"),
    row_id: Sequence[str] | None = None,
) -> DataFrame:
    """Predictions with their actual label on the keys both have; null equals null.

    Equal actuals are counted before the join and repeated after it, so a key
    (or null) that many actuals share is one row per label on the right side.
    """
    common = shared_keys(predictions, actuals, keys)
    counted = actuals.groupBy(*common, "actual_label").agg(F.count("*").alias("__copies"))
    matched = salted_join(
        predictions, [counted], common, row_id or predictions.columns, "inner", null_safe=True
    )
    copies = F.sequence(F.lit(1).cast("bigint"), F.col("__copies"))
    return matched.withColumn("__copies", F.explode(copies)).drop("__copies")


def match_summary(
    predictions: DataFrame,
    actuals: DataFrame,
    keys: Sequence[str] = ("Customer_ID", "loan_id", "snapshot_date"),
    date_col: str = "snapshot_date",
) -> DataFrame:
    """How many predictions met an actual: one row.

    Both sides are counted per key first, so the matched rows are summed, not
    built, and one shuffle of counts suffices.
    """
    common = shared_keys(predictions, actuals, keys)
    sides = predictions.select(*common, F.lit(1).alias("p"), F.lit(0).alias("a")).unionAll(
        actuals.select(*common, F.lit(0).alias("p"), F.lit(1).alias("a"))
    )
    per_key = sides.groupBy(*common).agg(F.sum("p").alias("p"), F.sum("a").alias("a"))
    pairs = F.col("p") * F.col("a")
    matched_date = F.when(pairs > 0, F.col(date_col).cast("date"))
    return per_key.agg(
        F.sum("p").alias("n_predictions"),
        F.sum("a").alias("n_actuals"),
        F.sum(pairs).alias("n_matched"),
        F.coalesce(
            F.try_divide(F.sum(pairs).cast("double"), F.sum("p").cast("double")), F.lit(0.0)
        ).alias("match_rate"),
        F.min(matched_date).alias("min_date"),
        F.max(matched_date).alias("max_date"),
    )
