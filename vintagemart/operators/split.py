"""Stratified train/test split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintagemart.operators.joins import has_at_most
from vintagemart.operators.ranking import shuffle_key
from vintagemart.sources.scratch import materialize

# More values than these are no classes: a split by them is refused.
MAX_CLASSES = 10_000
# Hex digits of the key that name a bucket: 65,536 buckets per class.
BUCKET_DIGITS = 4


def class_quotas(df: DataFrame, label: str, test_share: float) -> DataFrame:
    """Test rows per class: ``ceil(share * n)`` in all, by largest remainder.

    The training rows are what gets apportioned, so rounding favours training.
    """
    return _quotas(df.groupBy(label).agg(F.count("*").alias("n")), label, test_share)


def _quotas(counts: DataFrame, label: str, test_share: float) -> DataFrame:
    everything = Window.partitionBy(F.lit(0))
    total = F.sum("n").over(everything)
    n_train = total - F.ceil(total * F.lit(test_share))
    by_remainder = Window.partitionBy(F.lit(0)).orderBy(F.col("rest").desc(), F.col(label))
    left_over = F.when(F.col("place") <= F.col("spare"), 1).otherwise(0)
    # The product of two counts needs more digits than a bigint has.
    share = "cast(n as decimal(19, 0)) * cast(n_train as decimal(19, 0))"
    return (
        counts.withColumn("total", total)
        .withColumn("n_train", n_train)
        .withColumn("whole", F.expr(f"({share}) div total"))
        .withColumn("rest", F.expr(f"({share}) % total"))
        .withColumn("spare", F.col("n_train") - F.sum("whole").over(everything))
        .withColumn("place", F.row_number().over(by_remainder))
        .select(label, (F.col("n") - F.col("whole") - left_over).alias("n_test"))
    )


def require_few_classes(df: DataFrame, label: str) -> DataFrame:
    """Raise if the label takes so many values that it is no class: what follows
    keeps a row per class in one task or in the driver."""
    if not has_at_most(df, [label], MAX_CLASSES):
        raise ValueError(f"{label} has more than {MAX_CLASSES} values")
    return df


def stratified_split(
    df: DataFrame,
    ids: Sequence[str],
    label: str = "label",
    test_share: float = 0.2,
    seed: int = 42,
) -> DataFrame:
    """Add ``split`` = ``train`` or ``test``; exactly the quota of each class is test.

    The test rows of a class are those with the smallest shuffle keys. One pass
    counts rows per class and bucket of keys; classes, quotas and the bucket in
    which each class is cut all follow from these counts. Rows of other buckets
    compare their bucket with one cut per class, so the table itself is never
    shuffled; only rows of the cut buckets are ranked, so repeated ids are cut at
    the right place, too. Rows without a label get no split. Reading ``df`` again
    must give the same rows.
    """
    keyed = df.withColumn("__key", shuffle_key(ids, seed)).withColumn(
        "__bucket", F.substring("__key", 1, BUCKET_DIGITS)
    )
    labelled = keyed.where(F.col(label).isNotNull())
    sizes = labelled.groupBy(label, "__bucket").agg(F.count("*").alias("n"))
    sizes = materialize(sizes, "bucket-sizes")
    require_few_classes(sizes, label)
    quotas = _quotas(sizes.groupBy(label).agg(F.sum("n").alias("n")), label, test_share)
    running = Window.partitionBy(label).orderBy("__bucket")
    upto = sizes.withColumn(
        "upto", F.sum("n").over(running.rowsBetween(Window.unboundedPreceding, 0))
    )
    # The bucket that holds the first row beyond the quota, or none beyond it.
    cuts = (
        upto.join(quotas, label)
        .where((F.col("upto") >= F.col("n_test")) & (F.col("upto") - F.col("n") < F.col("n_test")))
        .select(
            F.col(label).alias("__label"),
            F.col("__bucket").alias("__cut"),
            (F.col("n_test") - F.col("upto") + F.col("n")).alias("__wanted"),
        )
    )
    cuts = F.broadcast(materialize(cuts, "cuts"))
    tagged = keyed.join(cuts, keyed[label] == F.col("__label"), "left")
    at_cut = F.coalesce(F.col("__bucket") == F.col("__cut"), F.lit(False))
    side = F.when(F.coalesce(F.col("__bucket") < F.col("__cut"), F.lit(False)), "test").otherwise("train")
    clear = tagged.where(~at_cut).withColumn("split", F.when(F.col(label).isNotNull(), side))
    inside = Window.partitionBy(label, "__bucket").orderBy("__key", *ids)
    ranked = tagged.where(at_cut).withColumn("__place", F.row_number().over(inside))
    first = F.when(F.col("__place") <= F.col("__wanted"), "test").otherwise("train")
    cut = ranked.withColumn("split", first).drop("__place")
    return clear.unionByName(cut).drop("__key", "__bucket", "__label", "__cut", "__wanted")


def balanced_class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Weight ``n / (classes * n_class)`` per class; a missing label is no class."""
    known = require_few_classes(df.where(F.col(label).isNotNull()), label)
    counts = known.groupBy(label).agg(F.count("*").alias("n_rows"))
    everything = Window.partitionBy(F.lit(0))
    classes = F.count("*").over(everything)
    return counts.select(
        label,
        "n_rows",
        (F.sum("n_rows").over(everything) / (classes * F.col("n_rows"))).alias("weight"),
    )


def add_class_weights(df: DataFrame, label: str = "label", name: str = "weight") -> DataFrame:
    """The weight of each row's class, null without a label."""
    weights = balanced_class_weights(df, label).select(label, F.col("weight").alias(name))
    return df.join(F.broadcast(weights), label, "left")
