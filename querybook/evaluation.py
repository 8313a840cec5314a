"""Splits, class balance and model evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from querybook import views
from querybook.registry import query
from querybook.views import day_text
from vintagemart.operators import aggregates, evaluation, split
from vintagemart.plans import training
from vintagemart.sources.scratch import materialize


def _labels(spark, sf_dir):
    return views.table(spark, sf_dir, "labels")


def quota_ctes(label: str, rows: str) -> str:
    """CTEs ending in q(label, n, n_test): a fifth for the test, by largest remainder."""
    return f"""WITH c AS (SELECT {label}, count(*) AS n FROM {rows} GROUP BY 1),
            t AS (SELECT *, sum(n) OVER () AS total,
                         sum(n) OVER () - ceil(sum(n) OVER () * 0.2) AS n_train FROM c),
            f AS (SELECT *, floor(n * n_train / total) AS base,
                         n * n_train / total - floor(n * n_train / total) AS rest FROM t),
            q AS (SELECT {label}, n, n - base - CASE WHEN row_number() OVER
                             (ORDER BY rest DESC, {label})
                         <= n_train - sum(base) OVER () THEN 1 ELSE 0 END AS n_test FROM f)"""


@query(
    "stratified_split",
    f"""{quota_ctes("quality", "labels")}
       SELECT doc_id, l.quality,
              CASE WHEN row_number() OVER (PARTITION BY l.quality
                                           ORDER BY md5(doc_id || ':42'))
                   <= n_test THEN 'test' ELSE 'train' END AS split
       FROM labels l JOIN q ON l.quality = q.quality""",
)
def stratified_split(spark, sf_dir):
    df = _labels(spark, sf_dir).select("doc_id", "quality")
    return split.stratified_split(df, ["doc_id"], "quality")


@query(
    "stratified_split_repeated_ids",
    f"""{quota_ctes("l_linestatus", "lineitem")}
       SELECT l_linestatus, split, count(*) AS n_rows FROM (
           SELECT l.l_linestatus, CASE WHEN row_number() OVER (PARTITION BY l.l_linestatus
                                              ORDER BY md5(l_orderkey || ':42'))
                                       <= n_test THEN 'test' ELSE 'train' END AS split
           FROM lineitem l JOIN q ON l.l_linestatus = q.l_linestatus)
       GROUP BY ALL""",
)
def stratified_split_repeated_ids(spark, sf_dir):
    """Ids that repeat are cut at the quota all the same."""
    lines = views.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linestatus")
    parts = split.stratified_split(lines, ["l_orderkey"], "l_linestatus")
    return parts.groupBy("l_linestatus", "split").agg(F.count("*").alias("n_rows"))


@query(
    "prepared_training_set",
    f"""{quota_ctes("label", "(SELECT label FROM v_feat WHERE snapshot_date < DATE '2024-06-01')")}
       SELECT 'test' AS part, label, CAST(n_test AS BIGINT) AS n_rows FROM q
       UNION ALL SELECT 'train', label, CAST(max(n - n_test) OVER () AS BIGINT) FROM q""",
)
def prepared_training_set(spark, sf_dir):
    """The whole preparation: cut-off, leakage guard, selection, split, oversampling.

    It reads a stored feature table several times, a few columns each.
    """
    features = materialize(views.feature(spark, sf_dir), "features")
    prepared = training.prepare_training_data(features, "2024-06-01", label="label")
    parts = {"train": prepared.train, "test": prepared.test}
    counted = [
        df.groupBy("label").agg(F.count("*").alias("n_rows")).select(
            F.lit(part).alias("part"), "label", "n_rows"
        )
        for part, df in parts.items()
    ]
    return counted[0].unionByName(counted[1])


@query(
    "class_distribution",
    "SELECT quality AS label, count(*) AS n_rows FROM labels GROUP BY 1",
)
def class_distribution(spark, sf_dir):
    df = _labels(spark, sf_dir).withColumnRenamed("quality", "label")
    return aggregates.class_distribution(df)


@query(
    "balanced_class_weights",
    """SELECT toxic AS label, n AS n_rows, sum(n) OVER () / (count(*) OVER () * n) AS weight
       FROM (SELECT toxic, count(*) AS n FROM labels GROUP BY 1)""",
)
def balanced_class_weights(spark, sf_dir):
    df = _labels(spark, sf_dir).withColumnRenamed("toxic", "label")
    return split.balanced_class_weights(df)


@query(
    "roc_auc",
    """SELECT CAST(snapshot_date AS VARCHAR) AS snapshot_date,
              CAST(n_pos + n_neg AS BIGINT) AS n_rows, round(auc, 10) AS auc
       FROM v_auc""",
)
def roc_auc(spark, sf_dir):
    df = evaluation.roc_auc(views.prediction(spark, sf_dir), ["snapshot_date"])
    return day_text(df.withColumn("auc", F.round("auc", 10)), "snapshot_date")


@query(
    "gini_from_auc",
    """SELECT CAST(snapshot_date AS VARCHAR) AS snapshot_date, round(2 * auc - 1, 3) AS gini
       FROM v_auc""",
)
def gini_from_auc(spark, sf_dir):
    df = evaluation.roc_auc(views.prediction(spark, sf_dir), ["snapshot_date"])
    return day_text(
        df.select("snapshot_date", evaluation.gini(F.col("auc")).alias("gini")), "snapshot_date"
    )


_SPLIT_AUC = """
    SELECT split, sum(CAST(pos AS DOUBLE) * (below + 0.5::DOUBLE * neg))
                      / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc,
           CAST(sum(pos) + sum(neg) AS BIGINT) AS n_rows
    FROM (SELECT *, coalesce(sum(neg) OVER (PARTITION BY split ORDER BY score
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
          FROM (SELECT CASE WHEN snapshot_date < DATE '2024-01-21' THEN 'train_test'
                            ELSE 'oot' END AS split,
                       prediction_probability AS score, sum(actual_label) AS pos,
                       sum(1 - actual_label) AS neg
                FROM v_pred GROUP BY 1, 2))
    GROUP BY split"""


@query("auc_by_split", f"SELECT split, n_rows, round(auc, 10) AS auc FROM ({_SPLIT_AUC})")
def auc_by_split(spark, sf_dir):
    first_oot = F.lit("2024-01-21").cast("date")
    df = views.prediction(spark, sf_dir).withColumn(
        "split", F.when(F.col("snapshot_date") < first_oot, "train_test").otherwise("oot")
    )
    return evaluation.roc_auc(df, ["split"]).withColumn("auc", F.round("auc", 10))


@query(
    "classification_metrics",
    """SELECT CAST(snapshot_date AS VARCHAR) AS snapshot_date,
              CASE WHEN tp + fp = 0 THEN 0 ELSE tp::DOUBLE / (tp + fp) END AS "precision",
              CASE WHEN tp + fn = 0 THEN 0 ELSE tp::DOUBLE / (tp + fn) END AS recall,
              CASE WHEN 2 * tp + fp + fn = 0 THEN 0
                   ELSE (2 * tp)::DOUBLE / (2 * tp + fp + fn) END AS f1
       FROM v_cells""",
)
def classification_metrics(spark, sf_dir):
    return day_text(
        evaluation.classification_metrics(views.prediction(spark, sf_dir), ["snapshot_date"]),
        "snapshot_date",
    )


@query(
    "confusion_matrix",
    "SELECT CAST(snapshot_date AS VARCHAR) AS snapshot_date, tn, fp, fn, tp FROM v_cells",
)
def confusion_matrix(spark, sf_dir):
    return day_text(
        evaluation.confusion_cells(views.prediction(spark, sf_dir), ["snapshot_date"]),
        "snapshot_date",
    )


@query(
    "performance_by_snapshot",
    """SELECT * REPLACE (CAST(snapshot_date AS VARCHAR) AS snapshot_date,
                         round(auc, 10) AS auc)
       FROM v_performance""",
)
def performance_by_snapshot(spark, sf_dir):
    df = evaluation.performance_by_group(views.prediction(spark, sf_dir))
    return day_text(df.withColumn("auc", F.round("auc", 10)), "snapshot_date")
