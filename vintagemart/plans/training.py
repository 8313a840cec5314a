"""Leakage-free training data, candidate models, selection and registration."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from vintagemart import schemas
from vintagemart.functions.dates import TrainingWindows, as_date
from vintagemart.operators import (
    aggregates,
    columns,
    decisions,
    evaluation,
    joins,
    modelling,
    sampling,
    snapshots,
    split,
)
from vintagemart.operators.scaling import SCALED, StandardScaling
from vintagemart.plans.lake import Lake
from vintagemart.sources import files, registry
from vintagemart.sources.scratch import materialize

ROW_KEYS = ("Customer_ID", "user_id", "loan_id", "snapshot_date")


@dataclass(frozen=True)
class PreparedData:
    """``train`` and ``test`` have ``features`` (array, in the order of
    ``feature_columns``) and ``label``."""

    train: DataFrame
    test: DataFrame
    feature_columns: tuple[str, ...]

    def metadata(self) -> DataFrame:
        """Feature list, sizes and class distribution of both parts: one row."""
        tagged = self.train.select("label", F.lit("train").alias("part")).unionAll(
            self.test.select("label", F.lit("test").alias("part"))
        )
        sizes = tagged.groupBy("part", "label").agg(F.count("*").alias("n"))
        is_part = {p: F.col("part") == p for p in ("train", "test")}
        entry = F.struct(F.col("label").cast("string"), "n")
        return sizes.agg(
            *[F.sum(F.when(c, F.col("n"))).alias(f"n_{p}") for p, c in is_part.items()],
            *[
                F.map_from_entries(F.collect_list(F.when(c, entry))).alias(
                    f"class_distribution_{p}"
                )
                for p, c in is_part.items()
            ],
        ).select(
            F.array(*[F.lit(c) for c in self.feature_columns]).alias("feature_columns"),
            F.lit(len(self.feature_columns)).alias("n_features"),
            "*",
        )


def select_features(df: DataFrame, candidates: Sequence[str]) -> list[str]:
    """Candidates without constant ones and without late copies of earlier ones."""
    constant = columns.constant_features(df, candidates)
    varying = [c for c in candidates if c not in constant]
    correlated = columns.correlated_features(df, varying)
    return [c for c in varying if c not in correlated]


def prepare_training_data(
    features: DataFrame,
    cutoff: date | str,
    test_share: float = 0.2,
    seed: int = 42,
    oversample: bool = True,
    select_on_train: bool = False,
    label: str | None = None,
) -> PreparedData:
    """Rows before the cut-off, cleaned features, stratified split, balanced training part.

    By default features are selected on all rows before the cut-off;
    ``select_on_train`` looks at the training part only.
    """
    before = snapshots.snapshot_range(features, before=cutoff)
    columns.require_rows(before, columns.MIN_TRAINING_ROWS, "training data")
    label = label or columns.first_present(features.columns, columns.LABEL_NAMES, "label")
    ids = [c for c in ROW_KEYS if c in features.columns]
    candidates = columns.feature_columns(features, label)
    numeric = columns.coerce_numeric(
        before.select(*ids, F.col(label).cast("int").alias("label"), *candidates), candidates
    )
    tagged = materialize(
        split.stratified_split(numeric, ids, "label", test_share, seed), "prepared"
    )
    basis = tagged.where("split = 'train'") if select_on_train else tagged
    chosen = select_features(basis, candidates)
    vectors = tagged.select(
        F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in ids])).alias("id"),
        F.array(*[F.col(c) for c in chosen]).alias("features"),
        "label",
        "split",
    )
    train, test = (vectors.where(F.col("split") == p).drop("split") for p in ("train", "test"))
    if oversample:
        train = materialize(sampling.oversample(train, seed=seed), "balanced")
    return PreparedData(train, test, tuple(chosen))


def train_candidates(prepared: PreparedData, trees: int = 100) -> dict[str, PipelineModel]:
    train = modelling.with_vector(split.add_class_weights(prepared.train))
    n = prepared.train.count()
    return {
        "logistic_regression": modelling.fit(modelling.logistic_regression(n), train),
        "random_forest": modelling.fit(modelling.random_forest(trees=trees), train),
    }


def evaluate_candidates(
    models: Mapping[str, PipelineModel], prepared: PreparedData
) -> DataFrame:
    """One metric row per model, on the test part, from one evaluation of all scores."""
    test = modelling.with_vector(prepared.test)
    parts = [
        modelling.predict(model, test, ["label"]).withColumn("model_name", F.lit(name))
        for name, model in models.items()
    ]
    scored = parts[0]
    for part in parts[1:]:
        scored = scored.unionByName(part)
    return evaluation.model_metrics(scored, ["model_name"])


def _metrics_record(row: Row) -> tuple:
    return (
        row["auc"],
        row["precision"],
        row["recall"],
        row["f1"],
        [[row["tn"], row["fp"]], [row["fn"], row["tp"]]],
    )


def save_best(
    spark: SparkSession,
    lake: Lake,
    models: Mapping[str, PipelineModel],
    metrics: DataFrame,
    prepared: PreparedData,
    now: datetime | None = None,
) -> Row:
    """Save the model with the highest AUC and append its registry row."""
    metrics = materialize(metrics, "metrics")
    compared = {r["model_name"]: _metrics_record(r) for r in metrics.collect()}
    best = decisions.select_best_model(metrics).first()
    now = now or datetime.now(timezone.utc).replace(tzinfo=None)
    name = best["model_name"]
    path = lake.model(f"{name}_{now:%Y%m%d_%H%M%S}")
    models[name].write().overwrite().save(path)
    record = (
        name,
        path,
        now,
        compared[name],
        list(prepared.feature_columns),
        len(prepared.feature_columns),
        compared,
        "auc",
        ("true", "true", "post-outcome columns and ids are not features"),
        "true",
        "1.0",
    )
    registry.register(spark.createDataFrame([record], schemas.MODEL_REGISTRY), lake.registry)
    return best


def run(
    spark: SparkSession, lake: Lake, features: DataFrame, cutoff: date | str, **options
) -> Row:
    """Prepare, train, compare, save; the preparation and comparison records are JSON."""
    prepared = prepare_training_data(features, cutoff, **options)
    about = prepared.metadata().withColumn("training_cutoff_date", F.lit(as_date(cutoff)))
    files.write_json_record(about, lake.path("models", "prepared"))
    models = train_candidates(prepared)
    metrics = materialize(evaluate_candidates(models, prepared), "metrics")
    files.write_json_record(
        evaluation.confusion_matrix(metrics), lake.path("models", "candidates")
    )
    return save_best(spark, lake, models, metrics, prepared)


# --- training from a label store and a feature store ----------------------


@dataclass(frozen=True)
class TunedModel:
    """``model`` scales, assembles and classifies rows with the feature columns."""

    model: PipelineModel
    train_date: date
    windows: TrainingWindows
    stats: DataFrame
    auc: DataFrame
    best_setting: dict

    @property
    def version(self) -> str:
        return f"credit_model_{self.train_date:%Y_%m_%d}"


def train_from_label_store(
    labels: DataFrame,
    features: DataFrame,
    train_date: date | str,
    train_test_months: int = 12,
    oot_months: int = 2,
    test_share: float = 0.2,
    prefix: str = "fe_",
    seed: int = 88,
    draws: int = modelling.SEARCH_DRAWS,
    **search,
) -> TunedModel:
    """Windows before the training date, scaling fitted on train, tuned boosted
    trees, AUC and Gini on train, test and out-of-time rows. Missing features
    count as 0."""
    windows = TrainingWindows.before(train_date, train_test_months, oot_months)
    inside = {"first": windows.train_test_start, "last": windows.oot_end}
    joined = joins.training_set_join(
        snapshots.snapshot_range(labels, **inside), snapshots.snapshot_range(features, **inside)
    )
    names = [c for c in joined.columns if c.startswith(prefix)]
    ids = ["loan_id", "Customer_ID", "snapshot_date"]
    tagged = materialize(
        snapshots.tag_windows(
            columns.coerce_numeric(joined.select(*ids, "label", *names), names), windows
        ),
        "windows",
    )
    train_test = split.stratified_split(
        tagged.where("split = 'train_test'").drop("split"), ids, "label", test_share, seed
    )
    parts = materialize(train_test.unionByName(tagged.where("split = 'oot'")), "parts")
    scaling = StandardScaling.fit(parts.where("split = 'train'"), names)
    stages = [scaling.transformer(), modelling.assembler([SCALED + c for c in names])]
    vectors = PipelineModel(stages).transform(parts)
    tuned, settings = modelling.tune_boosted_trees(
        vectors.where("split = 'train'"), ids, draws=draws, **search
    )
    model = PipelineModel([*stages, tuned.bestModel])
    scored = modelling.predict(model, parts, ["split", "label"])
    auc = evaluation.roc_auc(scored, ["split"], "label").withColumn(
        "gini", evaluation.gini(F.col("auc"))
    )
    best = max(range(len(settings)), key=lambda i: tuned.avgMetrics[i])
    return TunedModel(
        model, as_date(train_date), windows, aggregates.split_stats(parts), auc, settings[best]
    )


def save_tuned(spark: SparkSession, lake: Lake, tuned: TunedModel) -> str:
    """Save the model under its version, and a JSON record of how it came about."""
    path = lake.model(tuned.version)
    tuned.model.write().overwrite().save(path)
    w = tuned.windows
    results = tuned.stats.join(tuned.auc.drop("n_rows"), "split")
    entry = F.struct("n_rows", "label_mean", "auc", "gini")
    record = results.agg(F.map_from_entries(F.collect_list(F.struct("split", entry))).alias("splits"))
    files.write_json_record(
        record.select(
            F.lit(tuned.version).alias("model_version"),
            F.lit(tuned.train_date).alias("model_train_date"),
            F.lit(w.train_test_start).alias("train_test_start_date"),
            F.lit(w.train_test_end).alias("train_test_end_date"),
            F.lit(w.oot_start).alias("oot_start_date"),
            F.lit(w.oot_end).alias("oot_end_date"),
            "splits",
            F.struct(*[F.lit(v).alias(k) for k, v in tuned.best_setting.items()]).alias("hp_params"),
        ),
        lake.path("models", f"records/{tuned.version}"),
    )
    return path
