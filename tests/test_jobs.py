"""Stores, registry and whole jobs."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from vintagemart import __main__ as cli
from vintagemart import schemas
from vintagemart.plans import medallion, monitoring, scoring, training
from vintagemart.plans.lake import Lake
from vintagemart.sources import files, registry, scratch, store

MONTHS = 4


def test_a_month_is_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(40).select(
        "id", F.add_months(F.lit(date(2024, 1, 1)), (F.col("id") % 4).cast("int")).alias("snapshot_date")
    )
    store.write_snapshots(df, path)
    again = store.read_snapshot(spark, path, "2024-02-01").where("id < 6")
    store.write_snapshots(scratch.materialize(again), path)
    got = {r["snapshot_date"].month: r["count"] for r in
           store.read_snapshots(spark, path).groupBy("snapshot_date").count().collect()}
    assert got == {1: 10, 2: 2, 3: 10, 4: 10}


def test_snapshot_read_is_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(4).select("id", F.date_add(F.lit(date(2024, 1, 1)), F.col("id").cast("int"))
                               .alias("snapshot_date"))
    store.write_snapshots(df, path)
    plan = store.read_snapshot(spark, path, "2024-01-02")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_union_of_different_columns(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2,)], "y int")
    assert sorted(map(str, store.union_by_name([a, b]).collect())) == [
        "Row(x=1, y=None)", "Row(x=None, y=2)",
    ]
    with pytest.raises(ValueError):
        store.union_by_name([])


def test_quoted_csv(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(
        'Customer_ID,Name,Age,SSN,Occupation,snapshot_date\n'
        'C1,"O""Neil, Ann",39_,x,Lawyer,2024-01-01\n'
    )
    row = files.scan_csv(spark, str(path), schemas.ATTRIBUTES_RAW).first()
    assert (row["Name"], row["Age"], row["snapshot_date"]) == ('O"Neil, Ann', "39_", date(2024, 1, 1))
    assert files.csv_columns(spark, str(path)) == schemas.ATTRIBUTES_RAW.names


def test_scratch_uses_the_shared_folder(spark):
    assert scratch.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch.scratch_path(spark, "x") != scratch.scratch_path(spark, "x")


def test_scratch_tables_are_released(spark, monkeypatch):
    monkeypatch.setattr(scratch, "_in_use", [])
    kept = scratch.materialize(spark.range(3))
    assert kept.count() == 3
    assert scratch.release(spark) == 1 and scratch.release(spark) == 0


def run_row(name, when, path):
    return (name, path, when, None, [], 0, {}, "auc", None, None, None)


def test_latest_model_by_its_timestamp(spark, tmp_path):
    path = str(tmp_path / "registry")
    for when, name in ((datetime(2025, 3, 1), "new"), (datetime(2025, 1, 1), "old")):
        registry.register(
            spark.createDataFrame([run_row("m", when, name)], schemas.MODEL_REGISTRY), path
        )
    rows = registry.read_registry(spark, path)
    assert registry.latest(rows).first()["model_path"] == "new"
    empty = rows.limit(0)
    assert registry.latest_or(empty, rows.where("model_path = 'old'")).first()["model_path"] == "old"
    with pytest.raises(ValueError, match="no model"):
        registry.latest_or(empty, None)


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """Raw extracts of 60 customers and 4 months; every third customer is in arrears."""
    root = tmp_path_factory.mktemp("raw")
    days = [date(2024, 1 + m, 1) for m in range(MONTHS)]
    loans, clicks, people, money = [], [], [], []
    for i in range(60):
        for m, day in enumerate(days):
            overdue = 250 if i % 3 == 0 else 0
            loans.append([f"L{i}", f"C{i}", "2023-07-01", 10, 6 + m, 1000 + 7 * i + m, 100, 0,
                          overdue, 500, day])
            clicks += [[f"C{i}", (i * 31 + m * 17) % 23, (i * i) % 19, day]] * (1 + i % 3)
            people.append([f"C{i}", f'"N, {i}"', f"{20 + i}_", "x", "Lawyer", day])
            numbers = [(i * k + m) % 89 for k in range(1, 16)]
            money.append([f"C{i}", *numbers, "Good", "2 Years and 1 Months", "Yes", "High_spent",
                          '"A, B, and C"', day])
    tables = {
        "loan_daily": (schemas.LOAN_DAILY.names, loans),
        "clickstream": (["Customer_ID", "fe_1", "fe_2", "snapshot_date"], clicks),
        "attributes": (schemas.ATTRIBUTES_RAW.names, people),
        "financials": (schemas.FINANCIALS_RAW.names, money),
    }
    for table, (names, rows) in tables.items():
        lines = [",".join(names)] + [",".join(map(str, r)) for r in rows]
        (root / medallion.RAW_FILES[table]).write_text("\n".join(lines) + "\n")
    return str(root)


@pytest.fixture(scope="module")
def lake(spark, raw, tmp_path_factory):
    lake = Lake(str(tmp_path_factory.mktemp("lake")))
    medallion.run(spark, raw, lake)
    return lake


def features(spark, lake):
    return store.read_snapshots(spark, lake.path("gold", "feature_store"))


def test_medallion(spark, lake):
    audit = {
        (r["layer"], r["table_name"]): r["n"]
        for r in medallion.audit(spark, lake)
        .groupBy("layer", "table_name").agg(F.sum("n_rows").alias("n")).collect()
    }
    assert audit[("bronze", "loan_daily")] == audit[("gold", "feature_store")] == 240
    assert audit[("silver", "clickstream")] == 240 and audit[("gold", "label_store")] == 60
    row = features(spark, lake).where("loan_id = 'L3' and snapshot_date = '2024-02-01'").first()
    assert (row["dpd"], row["mob"], row["label_default_30dpd"]) == (92, 7, 1)
    assert (row["total_clicks"], row["Age"], row["Type_of_Loan_Count"]) == (1, 23, 4)
    assert "SSN" not in row.asDict() and "Name" not in row.asDict()


def test_missing_months(spark, lake):
    got = medallion.missing_months(spark, lake, "gold", "feature_store", "2024-03-01", "2024-06-01")
    assert sorted(r[0].month for r in got.collect()) == [5, 6]


def test_training_scoring_monitoring(spark, lake):
    prepared = training.prepare_training_data(features(spark, lake), "2024-04-01")
    assert not set(prepared.feature_columns) & {"dpd", "mob", "overdue_amt", "balance"}
    about = prepared.metadata().first()
    assert about["n_test"] == 36 and about["n_train"] == 192
    assert set(about["class_distribution_train"].values()) == {96}

    models = training.train_candidates(prepared, trees=5)
    metrics = training.evaluate_candidates(models, prepared)
    assert {r["model_name"] for r in metrics.collect()} == set(models)
    best = training.save_best(spark, lake, models, metrics, prepared)
    saved = scoring.latest_model(spark, lake)
    assert saved["model_name"] == best["model_name"]
    assert saved["feature_columns"] == list(prepared.feature_columns)

    summary = scoring.run(
        spark, lake, features(spark, lake), "2024-02-01", "2024-04-01", "2024-04-01"
    ).first()
    assert summary["n_predictions"] == 180 and 0 <= summary["mean_probability"] <= 1

    # Another prediction date adds rows, the same date replaces its own.
    for day in ("2024-05-01", "2024-05-01"):
        again = scoring.run(spark, lake, features(spark, lake), "2024-04-01", "2024-04-01", day).first()
        assert again["n_predictions"] == 60
    stored = store.read_snapshots(spark, lake.path("gold", "predictions"))
    dates = {str(r[0]): r[1] for r in stored.groupBy("prediction_date").count().collect()}
    assert dates == {"2024-04-01": 180, "2024-05-01": 60}

    result = monitoring.run(
        spark, lake, features(spark, lake), "2024-02-01", "2024-04-01", row_id=["loan_id"]
    )
    assert result.matched.count() == 240
    assert result.performance.count() == 3 and result.drift.count() == 3
    assert result.skipped.count() == 0
    assert result.decision.first()["checked_timestamp"] is not None
    report = result.report.first()
    assert report["needs_retraining"] == monitoring.retraining_needed(result)
    assert report["performance_summary"]["avg_auc"] is not None

    # A later report of one month: the state has the others, the first report stays.
    later = monitoring.run(
        spark, lake, features(spark, lake), "2024-02-01", "2024-05-01",
        first="2024-04-01", last="2024-04-01", row_id=["loan_id"],
    )
    assert later.matched.count() == 120
    order = lambda rows: sorted(map(str, rows.collect()))
    assert order(later.performance) == order(result.performance)
    kept = spark.read.parquet(lake.path("gold", "monitoring/performance_metrics"))
    assert {str(r[0]): r[1] for r in kept.groupBy("report_date").count().collect()} == {
        "2024-04-01": 3, "2024-05-01": 3,
    }
    # Each snapshot counts once, as predicted last, or as the named date predicted it.
    assert {r["num_samples"] for r in later.performance.collect()} == {60}
    named = monitoring.run(
        spark, lake, features(spark, lake), "2024-02-01", "2024-05-02",
        prediction_date="2024-05-01", row_id=["loan_id"],
    )
    assert [(r["snapshot_date"].month, r["num_samples"]) for r in named.performance.collect()] == [(4, 60)]


def test_tuned_model_is_saved_and_scores_a_range(spark, lake):
    labels = store.read_snapshots(spark, lake.path("silver", "loan_daily")).select(
        "loan_id", "Customer_ID", "snapshot_date", (F.col("dpd") >= 30).cast("int").alias("label")
    )
    clicks = labels.select(
        "Customer_ID",
        "snapshot_date",
        (F.col("label") * 5 + F.month("snapshot_date")).alias("fe_1"),
        F.when(F.month("snapshot_date") > 1, 1).alias("fe_2"),
    )
    tuned = training.train_from_label_store(
        labels, clicks, "2024-05-01", 3, 1, draws=2,
        grid={"maxIter": [1, 2], "maxDepth": [2]},
    )
    stats = {r["split"]: (r["n_rows"], r["label_mean"]) for r in tuned.stats.collect()}
    assert stats == {"train": (144, 0.33), "test": (36, 0.33), "oot": (60, 0.33)}
    auc = {r["split"]: (r["auc"], r["gini"]) for r in tuned.auc.collect()}
    assert auc == {s: (1.0, 1.0) for s in stats}
    assert tuned.version == "credit_model_2024_05_01"

    training.save_tuned(spark, lake, tuned)
    record = spark.read.json(lake.path("models", f"records/{tuned.version}")).first()
    assert record["oot_start_date"] == "2024-04-01"
    assert record["splits"]["oot"]["n_rows"] == 60

    scored = scoring.score_version(spark, lake, tuned.version, clicks, "2024-02-01", "2024-04-01")
    assert set(scored.columns) == {"Customer_ID", "snapshot_date", "model_name", "model_predictions"}
    assert scored.count() == 180
    scoring.score_version(spark, lake, tuned.version, clicks, "2024-04-01", "2024-04-01")
    stored = store.read_snapshots(spark, lake.path("gold", "model_predictions"))
    assert stored.count() == 180


def test_no_decision_without_metrics(spark):
    predictions = spark.createDataFrame(
        [(f"C{i}", date(2024, 1 + i % 2, 1), 0.1 * i, i % 2) for i in range(8)],
        "Customer_ID string, snapshot_date date, prediction_probability double, prediction_binary int",
    )
    actuals = predictions.select("Customer_ID", "snapshot_date", F.lit(1).alias("actual_label"))
    with pytest.raises(ValueError, match="valid metrics"):
        monitoring.monitor(predictions, actuals, "2024-01-01", "2024-03-01", row_id=["Customer_ID"])
    january = F.month("snapshot_date") == 1
    label = F.when(january, F.substring("Customer_ID", 2, 1).cast("int") % 4).otherwise(1)
    mixed = actuals.withColumn("actual_label", F.when(label > 0, 1).otherwise(0))
    result = monitoring.monitor(predictions, mixed, "2024-01-01", "2024-03-01", row_id=["Customer_ID"])
    skipped = [(r["snapshot_date"].month, r["n_rows"], r["n_bad"], r["reason"]) for r in result.skipped.collect()]
    assert skipped == [(2, 4, 0, "only one class")]


def test_scoring_without_a_registry(spark, lake, tmp_path):
    empty = Lake(str(tmp_path / "empty"))
    with pytest.raises(ValueError, match="no model is registered"):
        scoring.latest_model(spark, empty)
    given = spark.createDataFrame([run_row("given", datetime(2025, 1, 1), "p")], schemas.MODEL_REGISTRY)
    model = scoring.latest_model(spark, empty, given)
    assert (model["model_name"], scoring._version(model)) == ("given", "unknown")


def test_too_few_rows_to_train(spark, lake):
    with pytest.raises(ValueError, match="need at least 100"):
        training.prepare_training_data(features(spark, lake), "2024-02-01")


def test_unknown_features_are_zero(spark, lake):
    got = scoring.prepare_inference_data(
        features(spark, lake), "2024-01-01", "2024-01-01", ["Age", "absent"]
    )
    assert got.columns == ["Customer_ID", "loan_id", "snapshot_date", "features"]
    assert got.where("loan_id = 'L3'").first()["features"] == [23.0, 0.0]


@pytest.fixture(scope="module")
def user_tables(spark):
    return {
        "lms": spark.createDataFrame(
            [("L1", "USER_000007", 1000.0, 0.12, 12, "2023-12-31", " Active ", "2024-01-01"),
             ("L2", "USER_000007", 3000.0, 0.0, 24, "2023-12-01", "Closed", "2024-01-01"),
             ("L3", "USER_000008", 10.0, 0.1, 24, "2023-12-01", "Closed", "2024-02-01")],
            schemas.USER_LOANS),
        "clickstream": spark.createDataFrame(
            [("e", "USER_000007", "click", "2024-01-01 00:00:17", "2024-01-01")],
            schemas.USER_CLICKS),
        "attributes": spark.createDataFrame(
            [("USER_000007", 40, "F", "PhD", "Employed", "Single", 0, "2024-01-01")],
            schemas.USER_ATTRIBUTES),
        "financials": spark.createDataFrame(
            [("USER_000007", 12.0, 2.0, None, 1.0, 3.0, 0.0, 1, 1, 0, 0, 700, "2024-01-01")],
            schemas.USER_FINANCIALS),
    }


def test_user_tables(user_tables):
    silver = medallion.user_silver(*user_tables.values())
    assert silver["attributes"].first()["education_years"] == 21
    money = silver["financials"].first()
    assert (money["debt_to_income"], money["credit_utilization"], money["net_worth_estimate"]) == (
        3.0, 0.0, 0.0,
    )
    assert silver["clickstream"].first()["event_breakdown"] == {"click": 1}
    gold = medallion.user_gold(silver["loan_daily"]).where("num_loans = 2").first()
    assert (gold["loan_id"], gold["avg_loan_age_days"]) == ("LOAN_000007", 16.0)


def test_user_lake(spark, user_tables, tmp_path):
    for prefix, df in user_tables.items():
        df.write.parquet(str(tmp_path / "raw" / f"{prefix}_20240101.parquet"))
    lake = Lake(str(tmp_path / "lake"))
    audit = medallion.run_user(spark, str(tmp_path / "raw"), lake, last="2024-01-01")
    got = {(r["layer"], r["table_name"]): r["n_rows"] for r in audit.collect()}
    assert got[("bronze", "loan_daily")] == 2 and got[("gold", "feature_store")] == 1
    assert len(got) == 9


def test_bad_and_absent_months_are_reported(spark, user_tables, tmp_path):
    raw = tmp_path / "raw"
    for prefix, df in user_tables.items():
        df.write.parquet(str(raw / f"{prefix}_20240101.parquet"))
    (raw / "lms_20240201.parquet").write_text("no parquet")
    user_tables["lms"].drop("loan_status").write.parquet(str(raw / "lms_20240301.parquet"))
    lake = Lake(str(tmp_path / "lake"))
    medallion.run_user(spark, str(raw), lake, "2024-01-01", "2024-03-01")
    bad = spark.read.parquet(lake.path("audit", "unreadable_extracts")).collect()
    assert sorted((r["table_name"], r["path"][-20:]) for r in bad) == [
        ("loan_daily", "lms_20240201.parquet"), ("loan_daily", "lms_20240301.parquet"),
    ]
    assert any("loan_status" in r["reason"] for r in bad)
    missing = spark.read.parquet(lake.path("audit", "missing_months")).collect()
    months = sorted(r["snapshot_date"].month for r in missing if r["table_name"] == "loan_daily")
    assert months == [3]
    assert spark.read.parquet(lake.path("audit", "rows")).count() > 0
    with pytest.raises(ValueError, match="no readable extract"):
        medallion.run_user(spark, str(tmp_path / "nothing"), lake)


def test_command_line(spark, raw, tmp_path, monkeypatch):
    monkeypatch.setattr(cli, "get_spark", lambda *a, **k: spark)
    root = str(tmp_path / "lake")
    cli.main(["--lake", root, "bronze", "--raw", raw, "--first", "2024-02-01", "--last", "2024-02-01"])
    bronze = store.read_snapshots(spark, Lake(root).path("bronze", "loan_daily"))
    assert [r[0] for r in bronze.select("snapshot_date").distinct().collect()] == [date(2024, 2, 1)]
    with pytest.raises(SystemExit):
        cli.main(["--lake", root, "train"])
