"""Joins under skew, columns, snapshots, aggregates."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from vintagemart import schemas
from vintagemart.operators import aggregates, columns, joins, snapshots
from vintagemart.operators.scaling import StandardScaling

DAY = date(2024, 1, 1)
KEYS = ["Customer_ID", "snapshot_date"]


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the loans belong to one customer, a third to nobody."""
    owner = (
        F.when(F.col("id") % 3 == 0, "HOT")
        .when(F.col("id") % 3 == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("C"), F.col("id") % 50))
    )
    loans = spark.range(3000).select(
        F.concat(F.lit("L"), "id").alias("loan_id"),
        owner.alias("Customer_ID"),
        F.lit(DAY).alias("snapshot_date"),
    )
    side = spark.createDataFrame(
        [("HOT", DAY, 1), ("HOT", DAY, 2), ("C2", DAY, 3), (None, DAY, 4), ("ABSENT", DAY, 5)],
        "Customer_ID string, snapshot_date date, v int",
    )
    return loans, side


SMALL = {"task_rows": 500, "one_in": 2}


def test_hot_keys_are_found_and_few(skewed):
    loans, _ = skewed
    hot = joins.hot_keys(loans, KEYS, ["loan_id"], **SMALL).collect()
    assert {r["Customer_ID"] for r in hot} == {"HOT", None}
    assert all(2 <= r["n_salts"] <= 4 for r in hot)


def test_correlations_of_many_features(spark):
    names = [f"f{i}" for i in range(300)]
    df = spark.range(200).select(
        *[(F.hash("id", F.lit(i // 2)) % 1000).cast("double").alias(n) if i < 298
          else F.lit(1.0).alias(n) for i, n in enumerate(names)]
    )
    pairs = {(r["earlier"], r["later"]): r["corr"] for r in columns.correlation_pairs(df, names).collect()}
    assert len(pairs) == 300 * 299 // 2
    assert pairs["f0", "f1"] == pytest.approx(1.0) and pairs["f5", "f299"] is None
    assert abs(pairs["f0", "f2"]) < 0.4
    assert columns.correlated_features(df, names[:298]) == names[1:298:2]


def test_a_thousand_hot_keys(spark, monkeypatch):
    left = spark.range(20_000).select("id", (F.col("id") % 1000).alias("key"))
    right = spark.range(1200).select(F.col("id").alias("key"), (F.col("id") * 2).alias("v"))
    options = {"task_rows": 4, "one_in": 1}
    assert joins.hot_keys(left, ["key"], ["id"], **options).count() == 1000
    for most in (50_000, 10):
        monkeypatch.setattr(joins, "BROADCAST_KEYS", most)
        joined = joins.salted_join(left, [right], ["key"], ["id"], **options)
        assert rows(joined) == rows(left.join(right, "key", "left").select(joined.columns))


@pytest.mark.parametrize("task_rows", [1, 500, 10_000])
def test_salting_changes_no_row(skewed, task_rows):
    loans, side = skewed
    other = side.select(*KEYS, (F.col("v") * 10).alias("w"))
    plain = loans.join(side, KEYS, "left").join(other, KEYS, "left")
    salted = joins.salted_join(loans, [side, other], KEYS, ["loan_id"], task_rows=task_rows, one_in=2)
    assert salted.columns == plain.columns
    assert rows(salted) == rows(plain)


def test_hot_rows_are_spread(skewed):
    """The joined hot key and the null keys come out of many sub-keys."""
    loans, side = skewed
    hot = joins.hot_keys(loans, KEYS, ["loan_id"], task_rows=10, one_in=2)
    marked = joins._mark_hot(loans, hot, True, KEYS, False).where("Customer_ID = 'HOT'")
    salts = {r["salt"]: r["count"] for r in marked.groupBy(
        F.pmod(F.xxhash64("loan_id"), F.col("__hot")).alias("salt")).count().collect()}
    assert len(salts) > 50 and max(salts.values()) < 60


def test_null_safe_join_matches_nulls(skewed):
    loans, side = skewed
    predictions = loans.withColumn("prediction_probability", F.lit(0.5))
    actuals = side.select(*KEYS, (F.col("v") % 2).alias("actual_label"))
    actuals = actuals.unionAll(actuals).unionAll(actuals.where("Customer_ID is null"))
    got = joins.align_predictions(predictions, actuals, row_id=["loan_id"])
    condition = predictions["Customer_ID"].eqNullSafe(actuals["Customer_ID"]) & predictions[
        "snapshot_date"
    ].eqNullSafe(actuals["snapshot_date"])
    plain = predictions.join(actuals.drop(), condition).select(
        predictions["loan_id"], actuals["actual_label"]
    )
    assert rows(got.select("loan_id", "actual_label")) == rows(plain)
    summary = joins.match_summary(predictions, actuals).first()
    assert summary["n_matched"] == plain.count()
    assert (summary["n_predictions"], summary["n_actuals"]) == (3000, 11)
    assert (summary["min_date"], summary["max_date"]) == (DAY, DAY)


def test_no_predictions_is_rate_zero(spark, skewed):
    loans, side = skewed
    none = joins.match_summary(loans.limit(0), side).first()
    assert none["match_rate"] == 0.0 and none["min_date"] is None


def test_no_common_key(spark):
    with pytest.raises(ValueError, match="no common key"):
        joins.shared_keys(spark.range(1), spark.range(1))


def test_guards(spark):
    df = spark.range(5)
    with pytest.raises(ValueError, match="loan_start_date"):
        columns.require_columns(df, ["loan_start_date"])
    with pytest.raises(ValueError, match="5 rows, need at least 100"):
        columns.require_rows(df, 100)
    assert columns.require_rows(df, 5) is df
    with pytest.raises(ValueError, match="customer id"):
        columns.first_present(df.columns, columns.CUSTOMER_ID_NAMES, "customer id")


def test_first_alias_wins(spark):
    df = spark.createDataFrame([(1, 2, 3)], "cust_id int, user_id int, target int")
    renamed = columns.rename_first_present(df, columns.CUSTOMER_ID_NAMES, "Customer_ID", "id")
    assert renamed.columns == ["cust_id", "Customer_ID", "target"]


def test_schema_enforcement(spark):
    df = spark.createDataFrame([("7", "x", "2024-02-30"), ("3000000000", "1.5", "2024-02-29")],
                               "a string, b string, c string")
    got = columns.enforce_schema(df, {"a": "int", "b": "float", "c": "date"}).collect()
    assert [tuple(r) for r in got] == [(7, None, None), (None, 1.5, date(2024, 2, 29))]
    with pytest.raises(ValueError):
        columns.enforce_schema(df, {"z": "int"})


def test_leakage_guard(spark):
    names = [*columns.LEAKAGE_COLUMNS, *columns.ID_COLUMNS, "SSN", "income", "label"]
    df = spark.createDataFrame([tuple(range(len(names)))], names)
    assert columns.feature_columns(df, "label") == ["income"]
    assert len(columns.LEAKAGE_COLUMNS) == 20


def test_alignment_and_numbers(spark):
    df = spark.createDataFrame([("a", "7", float("nan")), ("b", "junk", 1.0)],
                               "id string, x string, y double")
    got = columns.align_features(df, ["y", "absent", "x"], ["id"]).collect()
    assert [tuple(r) for r in got] == [("a", 0.0, 0.0, 7.0), ("b", 1.0, 0.0, 0.0)]
    assert [tuple(r) for r in columns.coerce_numeric(df, ["x", "y"]).collect()] == [
        ("a", 7.0, 0.0), ("b", 0.0, 1.0),
    ]


def test_feature_selection(spark):
    df = spark.range(200).select(
        F.col("id").cast("double").alias("a"),
        (F.col("id") * -2.0).alias("b"),
        F.lit(1.0).alias("c"),
        F.pmod(F.xxhash64("id"), F.lit(97)).cast("double").alias("d"),
        F.lit(None).cast("double").alias("e"),
    )
    names = ["a", "b", "c", "d", "e"]
    assert columns.constant_features(df, names) == ["c", "e"]
    assert columns.correlated_features(df, ["a", "b", "d"]) == ["b"]
    pairs = {(r["earlier"], r["later"]): r["corr"] for r in
             columns.correlation_pairs(df, ["a", "b", "c"]).collect()}
    assert pairs[("a", "b")] == pytest.approx(-1.0) and pairs[("a", "c")] is None
    profile = {r["feature"]: r for r in columns.feature_profile(df, names).collect()}
    assert profile["a"]["n_distinct"] == 200 and not profile["a"]["is_constant"]
    assert profile["e"]["n_distinct"] == 0 and profile["e"]["is_constant"]


def test_population_scaling(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("x"), F.lit(3.0).alias("c"))
    scaling = StandardScaling.fit(df, ["x", "c"])
    assert scaling.spreads == (pytest.approx(28.8661, abs=1e-4), 1.0)
    first = scaling.apply(df).orderBy("x").first()
    assert first["x"] == pytest.approx(-49.5 / 28.86607) and first["c"] == 0.0


def test_constants_stay_constant_over_many_partitions(spark):
    df = spark.range(1000).select(F.lit(0.1).alias("c"), F.rand(3).alias("x")).repartition(13)
    scaling = StandardScaling.fit(df, ["c", "x"])
    assert (scaling.means[0], scaling.spreads[0]) == (0.1, 1.0)
    assert scaling.apply(df).agg(F.max(F.abs("c"))).first()[0] == 0.0
    assert columns.correlation_pairs(df, ["c", "x"]).first()["corr"] is None
    empty = StandardScaling.fit(spark.createDataFrame([(None,)], "x double"), ["x"])
    assert (empty.means, empty.spreads) == ((0.0,), (1.0,))


def test_extract_without_date_is_everything(spark):
    assert snapshots.snapshot_extract(spark.range(3), "2024-01-01").count() == 3


def loan(spark, **changes):
    row = {
        "loan_id": "L", "Customer_ID": "C", "loan_start_date": "2023-09-01", "tenure": "10",
        "installment_num": "6", "loan_amt": "1000", "due_amt": "0", "paid_amt": None,
        "overdue_amt": "50", "balance": None, "snapshot_date": "2024-03-01",
    } | changes
    raw = schemas.raw_text(schemas.LOAN_DAILY)
    return spark.createDataFrame([tuple(row[n] for n in raw.names)], raw)


def test_zero_due_rules(spark):
    guarded = snapshots.silver_loans(loan(spark)).first()
    assert (guarded["installments_missed"], guarded["dpd"], guarded["balance"]) == (0, None, None)
    older = snapshots.silver_loans(loan(spark), guard_zero_due=False).first()
    assert (older["installments_missed"], older["dpd"], older["balance"]) == (0, None, 0.0)


def test_two_label_rules(spark):
    late = {"due_amt": "100", "overdue_amt": "250"}
    at_six = snapshots.silver_loans(loan(spark, **late))
    at_nine = snapshots.silver_loans(loan(spark, installment_num="9", **late))
    assert snapshots.label_store(at_six).first()["label"] == 1
    assert snapshots.label_store(at_nine).count() == 0
    for df in (at_six, at_nine):
        assert snapshots.add_row_label(df).first()["label_default_30dpd"] == 1
    early = snapshots.silver_loans(loan(spark, installment_num="5", **late))
    assert snapshots.add_row_label(early).first()["label_default_30dpd"] == 0
    assert snapshots.add_row_label(early.drop("mob")).first()["label_default_30dpd"] == 1
    assert "label_default_30dpd" not in snapshots.add_row_label(early.drop("dpd")).columns


def test_event_map(spark):
    df = spark.createDataFrame(
        [("u", "e1", "click"), ("u", "e2", "click"), ("u", None, "view"), ("u", "e4", None)],
        "user_id string, event_id string, event_type string",
    )
    got = aggregates.event_breakdown(df, event_id="event_id").first()
    assert got["total_events"] == 3 and got["event_breakdown"] == {"click": 2, "view": 1}


def test_null_class_is_no_class(spark):
    df = spark.createDataFrame([(0,), (0,), (1,), (None,)], "label int")
    got = {r["label"]: r["n_rows"] for r in aggregates.class_distribution(df).collect()}
    assert got == {0: 2, 1: 1} and aggregates.minority_size(df) == 1


def test_prediction_summary_uses_population_spread(spark):
    df = spark.createDataFrame([(0.2, 0), (0.6, 1)],
                               "prediction_probability double, prediction_binary int")
    got = aggregates.prediction_summary(df).first()
    assert got["std_probability"] == pytest.approx(0.2) and got["default_rate"] == 0.5
