"""AUC, metrics, drift and decisions against brute force and stored numbers."""

import math
import random
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from vintagemart.operators import decisions, drift, evaluation

SCHEMA = "g string, actual_label int, prediction_probability double, prediction_binary int"


def brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def scored(spark, rows, group="a"):
    return spark.createDataFrame([(group, y, float(s), int(s >= 0.5)) for y, s in rows], SCHEMA)


@pytest.mark.parametrize(
    "draw",
    [
        lambda r: r.random(),
        lambda r: round(r.random(), 1),
        lambda r: r.choice([0.0, 1.0, 0.5]),
        lambda r: 0.5 + r.random() * 1e-12,
        lambda r: r.random() * 10.0 ** -r.randint(0, 320),
        lambda r: (r.random() - 0.5) * 10.0 ** r.randint(-20, 20),
        lambda r: 1.0 - 2.0 ** -r.randint(1, 53),
        lambda r: math.nextafter(2.0 ** r.randint(-5, 5), r.choice([0.0, 100.0])),
    ],
    ids=["uniform", "ties", "three", "narrow", "tiny", "signed", "near1", "powers"],
)
def test_auc_is_exact(spark, draw):
    r = random.Random(7)
    rows = [(int(r.random() < 0.3), draw(r)) for _ in range(400)]
    got = evaluation.roc_auc(scored(spark, rows)).first()["auc"]
    assert got == pytest.approx(brute_auc(rows), abs=1e-12)


@pytest.mark.parametrize(
    "rows, auc",
    [
        ([(0, 0.3), (1, 0.3)], 0.5),
        ([(0, 0.1), (1, 0.9)], 1.0),
        ([(0, 0.9), (1, 0.1)], 0.0),
        ([(1, 0.9), (1, 0.1)], 0.5),
        ([(0, -0.0), (1, 0.0)], 0.5),
    ],
)
def test_auc_corner_cases(spark, rows, auc):
    assert evaluation.roc_auc(scored(spark, rows)).first()["auc"] == auc


@pytest.mark.parametrize("bad", [(None, 0.5), (2, 0.5), (1, None), (1, float("nan")), (0, float("inf"))])
def test_auc_needs_labels_and_scores(spark, bad):
    rows = [("a", 0, 0.1, 0), ("a", 1, 0.2, 0), ("b", 0, 0.1, 0), ("b", 1, 0.2, 0), ("b", *bad, 0)]
    got = {r["g"]: r["auc"] for r in
           evaluation.roc_auc(spark.createDataFrame(rows, SCHEMA), ["g"]).collect()}
    assert got == {"a": 1.0, "b": None}


def test_auc_ignores_monotone_transform(spark):
    r = random.Random(3)
    df = scored(spark, [(r.randint(0, 1), r.random()) for _ in range(300)])
    squeezed = df.withColumn("prediction_probability", F.pow("prediction_probability", F.lit(3.0)))
    assert evaluation.roc_auc(df).first() == evaluation.roc_auc(squeezed).first()


def test_one_hot_group_and_a_small_one(spark):
    r = random.Random(5)
    hot = [(r.randint(0, 1), r.random()) for _ in range(3000)]
    small = [(0, 0.2), (1, 0.7), (1, 0.1)]
    df = scored(spark, hot, "hot").unionAll(scored(spark, small, "small"))
    got = {x["g"]: x["auc"] for x in evaluation.roc_auc(df, ["g"]).collect()}
    assert got["hot"] == pytest.approx(brute_auc(hot), abs=1e-12)
    assert got["small"] == 0.5


def test_unusable_groups_have_no_row(spark):
    rows = [
        ("fine", 0, 0.2, 0), ("fine", 1, 0.8, 1),
        ("one class", 1, 0.2, 0),
        ("no label", 0, 0.2, 0), ("no label", 1, 0.3, 0), ("no label", None, 0.8, 1),
        ("nan", 0, 0.2, 0), ("nan", 1, float("nan"), 1),
    ]
    got = evaluation.performance_by_group(spark.createDataFrame(rows, SCHEMA), ["g"]).collect()
    assert [x["g"] for x in got] == ["fine"]
    assert got[0]["num_samples"] == 2 and got[0]["auc"] == 1.0 and got[0]["f1"] == 1.0


@pytest.mark.parametrize(
    "cells, precision, recall, f1",
    [
        ((917, 836, 82, 65), 0.07214206437291898, 0.4421768707482993, 0.12404580152671754),
        ((1260, 493, 113, 34), 0.06451612903225806, 0.23129251700680273, 0.10089020771513355),
        ((18571, 0, 2287, 0), 0.0, 0.0, 0.0),
    ],
)
def test_stored_metrics(spark, cells, precision, recall, f1):
    df = spark.createDataFrame([cells], "tn bigint, fp bigint, fn bigint, tp bigint")
    columns = evaluation.class_metric_columns(*[F.col(c) for c in ("tn", "fp", "fn", "tp")])
    got = df.select([c.alias(n) for n, c in columns.items()]).first()
    assert tuple(got) == pytest.approx((precision, recall, f1))
    matrix = evaluation.confusion_matrix(df).first()["confusion_matrix"]
    assert matrix == [[cells[0], cells[1]], [cells[2], cells[3]]]


def snapshots(spark, by_day):
    rows = [(d, float(s)) for d, scores in by_day.items() for s in scores]
    return spark.createDataFrame(rows, "snapshot_date date, prediction_probability double")


def test_histogram_edges(spark):
    df = snapshots(spark, {date(2024, 1, 1): [0.3, 0.1, 0.7, 1.0, 0.6, 1.5, -0.1]})
    row = drift.score_histogram(df).first()
    expected = np.histogram([0.3, 0.1, 0.7, 1.0, 0.6], bins=np.linspace(0, 1, 11))[0]
    assert row["bins"] == expected.tolist() == [0, 1, 1, 0, 0, 1, 1, 0, 0, 1]
    assert row["num_samples"] == 7
    assert drift.bin_edges() == np.linspace(0, 1, 11).tolist()


def brute_psi(expected, actual):
    edges = np.linspace(0, 1, 11)
    e = np.histogram(expected, bins=edges)[0] / len(expected) + 1e-10
    a = np.histogram(actual, bins=edges)[0] / len(actual) + 1e-10
    return float(np.sum((a - e) * np.log(a / e)))


def test_psi(spark):
    r = random.Random(1)
    days = {date(2024, m, 1): [r.random() ** m for _ in range(200)] for m in (1, 2, 3)}
    got = {
        x["snapshot_date"]: x
        for x in drift.psi_by_snapshot(snapshots(spark, days), "2024-02-01").collect()
    }
    base = days[date(2024, 2, 1)]
    for day, scores in days.items():
        assert got[day]["psi"] == pytest.approx(brute_psi(base, scores), abs=1e-9)
        assert got[day]["num_samples"] == 200
    assert got[date(2024, 2, 1)]["psi"] == 0.0


def test_psi_baseline_row(spark):
    df = snapshots(spark, {date(2024, 1, 1): [0.1], date(2024, 2, 1): [0.1]})

    def days(baseline, **options):
        rows = drift.psi_by_snapshot(df, baseline, **options).collect()
        return sorted(x["snapshot_date"].month for x in rows)

    assert days("2024-02-01") == [1, 2]
    assert days("2020-01-01") == [2]
    assert days("2024-02-01", keep_baseline_row=False) == [1]


@pytest.mark.parametrize("psi, status", [(0.2, "major_drift"), (0.1, "minor_drift"), (0.0, "stable")])
def test_drift_status(spark, psi, status):
    assert spark.range(1).select(drift.drift_status(F.lit(psi))).first()[0] == status


METRICS = "model_name string, auc double"


def best(spark, rows):
    return decisions.select_best_model(spark.createDataFrame(rows, METRICS)).first()[0]


def test_best_model(spark):
    stored = [("random_forest", 0.46014), ("logistic_regression", 0.47717)]
    assert best(spark, stored) == "logistic_regression"
    assert best(spark, [("random_forest", 0.5), ("logistic_regression", 0.5)]) == (
        "logistic_regression"
    )
    assert best(spark, [("random_forest", 0.6), ("other", 0.6)]) == "random_forest"


SUMMARY = "avg_auc double, avg_precision double, max_psi double"


def decide(spark, row, **options):
    df = spark.createDataFrame([row], SUMMARY)
    got = decisions.retraining_decision(df, **options).first()
    return got["needs_retraining"], got["reasons"]


def test_decisions(spark):
    assert decide(spark, (0.5038, 0.0851, 0.1037)) == (False, [])
    assert decide(spark, (0.5038, 0.0851, 0.2)) == (False, [])
    assert decide(spark, (0.4, None, 0.25)) == (
        True,
        ["AUC below threshold: 0.4000 < 0.5", "PSI above threshold: 0.2500 > 0.2"],
    )
    assert decide(spark, (None, None, None)) == (False, [])
    assert decide(spark, (0.6, 0.0851, 0.1), test_precision=True) == (
        True,
        ["Precision below threshold: 0.0851 < 0.5"],
    )


def test_state_adds_up_to_the_rows(spark):
    """Metrics, bins and reasons from merged states beside those of all rows."""
    from vintagemart.operators import drift, monitoring_state

    rng = random.Random(9)
    rows = []
    for i in range(400):
        score = rng.choice([0.1, 0.5, 0.55, 1.0, 0.0, rng.random(), 1.5, -0.2])
        rows.append(("m", "2024-05-01", i % 4, score, int(score > 0.5), rng.randint(0, 1)))
    rows += [("m", "2024-05-01", 5, 0.3, 0, 1)] * 3
    rows += [("m", "2024-05-01", 6, None, 0, 1), ("m", "2024-05-01", 6, float("nan"), 1, 0), ("m", "2024-05-01", 6, 0.2, 0, None)]
    schema = (
        "model_name string, prediction_date string, snapshot_date int, prediction_probability double, "
        "prediction_binary int, actual_label int"
    )
    df = spark.createDataFrame(rows, schema).repartition(3)
    stale = df.where("snapshot_date = 2").limit(7)
    state = monitoring_state.score_state(df.where("snapshot_date < 2").union(stale))
    state = monitoring_state.merged(state, monitoring_state.score_state(df.where("snapshot_date >= 2")))
    order = lambda rows: sorted(map(str, rows.collect()))
    for groups in (["snapshot_date"], []):
        usable, kept = df.where("snapshot_date < 5"), state.where("snapshot_date < 5")
        assert order(monitoring_state.performance_from_state(kept, groups)) == order(
            evaluation.performance_by_group(usable, groups)
        )
    counts = evaluation.summed_counts(state, ["snapshot_date"])
    assert order(monitoring_state.skipped_from_state(state, counts)) == order(evaluation.skipped_groups(df))
    assert order(monitoring_state.histogram_from_state(state)) == order(drift.score_histogram(df))
    assert monitoring_state.performance_from_state(state.limit(0)).count() == 0
