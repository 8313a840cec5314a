"""The ordinal model: its gradient, its edge cases, and held-out accuracy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vintagemart.llm.queries import graded, table
from vintagemart.llm.quality import SHAPES, _loss, fit, score

SCHEMA = "doc_id long, text string, slots string"
RATINGS = "doc_id long, grade int"


def corpus(n=300, seed=4):
    """Grade 0 has insults, grade 1 has bars and marks, grade 2 neither."""
    rng = random.Random(seed)
    rows, grades = [], []
    for i in range(n):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(20, 200))]
        grade = rng.randrange(3)
        if grade == 0:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "scum"]))
        if grade == 1:
            words = [w + "|!!" if j % 3 == 0 else w for j, w in enumerate(words)]
        rows.append((i, " ".join(words), "x"))
        grades.append((i, grade))
    return rows, grades


def test_gradient():
    rng = np.random.default_rng(0)
    n, size = 40, 6
    rows, columns = rng.integers(0, n, 90), rng.integers(0, size, 90)
    data = (rows, columns, rng.normal(size=(n, len(SHAPES))), rng.integers(0, 3, n), size)
    at = rng.normal(0, 0.3, 2 + size + len(SHAPES))
    _, slope = _loss(at, data, 2)
    for i in range(len(at)):
        step = np.zeros(len(at))
        step[i] = 1e-6
        change = (_loss(at + step, data, 2)[0] - _loss(at - step, data, 2)[0]) / 2e-6
        assert change == pytest.approx(slope[i], rel=1e-4, abs=1e-4)


def test_held_out_accuracy_and_order(spark):
    rows, grades = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    model = fit(docs, spark.createDataFrame(grades[:200], RATINGS))
    assert (np.diff(model.thresholds) > 0).all()
    scored = {r["doc_id"]: r for r in score(docs, model, 2).collect()}
    held_out = grades[200:]
    right = sum((scored[i]["tail_probability"] >= 0.5) == (g == 2) for i, g in held_out)
    assert right / len(held_out) > 0.95
    mean = [np.mean([scored[i]["expected_grade"] for i, g in held_out if g == k]) for k in range(3)]
    assert mean[0] < mean[1] < mean[2]
    kept = {r["doc_id"] for r in score(docs, model, 2, least=0.5, columns=["doc_id"]).collect()}
    assert kept == {i for i, r in scored.items() if r["tail_probability"] >= 0.5}


def test_edge_rows(spark):
    rows, grades = corpus(60)
    rows += [(100, None, "x"), (101, "", "x"), (102, " \n", "x"), (None, rows[0][1], None), rows[0]]
    rows.append((103, "w1 w2 " * 30_000, "x"))
    docs = spark.createDataFrame(rows, SCHEMA)
    ratings = spark.createDataFrame([*grades, (None, 1), (5, None), (999, 2)], RATINGS)
    model = fit(docs, ratings)
    scored = score(docs, model, 1)
    assert scored.columns == ["doc_id", "text", "slots", "expected_grade", "tail_probability"]
    found = scored.collect()
    assert len(found) == len(rows)
    empty = {r["doc_id"]: r["tail_probability"] for r in found if not (r["text"] or "").strip()}
    assert empty == {100: 0.0, 101: 0.0, 102: 0.0}
    alike = [r["tail_probability"] for r in found if r["text"] == rows[0][1]]
    assert len(alike) == 3 and len(set(alike)) == 1
    assert all(r["tail_probability"] == 1.0 for r in score(docs, model, 0).collect())
    assert score(docs, model, 5, least=0.5).count() == 0
    with pytest.raises(ValueError):
        score(docs.withColumn("expected_grade", F.lit(1)), model, 1)


def test_without_ratings_or_documents(spark):
    rows, grades = corpus(20)
    docs = spark.createDataFrame(rows, SCHEMA)
    model = fit(docs, spark.createDataFrame([], RATINGS))
    kept = score(docs, model, 2, least=0.5).collect()
    assert len(kept) == 20 and all(r["tail_probability"] is None for r in kept)
    assert not len(fit(docs.limit(0), spark.createDataFrame(grades, RATINGS)).thresholds)
    full = fit(docs, spark.createDataFrame(grades, RATINGS))
    assert score(docs.limit(0), full, 2, least=0.5).count() == 0


def test_held_out_labels_of_the_given_tables(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, ratings = table(spark, sf_dir, "documents"), graded(table(spark, sf_dir, "labels"))
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(4))
    model = fit(docs, ratings.where(fold > 0))
    scored = score(docs, model, 2, columns=["doc_id"]).join(ratings.where(fold == 0), "doc_id").collect()
    right = sum((r["tail_probability"] >= 0.5) == (r["grade"] == 2) for r in scored)
    assert right / len(scored) > 0.9
