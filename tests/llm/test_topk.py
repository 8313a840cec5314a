"""Block-wise search against all scores."""

import math
import random

import numpy as np
import pytest
from oracle import connect, differences
from pyspark.sql import functions as F

from vintagemart.llm import topk
from vintagemart.llm.queries import ORACLES, QUERIES
from vintagemart.llm.topk import search_range, top_k

SCHEMA = "vec_id long, embedding array<double>, id string"


def brute(rows, k, scale, is_query):
    clean = [
        (i, [math.floor(scale * x) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, own in sorted({(i, tuple(v)) for i, v in clean if is_query(i)}):
        scores = [(-sum(a * b for a, b in zip(own, v)), i) for i, v in clean if i != q]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def vectors(n, width=8, seed=1):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, 0.4) for _ in range(width)]) for i in range(n)]


@pytest.mark.parametrize("small", [False, True])
def test_as_brute_force(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(topk, "BLOCK", 8)
        monkeypatch.setattr(topk, "RANGE", 40)
        monkeypatch.setattr(topk, "CHUNK", 4)
    rows = vectors(150)
    # Ties, a common vector, repeated rows, rows that take no part, unlike lengths.
    rows += [(200 + i, [0.5] * 8) for i in range(60)]
    rows += [rows[3], (5, [0.1] * 8), (10, [0.3] * 8)]
    rows += [(None, [0.1] * 8), (300, None), (301, [0.1, None]), (302, [math.nan]), (303, [math.inf, 1.0])]
    rows += [(305, []), (310, [0.5, -0.5]), (315, [1e9] * 8), (320, [-0.0] * 12)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA)
    found = top_k(df, 7, F.col("id") % 5 == 0)
    assert found.columns == ["query_id", "rank", "id", "score"]
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, 7, 64, lambda i: i % 5 == 0)


def test_fewer_rows_than_asked_and_empty(spark):
    df = spark.createDataFrame([(i, v, "x") for i, v in vectors(4)], SCHEMA)
    assert top_k(df, 20, F.col("id") == 0).count() == 3
    assert top_k(df.limit(0), 20, F.col("id") == 0).count() == 0
    assert top_k(df, 20, F.col("id") < 0).count() == 0


def test_blocks_below_the_bound_are_not_scored(monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 10)
    monkeypatch.setattr(topk, "_best", lambda *a, best=topk._best: calls.append(1) or best(*a))
    calls = []
    vectors = np.repeat(np.arange(50)[::-1, None], 10, axis=0) * np.ones((1, 4), int)
    found = search_range(np.array([-1]), np.ones((1, 4)), np.arange(500), vectors.astype(object), 5)
    assert [f[1] for f in found] == [0, 1, 2, 3, 4]
    assert len(calls) == 1


def test_query_as_sql(spark, sf_dir):
    name = "op3_exact_top_k"
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) is None
