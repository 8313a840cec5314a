"""Approximate neighbours beside brute force."""

import numpy as np
import pytest

from vintagemart.operators import lsh, sampling


def frame(spark, vectors):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "id bigint, features array<double>").repartition(3)


def clusters(n=300, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 8)) * 6
    return centres[rng.integers(0, 12, n)] + rng.normal(size=(n, 8)) * 0.5


def exact(vectors, k):
    gaps = np.sqrt(((vectors[:, None] - vectors[None]) ** 2).sum(-1))
    np.fill_diagonal(gaps, np.inf)
    return {i: set(np.argsort(row, kind="stable")[:k].tolist()) for i, row in enumerate(gaps)}, gaps


@pytest.mark.parametrize("block_rows", [1024, 16])
def test_recall_and_distances(spark, block_rows):
    vectors = clusters()
    found = lsh.lsh_neighbours(frame(spark, vectors), width=4.0, block_rows=block_rows).collect()
    near, gaps = exact(vectors, 5)
    hits = sum(r["neighbour_id"] in near[r["id"]] for r in found)
    assert hits >= 0.9 * 5 * len(vectors)
    assert all(r["distance"] == pytest.approx(gaps[r["id"], r["neighbour_id"]]) for r in found)
    assert all(r["id"] != r["neighbour_id"] for r in found)
    ranks = {}
    for r in sorted(found, key=lambda r: (r["id"], r["rank"])):
        ranks.setdefault(r["id"], []).append(r["distance"])
    assert all(d == sorted(d) and len(d) <= 5 for d in ranks.values())


def test_points_that_no_hash_tells_apart_are_compared_in_blocks(spark):
    rng = np.random.default_rng(0)
    vectors = np.concatenate([rng.normal(size=(60, 4)) * 1e-6, rng.normal(size=(20, 4))])
    search = {"width": 1e9, "block_rows": 8, "tables": 1, "depth": 1, "most_depth": 3}
    found = lsh.lsh_neighbours(frame(spark, vectors), k=3, **search).collect()
    near, _ = exact(vectors, 3)
    assert {(r["id"], r["neighbour_id"]) for r in found} == {(i, j) for i, s in near.items() for j in s}


def test_copies_are_neighbours_and_recall_is_counted(spark):
    df = frame(spark, [[1.0, 2.0]] * 30 + [[50.0, 50.0]])
    found = lsh.lsh_neighbours(df, width=1.0, k=2)
    rows = found.collect()
    assert sorted(r["neighbour_id"] for r in rows if r["id"] == 5) == [0, 1]
    assert all(r["distance"] == 0.0 for r in rows if r["id"] < 30)
    about = lsh.recall(found, sampling.nearest_neighbours(df, 2)).first()
    assert about["n_exact"] == 62 and about["n_found"] >= 60
    assert lsh.lsh_neighbours(df.limit(0), width=1.0).count() == 0
    with pytest.raises(ValueError):
        lsh.lsh_neighbours(df, width=0.0)
