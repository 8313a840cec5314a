"""Ranks, splits, neighbours and oversampling against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vintagemart.operators import ranking, sampling, split


def test_row_numbers_follow_md5(spark):
    df = spark.range(500).withColumn("g", F.when(F.col("id") < 400, "big").otherwise("small"))
    got = ranking.shuffled_row_number(df, ["id"], 7, ["g"]).collect()
    for group in ("big", "small"):
        ids = [r["id"] for r in sorted(got, key=lambda r: r["row_number"]) if r["g"] == group]
        md5 = sorted(ids, key=lambda i: hashlib.md5(f"{i}:7".encode()).hexdigest())
        assert ids == md5
        numbers = sorted(r["row_number"] for r in got if r["g"] == group)
        assert numbers == list(range(1, len(ids) + 1))


def labelled(spark, sizes):
    rows, i = [], 0
    for label, n in sizes.items():
        for _ in range(n):
            rows.append((i, label))
            i += 1
    return spark.createDataFrame(rows, "id bigint, label int")


def counts(df):
    rows = df.groupBy("split", "label").count().collect()
    return {(r["split"], r["label"]): r["count"] for r in rows}


def test_stored_split_sizes(spark):
    got = counts(split.stratified_split(labelled(spark, {0: 8767, 1: 733}), ["id"]))
    assert got == {
        ("train", 0): 7014, ("test", 0): 1753, ("train", 1): 586, ("test", 1): 147,
    }


@pytest.mark.parametrize("sizes", [{0: 10, 1: 3}, {0: 7}, {0: 100, 1: 1, 2: 9}, {0: 1, 1: 1}])
def test_split_is_complete_and_has_its_size(spark, sizes):
    df = labelled(spark, sizes)
    parts = split.stratified_split(df, ["id"])
    n = sum(sizes.values())
    assert parts.count() == parts.select("id").distinct().count() == n
    assert parts.where("split = 'test'").count() == -(-n * 2 // 10)


def test_quotas_of_huge_classes(spark):
    """Counts whose product exceeds 64 bits."""

    class Huge:
        def groupBy(self, label):
            return self

        def agg(self, n):
            return spark.createDataFrame([(0, 10**13 + 3), (1, 7)], "label int, n bigint")

    got = {r["label"]: r["n_test"] for r in split.class_quotas(Huge(), "label", 0.2).collect()}
    assert got == {0: 2 * 10**12 + 1, 1: 1}


def test_split_does_not_depend_on_partitions(spark):
    df = labelled(spark, {0: 300, 1: 60})
    a = split.stratified_split(df.repartition(1), ["id"], seed=5)
    b = split.stratified_split(df.repartition(13), ["id"], seed=5)
    assert sorted(a.collect()) == sorted(b.collect())


def test_repeated_ids_are_cut_at_the_quota(spark):
    df = spark.range(1000).select((F.col("id") % 4).alias("id"), F.lit(0).alias("label"))
    assert counts(split.stratified_split(df, ["id"])) == {("train", 0): 800, ("test", 0): 200}


def test_rows_without_a_label(spark):
    df = labelled(spark, {0: 50, 1: 10}).unionAll(spark.createDataFrame([(900, None)], "id bigint, label int"))
    assert counts(split.stratified_split(df, ["id"])) == {
        ("train", 0): 40, ("test", 0): 10, ("train", 1): 8, ("test", 1): 2, (None, None): 1,
    }
    weights = {r["label"]: r["weight"] for r in split.add_class_weights(df).distinct().collect()}
    assert weights == {0: 60 / 100, 1: 60 / 20, None: None}


def test_a_label_with_too_many_values(spark, monkeypatch):
    monkeypatch.setattr(split, "MAX_CLASSES", 3)
    df = labelled(spark, {i: 2 for i in range(4)})
    with pytest.raises(ValueError, match="more than 3 values"):
        split.stratified_split(df, ["id"])
    with pytest.raises(ValueError, match="more than 3 values"):
        sampling.oversample(df.withColumn("features", F.array(F.lit(1.0))))


def test_bucket_digits_follow_the_rows():
    assert [ranking.bucket_digits(n) for n in (0, 1_600_000, 1_600_001, 10**12)] == [1, 1, 2, 6]


def test_class_weights(spark):
    got = {r["label"]: r["weight"] for r in split.balanced_class_weights(
        labelled(spark, {0: 90, 1: 10})).collect()}
    assert got == {0: 100 / 180, 1: 100 / 20}


def cloud(seed, n, dim, clusters):
    """Clustered points, a third of them in one tight cluster, with exact copies."""
    r = np.random.default_rng(seed)
    centres = r.normal(size=(clusters, dim)) * 20
    which = np.where(r.random(n) < 0.33, 0, r.integers(0, clusters, n))
    points = centres[which] + r.normal(size=(n, dim))
    points[n // 2 : n // 2 + 10] = points[:10]
    return points


def brute_neighbours(points, k):
    out = {}
    for i, p in enumerate(points):
        distance = np.sqrt(((points - p) ** 2).sum(axis=1))
        order = sorted((d, j) for j, d in enumerate(distance) if j != i)[:k]
        out[i] = [j for _, j in order]
    return out


@pytest.mark.parametrize(
    "n, dim, options",
    [
        (60, 3, {}),
        (900, 2, {"block_rows": 10}),
        (400, 3, {"block_rows": 16, "max_pivots": 12, "rings": 6}),
        (400, 3, {"block_rows": 40, "max_pivots": 3, "rings": 1}),
        (200, 24, {"block_rows": 25, "max_pivots": 8, "rings": 4}),
        (5, 2, {"block_rows": 2}),
    ],
)
def test_neighbours_are_exact(spark, n, dim, options):
    points = cloud(n, n, dim, 6) if n >= 60 else cloud(1, 30, dim, 2)[:n]
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)],
                               "id bigint, features array<double>")
    got = {}
    for r in sampling.nearest_neighbours(df, 5, **options).orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append(r["neighbour_id"])
    assert got == brute_neighbours(points, 5)


def test_wanted_points_and_copies_of_one_vector(spark):
    points = np.vstack([np.zeros((40, 3)), cloud(3, 90, 3, 4), np.ones((3, 3))])
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)],
                               "id bigint, features array<double>")
    expected = brute_neighbours(points, 5)
    wanted = spark.createDataFrame([(i,) for i in (0, 39, 77, 131, 999)], "id bigint")
    for options in ({}, {"block_rows": 9}):
        got = {}
        found = sampling.nearest_neighbours(df, 5, wanted=wanted, **options)
        for r in found.orderBy("id", "rank").collect():
            got.setdefault(r["id"], []).append(r["neighbour_id"])
        assert got == {i: expected[i] for i in (0, 39, 77, 131)}


def test_pruning_leaves_rings_out():
    """Far rings are not visited when the points are clustered."""
    rows = [
        {"cell": c, "ring": 0, "n": 10, "low": 0.0, "high": 1.0} for c in range(3)
    ]
    rings = sampling._Rings(rows, 5)
    to_pivot = np.array([[0.5, 100.0, 200.0], [200.0, 100.0, 0.5]])
    far = np.array([np.inf, np.inf])
    assert rings.wanted(to_pivot, far).tolist() == [[True, False, False], [False, False, True]]


def neighbour_lists(found):
    lists = {}
    for r in found.orderBy("id", "rank").collect():
        lists.setdefault(r["id"], []).append(r["neighbour_id"])
    return lists


@pytest.mark.parametrize("n, dim, block_rows", [(500, 2, 4), (400, 20, 16)])
def test_many_units_and_shares(spark, monkeypatch, n, dim, block_rows):
    monkeypatch.setattr(sampling, "UNIT_ROWS", 24)
    points = np.vstack([cloud(n, n, dim, 5), np.indices((6, 8)).reshape(2, -1).T @ np.eye(2, dim)])
    df = spark.createDataFrame([(f"{i:04}", p.tolist()) for i, p in enumerate(points)],
                               "id string, features array<double>")
    expected = {f"{i:04}": [f"{j:04}" for j in js] for i, js in brute_neighbours(points, 5).items()}
    assert neighbour_lists(sampling.nearest_neighbours(df, 5, block_rows=block_rows)) == expected


def test_small_blocks_share_a_task():
    """As many pairs of shares as the points ask for, however small the blocks are."""
    rows = [{"cell": i // 32, "ring": i % 32, "n": 16, "low": 0.0, "high": 1.0} for i in range(2048)]
    rows[100]["n"] = 20_000
    rings = sampling._Rings(rows, 5, 8192)
    assert rings.n_sub == [1, 3, 1, 1, 1, 1] and rings.first[1:3] == [100, 101]
    everywhere = rings.targets(np.zeros((2, 64)), np.full(2, np.inf))
    assert everywhere.shape == (2, 6) and everywhere.all()


def test_vectors_without_numbers_are_near_their_copies_only(spark):
    nan, inf = float("nan"), float("inf")
    odd = [None, [None, 1.0], [nan, 1.0], [nan, 1.0], [inf, 1.0], [1e200, 0.0], [3e200, 0.0]]
    rows = [(i, [float(i), 0.0]) for i in range(30)] + [(30 + i, v) for i, v in enumerate(odd)]
    df = spark.createDataFrame(rows, "id bigint, features array<double>")
    for block_rows in (4, 1024):
        got = neighbour_lists(sampling.nearest_neighbours(df, 2, block_rows=block_rows))
        assert got[0] == [1, 2] and got[9] == [8, 10]
        assert {i: js for i, js in got.items() if i >= 30} == {32: [33], 33: [32]}


def vectors(spark, n_major, n_minor):
    r = random.Random(2)
    rows = [(i, [r.random(), r.random()], int(i >= n_major)) for i in range(n_major + n_minor)]
    return spark.createDataFrame(rows, "id bigint, features array<double>, label int"), rows


def test_oversampling_fills_the_smaller_class(spark):
    df, rows = vectors(spark, 120, 13)
    grown = sampling.oversample(df)
    assert {r["label"]: r["count"] for r in grown.groupBy("label").count().collect()} == {
        0: 120, 1: 120,
    }
    kept = {(r["id"], tuple(r["features"]), r["label"]) for r in grown.collect() if r["id"] is not None}
    assert kept == {(i, tuple(f), y) for i, f, y in rows}


def test_synthetic_points_lie_between_neighbours(spark):
    df, rows = vectors(spark, 120, 13)
    minority = {i: np.array(f) for i, f, y in rows if y == 1}
    points = np.array(list(minority.values()))
    ids = list(minority)
    near = {ids[i]: {ids[j] for j in js} for i, js in brute_neighbours(points, 5).items()}
    drawn = sampling.synthesize(df.where("label = 1"), 13, 107).collect()
    per_base = {}
    for r in drawn:
        assert r["neighbour_id"] in near[r["base_id"]] and 0 <= r["gap"] < 1
        a, b = minority[r["base_id"]], minority[r["neighbour_id"]]
        assert r["features"] == pytest.approx((a + r["gap"] * (b - a)).tolist())
        per_base[r["base_id"]] = per_base.get(r["base_id"], 0) + 1
    assert len(drawn) == 107 and set(per_base.values()) == {8, 9}


def test_no_oversampling_of_a_tiny_class(spark):
    df, _ = vectors(spark, 20, 5)
    assert sampling.oversample(df).count() == 25


def test_tasks_hold_bounded_intermediates(monkeypatch):
    """Squares and lists of units come a few points at a time, however many a task is given."""
    monkeypatch.setattr(sampling, "HELD_NUMBERS", 1000)
    points = np.random.default_rng(1).normal(size=(500, 3))
    rows = [{"cell": c, "ring": 0, "n": 20, "low": 0.0, "high": 9.0} for c in range(50)]
    rings = sampling._Rings(rows, 5, 20)
    batch = pa.RecordBatch.from_pydict({"id": range(500), "features": points.tolist(), "reached": [1.0] * 500})
    pivots = np.zeros((50, 3))
    out = list(sampling._visits(pivots, rings)(iter([batch])))
    assert sum(map(len, out)) == 500 and max(map(len, out)) <= 20
    assert all(len(t) == 50 for b in out for t in b.column("targets").to_pylist())
    assert max(square.size for _, square, _ in sampling._squares(points, points)) <= 1000
