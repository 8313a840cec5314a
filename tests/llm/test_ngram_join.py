"""The shingle join against all pairs of sets."""

import random

import numpy as np
import pyarrow as pa
import pytest
from oracle import connect, differences
from pyspark.sql import functions as F

from vintagemart.llm import ngram_join
from vintagemart.llm.ngram_join import jaccard_classes, one_per_class, prefix_length
from vintagemart.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id long, text string, n long, component string"


def shingles(text, size):
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(*[words[i:] for i in range(size)]))


def brute(rows, size, percent):
    """(id, n, component, links) per row, by all pairs of rows."""
    sets = [shingles(text, size) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [0] * len(rows)
    for i, one in enumerate(sets):
        for j in range(i):
            if one and sets[j] and 100 * len(one & sets[j]) >= percent * len(one | sets[j]):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    out = []
    for i, (key, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((key, len(sets[i]), min(ids, default=None), links[i]))
    return sorted(out, key=repr)


def near_copies(seed, families, copies, words):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for family in range(families):
        base = [rng.choice(vocabulary) for _ in range(words + 7 * family)]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randrange(0, 4)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append(" ".join(text))
    return list(enumerate(rows))


def found(spark, rows, size, percent):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA)
    return sorted((tuple(r) for r in jaccard_classes(df, size=size, percent=percent).collect()), key=repr)


EDGES = [
    (1, None),
    (2, ""),
    (3, " \n\t"),
    (4, "one two"),
    (5, "ONE\ttwo"),
    (6, "one two three"),
    (7, "one  two\vthree"),
    (8, "É é"),
    (9, "é é"),
    (None, "a b c d e f g h i j k l"),
    (10, "a b c d e f g h i j k l"),
    (10, "something else entirely under the same id"),
    (11, "a a a a a a a a"),
    (12, "a a a a a a a a a a a"),
    (None, "only null ids here today"),
    (None, "only null ids here today"),
]


def test_edge_rows_as_brute_force(spark):
    for size, percent in ((3, 90), (5, 80)):
        assert found(spark, EDGES, size, percent) == brute(EDGES, size, percent)


def test_near_copies_and_a_very_long_text(spark):
    rng = random.Random(1)
    long_text = [f"v{rng.randrange(3000)}" for _ in range(20_000)]
    rows = near_copies(3, families=6, copies=12, words=60)
    rows += [(900, " ".join(long_text)), (901, " ".join(long_text[:-40])), (902, " ".join(long_text[:15_000]))]
    for size, percent in ((3, 90), (5, 80)):
        assert found(spark, rows, size, percent) == brute(rows, size, percent)


def test_large_cells_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 6)
    monkeypatch.setattr(ngram_join, "MARK_SETS", 5)
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", 0)
    rows = near_copies(5, families=3, copies=40, words=40)
    assert found(spark, rows, 3, 80) == brute(rows, 3, 80)


def test_few_long_sets_leave_blocks_empty(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_TOKENS", 50)
    monkeypatch.setattr(ngram_join, "MARK_TOKENS", 70)
    rows = near_copies(7, families=8, copies=2, words=60)
    assert found(spark, rows, 3, 80) == brute(rows, 3, 80)


def test_prefixes_always_meet():
    for percent in (80, 90):
        for n in range(1, 300):
            for m in range(n, 300):
                common = next((c for c in range(1, n + 1) if 100 * c >= percent * (n + m - c)), None)
                if common is None or n == m == common:
                    continue
                # At worst the common tokens are the last ones of both sets.
                assert prefix_length(n, percent) > n - common
                assert prefix_length(m, percent) > m - common


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_marks_keep_every_linked_pair(percent):
    rng = np.random.default_rng(percent)
    sets = []
    for n in (1, 2, 5, 63, 64, 65, 130, 900, 2100):
        base = rng.integers(0, 1 << 62, n, dtype=np.uint64)
        for changed in (0, 1, n // 20, n // 9, n // 4, n // 2):
            sets.append(np.unique(np.concatenate([base[changed:], rng.integers(0, 1 << 62, changed // 2, np.uint64)])))
    sets = [s for s in sets if len(s)]
    sizes = np.array([len(s) for s in sets])
    side = rng.integers(0, 2, len(sets))
    marks = [ngram_join._marks(s) for s in sets]
    alone = ngram_join._near(sizes, marks, side, True, percent)
    apart = ngram_join._near(sizes, marks, side, False, percent)
    linked = 0
    for i, one in enumerate(sets):
        for j, two in enumerate(sets[:i]):
            common = len(np.intersect1d(one, two))
            if 100 * common >= percent * (len(one) + len(two) - common):
                linked += 1
                assert alone[i, j] and alone[j, i]
                assert apart[i, j] == (side[i] != side[j])
    # At lower similarities marks as long as this tell little.
    assert percent < 80 or np.triu(alone, 1).sum() < 2 * linked
    assert not (apart & (side[:, None] == side)).any()


def test_texts_that_share_passages_only_are_cut_apart(spark, monkeypatch):
    kept = []
    materialize = ngram_join.materialize

    def watched(df, name="table"):
        out = materialize(df, name)
        if name in ("cells", "near-cells"):
            kept.append((name, out))
        return out

    monkeypatch.setattr(ngram_join, "materialize", watched)
    rng = random.Random(11)
    passages = [[f"p{i}x{j}" for j in range(40)] for i in range(6)]
    rows = []
    for i in range(60):
        words = [f"u{rng.randrange(30)}" for _ in range(60)]
        text = rng.choice(passages) + words + rng.choice(passages)
        rows += [(2 * i, " ".join(text))] + ([(2 * i + 1, " ".join(text[:-1]))] if i % 5 == 0 else [])
    assert found(spark, rows, 5, 80) == brute(rows, 5, 80)
    largest = {name: max(r["count"] for r in df.groupBy("cell").count().collect()) for name, df in kept}
    assert largest["near-cells"] == 2 < largest["cells"]


def test_many_rows_of_one_id(spark):
    rows = [(1, "a b c d e f g h i j k l")] * 40 + [(1, f"a b c d e f g h i j k l {i}") for i in range(40)]
    rows += [(None, "a b c d e f g h i j k l m")] * 3
    assert found(spark, rows, 3, 90) == brute(rows, 3, 90)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert jaccard_classes(df).columns == ["id", "n_shingles", "component", "links"]
    assert jaccard_classes(df).count() == 0
    assert one_per_class(df).count() == 0


def test_one_row_per_class_stays_with_all_columns(spark):
    rows = [(i, t, i, "x") for i, t in EDGES if i is not None]
    rows += [(20, "same id and text twice over here", 1, "y")] * 2
    df = spark.createDataFrame([r if r[0] is not None else (None, *r[1:]) for r in rows], SCHEMA)
    kept = one_per_class(df, size=3, percent=90)
    assert kept.columns == df.columns
    ids = sorted(r["doc_id"] for r in kept.collect())
    assert ids == [1, 2, 3, 4, 6, 8, 9, 10, 10, 11, 20]


def test_similarity_out_of_range(spark):
    df = spark.createDataFrame([(1, "a", 1, "x")], SCHEMA)
    with pytest.raises(ValueError):
        jaccard_classes(df, percent=100)


def test_other_columns_are_not_read(spark):
    df = spark.createDataFrame([(1, "a b c", 1, "x")], SCHEMA).withColumn("node", F.lit(1)).withColumn("id", F.lit(2))
    assert [tuple(r) for r in jaccard_classes(df).collect()] == [(1, 1, 1, 0)]


def test_query_as_sql(spark, sf_dir):
    name = "op8_ngram_jaccard_join"
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) is None


def test_prefixes_are_shuffled_once(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "components", lambda edges: edges.toDF("node", "root"))
    rows = [(1, 7), (2, 7), (3, 7), (3, 8), (4, 8), (5, 9), (5, 9)]
    cells = ngram_join._cells(spark.createDataFrame(rows, "key long, token long"))
    assert sorted(cells.collect()) == [(2, 1), (3, 1), (4, 3)]
    plan = cells._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan


def test_copies_in_a_task_tell_their_prefixes_once():
    text = " ".join(f"w{i}" for i in range(40))
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1, 2, 3]), pa.array([5, 5, 6]), pa.array([text, text, text + " more"])], names=["id", "tag", "text"]
    )
    rarity = np.full(ngram_join.SKETCH_SLOTS, 2, np.uint8)
    (out,) = ngram_join._prefixes(5, 80, rarity)(iter([batch]))
    told = out.column("first").value_lengths().to_pylist()
    assert told[0] == prefix_length(36, 80) and told[1] == 0 and told[2] == prefix_length(37, 80)
    assert out.column("node")[0] == out.column("node")[1] and out.column("n").to_pylist() == [36, 36, 37]


@pytest.mark.parametrize("percent", [50, 85, 90, 99])
def test_linked_sets_have_a_part_in_common(percent):
    rng = np.random.default_rng(percent)
    hashes = lambda n: rng.integers(0, 1 << 63, n, dtype=np.uint64)
    linked = 0
    for n in (2, 3, 5, 8, 10, 12, 20, 40, 90, 200, 1000):
        for _ in range(60):
            one = np.unique(hashes(n))
            changed = int(rng.integers(0, 2 * n * (100 - percent) // (100 + percent) + 2))
            gone = min(int(rng.integers(0, changed + 1)), n - 1)
            two = np.unique(np.concatenate([one[gone:], hashes(changed - gone)]))
            common = len(np.intersect1d(one, two))
            if common < max(len(one), len(two)) and 100 * common >= percent * (len(one) + len(two) - common):
                linked += 1
                assert len(np.intersect1d(ngram_join._parts(one, percent), ngram_join._parts(two, percent)))
    assert linked > 50


def test_chains_of_shared_passages_make_no_cells(spark, monkeypatch):
    largest = []
    materialize = ngram_join.materialize

    def watched(df, name="table"):
        out = materialize(df, name)
        if name == "cells":
            largest.append(max(r["count"] for r in out.groupBy("cell").count().collect()))
        return out

    monkeypatch.setattr(ngram_join, "materialize", watched)
    rng = random.Random(13)
    passages = [[f"p{i}x{j}" for j in range(13)] for i in range(6)]
    rows = []
    for i in range(60):
        words = [f"u{rng.randrange(30)}" for _ in range(160)]
        text = rng.choice(passages) + words + rng.choice(passages)
        rows += [(2 * i, " ".join(text))] + ([(2 * i + 1, " ".join(text[:-1]))] if i % 5 == 0 else [])
    assert found(spark, rows, 3, 90) == brute(rows, 3, 90)
    assert set(largest) == {2}
