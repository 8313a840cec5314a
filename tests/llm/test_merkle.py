"""Manifests: roots and proofs beside trees built node by node."""

import hashlib

import pytest
from pyspark.sql import functions as F

from vintagemart.llm.merkle import build_manifest, folded, proofs, siblings

SCHEMA = "doc_id long, source string, text string, tree string, n long"
FIELDS = ["doc_id", "source", "text"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(4)


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    told = [None if v is None else str(v) for v in row]
    return sha(*["-" if v is None else f"{len(v.encode())}:{v}" for v in told])


def tree(leaves, arity):
    """(root, the siblings of each leaf)"""
    level, at, paths = leaves, list(range(len(leaves))), [""] * len(leaves)
    while len(level) > 1:
        runs = [level[i : i + arity] for i in range(0, len(level), arity)]
        for k, a in enumerate(at):
            run = runs[a // arity]
            paths[k] += "".join(d for i, d in enumerate(run) if i != a % arity)
            at[k] = a // arity
        level = [sha(*run) for run in runs]
    return level[0], paths


def plain(rows, arity):
    sources = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))):
        sources.setdefault(r[1], []).append(r)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    built = {s: tree([leaf(r) for r in sources[s]], arity) for s in order}
    root, above = tree([built[s][0] for s in order], arity)
    out = []
    for s, path in zip(order, above):
        for r, own in zip(sources[s], built[s][1]):
            out.append((leaf(r), built[s][0], own + path))
    return root, sorted(out)


def some_rows():
    rows = [(i, "hot", f"text {i}") for i in range(200)]
    rows += [(1000 + i, f"s{i % 9}", "é\n" * (i % 5)) for i in range(60)]
    rows += [(2000, "alone", None), (2001, "", "the empty source"), (2002, None, "no source"), (None, None, None)]
    return rows + [(5, "hot", "text 5"), (5, "hot", "another"), (7, "é", ""), (8, "Z", "z"), (9, "é", "é")]


@pytest.mark.parametrize(("arity", "stride"), [(3, 3), (3, 1), (2, 3), (4, 2)])
def test_same_tree_as_node_by_node(spark, arity, stride):
    manifest = build_manifest(frame(spark, some_rows()), FIELDS, arity=arity, stride=stride)
    found = proofs(manifest).select("id", "leaf", "subroot", siblings(F.col("path")).alias("s"), "path")
    rows = found.withColumn("folded", folded(F.col("leaf"), F.col("path"))).collect()
    root, expected = plain(some_rows(), arity)
    assert manifest.root == root
    assert {r["folded"] for r in rows} == {root}
    assert sorted((r["leaf"], r["subroot"], r["s"]) for r in rows) == expected


@pytest.mark.parametrize("count", [1, 2, 3, 4, 9, 10, 27, 28, 82])
def test_sizes_around_whole_subtrees(spark, count):
    rows = [(i, "one", f"t{i}") for i in range(count)]
    manifest = build_manifest(frame(spark, rows), FIELDS)
    found = proofs(manifest).select("leaf", "subroot", siblings(F.col("path")).alias("s")).collect()
    root, expected = plain(rows, 3)
    assert manifest.root == root and sorted(map(tuple, found)) == expected


def test_altered_rows_give_another_root(spark):
    rows = [(i, f"s{i % 2}", f"line\n{i}") for i in range(40)]
    other = F.when(F.col("doc_id") % 3 == 0, F.sha2("text", 256))
    manifest = build_manifest(frame(spark, rows), FIELDS, carry={"other": other})
    found = proofs(manifest).withColumn("start", F.coalesce("other", "leaf"))
    found = found.withColumn("same", folded(F.col("start"), F.col("path")) == F.lit(manifest.root))
    assert {(r["id"], r["same"]) for r in found.collect()} == {(i, i % 3 != 0) for i in range(40)}
    with pytest.raises(ValueError):
        build_manifest(frame(spark, rows), FIELDS, arity=1)


def test_empty_table(spark):
    manifest = build_manifest(frame(spark, []).limit(0), FIELDS)
    assert manifest.root is None and proofs(manifest).count() == 0
