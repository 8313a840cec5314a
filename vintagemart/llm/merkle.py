"""A Merkle manifest of a table, stored at every few levels, with proofs for all rows.

Rows are leaves; those of one value of ``tree_col`` form a tree, whose nodes each hash
up to ``arity`` consecutive nodes below, and the roots of these trees are the leaves of
one tree above them. Leaves are ranked by range partitions and counts per partition, so
a tree that holds a third of all rows is spread like the others.

Only every ``stride``-th level is stored (the checkpoints). Between two of them the
nodes fall into aligned subtrees of ``arity ** stride`` nodes: a bounded group that one
task folds. Proofs go from the top down. At each checkpoint the nodes of a subtree are
gathered once more, the interior levels are computed again from them, every member gets
its siblings there followed by the proof of the subtree's own root, and the interior
nodes are gone. What is shuffled is digests, and proofs of subtrees, not of rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintagemart.sources.scratch import materialize

# monotonically_increasing_id has the partition above these bits.
PART_BITS = 33
NO_STEPS = "cast(array() as array<struct<left: string, right: string>>)"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the joined parts."""
    return F.sha2(F.concat(*parts), 256)


def row_digest(*fields: Column) -> Column:
    """Of each field ``-`` if it is null, else its UTF-8 byte count, ``:`` and its value."""
    parts = []
    for field in fields:
        value = field.cast("string")
        told = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        parts.append(F.coalesce(told, F.lit("-")))
    return digest(*parts)


def folded(start: Column, path: Column) -> Column:
    """The root that follows from a leaf and its proof."""
    return F.aggregate(path, start, lambda below, step: digest(step["left"], below, step["right"]))


def siblings(path: Column) -> Column:
    """All digests of a proof, joined, from the leaf to the root and left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


@dataclass
class Tree:
    """``levels[k]`` has (tree, idx, n, digest) of level ``k * stride``: ``n`` is the
    number of nodes of the tree on that level, and where it is 1 the node is the root.
    ``levels[0]`` has the carried columns besides."""

    levels: list[DataFrame]
    carried: list[str]
    arity: int
    stride: int

    @property
    def width(self) -> int:
        return self.arity**self.stride

    def roots(self) -> DataFrame:
        """(tree, digest)"""
        found = [level.where("n = 1").select("tree", "digest") for level in self.levels]
        out = found[0]
        for more in found[1:]:
            out = out.unionByName(more)
        return out


@dataclass
class Manifest:
    """``rows`` has a tree per value of ``tree_col`` and ``top`` one over their roots;
    ``root`` is the digest of all, None for an empty table."""

    rows: Tree
    top: Tree
    root: str | None


def _ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``idx``, the rank by ``order`` within ``tree``, and ``n``, the size
    of the tree. Rows that are equal by ``order`` may stand either way."""
    ranged = rows.withColumn("tie", F.monotonically_increasing_id())
    by = ["tree", *order, "tie"]
    placed = ranged.repartitionByRange(*by).sortWithinPartitions(*by).drop("tie")
    placed = materialize(placed.withColumn("at", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("at", PART_BITS).alias("part")
    runs = placed.groupBy("tree", part).agg(F.min("at").alias("first"), F.count("*").alias("here"))
    # At most one row per partition in each window.
    whole = Window.partitionBy("tree")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "tree",
        "part",
        (F.coalesce(F.sum("here").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("here").over(whole).alias("n"),
    )
    joined = placed.withColumn("part", part).join(materialize(runs, "runs"), ["tree", "part"])
    return joined.withColumn("idx", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def _subtrees(level: DataFrame, tree: Tree, carried: list[str]) -> DataFrame:
    """(tree, part, n, members, depth, l0, l1, ...): the aligned subtrees of a stored
    level that has something above it. ``depth`` is the number of levels up to the
    subtree's root, ``l1`` and so on the digests regenerated there."""
    part = F.expr(f"idx div {tree.width}").alias("part")
    out = level.where("n > 1").groupBy("tree", part, "n")
    # Never more than ``width`` members.
    out = out.agg(F.sort_array(F.collect_list(F.struct("idx", "digest", *carried))).alias("members"))
    depth = F.lit(tree.stride)
    for k in range(tree.stride - 1, 0, -1):
        depth = F.when(F.col("n") <= tree.arity**k, k).otherwise(depth)
    out = out.withColumn("depth", depth).withColumn("l0", F.col("members.digest"))
    for k in range(tree.stride):
        run = f"array_join(slice(l{k}, cast(i * {tree.arity} + 1 as int), {tree.arity}), '')"
        runs = f"sequence(0, (size(l{k}) - 1) div {tree.arity})"
        fold = F.expr(f"if(depth > {k}, transform({runs}, i -> sha2({run}, 256)), l{k})")
        out = out.withColumn(f"l{k + 1}", fold)
    return out


def _build(leaves: DataFrame, carried: list[str], arity: int, stride: int) -> Tree:
    tree = Tree([leaves], carried, arity, stride)
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        above = _subtrees(tree.levels[-1], tree, []).select(
            "tree",
            F.col("part").alias("idx"),
            F.expr(f"(n + {tree.width - 1}) div {tree.width}").alias("n"),
            F.element_at(f"l{stride}", 1).alias("digest"),
        )
        tree.levels.append(materialize(above, "checkpoint"))
        most = -(-most // tree.width)
    return tree


def build_manifest(
    docs: DataFrame,
    fields: list[str],
    tree_col: str = "source",
    order_col: str = "doc_id",
    carry: dict[str, Column] | None = None,
    arity: int = 3,
    stride: int = 3,
) -> Manifest:
    """Digest every row of ``docs`` by ``fields`` and store the checkpoints.

    Leaves of a tree ascend by ``order_col``, nulls first, and by digest where that is
    the same; equal rows are leaves of their own, in any order. Trees ascend by
    ``tree_col``, null first, else by UTF-8 bytes. Null fields count as nulls, not as
    empty texts. ``carry`` names further expressions over ``docs`` that proofs return.
    A tree of one row is its leaf, and so is the root over one tree. Columns that aren't
    named aren't read. An empty table has no root.
    """
    if arity < 2 or stride < 1:
        raise ValueError("arity must be at least 2 and stride at least 1")
    carry = carry or {}
    kept = {"c_order": F.col(order_col), **{f"c_{name}": c for name, c in carry.items()}}
    tree = F.col(tree_col).cast("string")
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), tree), F.lit("")).alias("tree"),
        row_digest(*[F.col(c) for c in fields]).alias("digest"),
        *[c.alias(name) for name, c in kept.items()],
    )
    # Range partitioning reads its input twice; texts are read once.
    ranked = _ranked(materialize(leaves, "leaves"), ["c_order", "digest"])
    rows = _build(materialize(ranked, "checkpoint"), list(kept), arity, stride)
    roots = rows.roots().select(F.lit("").alias("tree"), F.col("tree").alias("c_tree"), "digest")
    top = _build(materialize(_ranked(roots, ["c_tree"]), "checkpoint"), ["c_tree"], arity, stride)
    root = top.roots().first()
    return Manifest(rows, top, root["digest"] if root else None)


def _paths(tree: Tree, above: DataFrame, given: list[str]) -> DataFrame:
    """(tree, idx, digest, carried columns, ``given``, path) of every leaf. ``above``
    has (tree, ``given``, path): what follows behind the root of each tree."""
    paths = None
    for k in range(len(tree.levels) - 1, -1, -1):
        level, carried = tree.levels[k], tree.carried if k == 0 else []
        columns = ["tree", "idx", "digest", *carried, *given, "path"]
        found = level.where("n = 1").join(above, "tree").select(*columns)
        if paths is not None:
            parents = paths.select("tree", F.col("idx").alias("part"), *given, "path")
            members = _subtrees(level, tree, carried).join(parents, ["tree", "part"])
            members = members.select("*", F.posexplode("members").alias("at", "member"))
            found = found.unionByName(
                members.select(
                    "tree",
                    "member.idx",
                    "member.digest",
                    *[F.col(f"member.{c}").alias(c) for c in carried],
                    *given,
                    F.concat(_steps(tree), F.col("path")).alias("path"),
                )
            )
        paths = found
    return paths


def _steps(tree: Tree) -> Column:
    """The steps from member ``at`` of a subtree to the subtree's root."""
    steps = []
    for k in range(tree.stride):
        here = f"(at div {tree.arity**k})"
        first = f"(at div {tree.arity ** (k + 1)} * {tree.arity})"
        left = f"array_join(slice(l{k}, cast({first} + 1 as int), cast({here} - {first} as int)), '')"
        behind = f"cast({first} + {tree.arity - 1} - {here} as int)"
        right = f"array_join(slice(l{k}, cast({here} + 2 as int), {behind}), '')"
        steps.append(f"struct({left} as left, {right} as right)")
    return F.expr(f"slice(array({', '.join(steps)}), 1, depth)")


def proofs(manifest: Manifest) -> DataFrame:
    """(id, leaf, subroot, path, carried columns): for every row its proof, an array of
    (left, right) with the joined digests beside it on every level, up to its tree's root
    (``subroot``) and from there to the root of all. A level on which a node stands alone
    has an empty step, as its digest is hashed again."""
    top = manifest.top
    start = top.roots().select("tree", F.expr(NO_STEPS).alias("path"))
    above = _paths(top, start, []).select(
        F.col("c_tree").alias("tree"), F.col("digest").alias("subroot"), "path"
    )
    found = _paths(manifest.rows, materialize(above, "tree-paths"), ["subroot"])
    more = [F.col(c).alias(c[2:]) for c in manifest.rows.carried if c != "c_order"]
    return found.select(F.col("c_order").alias("id"), F.col("digest").alias("leaf"), "subroot", "path", *more)
