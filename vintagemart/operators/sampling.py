"""Exact nearest neighbours in bounded blocks, and minority oversampling."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from vintagemart.operators.joins import salted_join
from vintagemart.operators.ranking import (
    shuffle_key,
    shuffled_row_number,
    small_int,
    unit_interval,
)
from vintagemart.operators.split import require_few_classes
from vintagemart.sources.scratch import materialize

MAX_PIVOTS = 64
RINGS = 32
BLOCK_ROWS = 1024
# Rows that a task holds of either side, of as many blocks as that takes.
UNIT_ROWS = 8192
# Numbers in an intermediate of a task.
HELD_NUMBERS = 1 << 20
NEIGHBOURS = 5
MIN_MINORITY = 6

# Slack for rounding when a bound decides that a block cannot matter.
SLACK = 1e-9


def _vectors(features: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of doubles as one matrix; missing components are NaN."""
    if isinstance(features, pa.ChunkedArray):
        features = pa.concat_arrays(features.chunks)
    lengths = features.value_lengths().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths != lengths[0]).any():
        raise ValueError("vectors must have one length")
    numbers = features.flatten().to_numpy(zero_copy_only=False).astype("float64", copy=False)
    return numbers.reshape(len(lengths), -1) if len(numbers) else np.empty((len(lengths), 0))


def _distances(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Euclidean distances, a few rows at a time to bound the intermediate."""
    out = np.empty((len(rows), len(others)))
    step = max(1, HELD_NUMBERS // max(1, others.size))
    for i in range(0, len(rows), step):
        out[i : i + step] = np.sqrt(((rows[i : i + step, None, :] - others[None]) ** 2).sum(-1))
    return out


def _pair_distances(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Euclidean distance of each row and the other one at its place."""
    return np.sqrt(((rows - others) ** 2).sum(-1))


def _squares(rows: np.ndarray, others: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Squared distances from one product, a stretch of the rows at a time, and how far
    those of each row may be off."""
    eps = np.finfo(float).eps
    with np.errstate(over="ignore", invalid="ignore"):
        own, their = (rows**2).sum(-1), (others**2).sum(-1)
        plain = np.isfinite(own).all() and np.isfinite(their).all()
        step = max(1, HELD_NUMBERS // max(1, len(others)))
        for start in range(0, len(rows), step):
            part = slice(start, min(start + step, len(rows)))
            if plain:
                square = rows[part] @ others.T
                square *= -2
                square += own[part, None]
                square += their
                off = 8 * (rows.shape[1] + 4) * eps * (own[part] + their.max(initial=0))
            else:
                # Squares too large for the product, or components that are no numbers.
                square = _distances(rows[part], others) ** 2
                off = 8 * eps * np.where(np.isfinite(square), square, 0).max(axis=1, initial=0)
            yield part, square, off


def _smallest(square: np.ndarray, k: int) -> np.ndarray:
    """The k-th smallest of each row, counted from 0; infinite if there are fewer numbers."""
    if square.shape[1] <= k:
        return np.full(len(square), np.inf)
    found = np.partition(square, k, axis=1)[:, k]
    return np.where(np.isnan(found), np.inf, found)


def _locate(points: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Add the nearest pivot (cell) and the distance to it."""
    located = StructType.fromDDL("cell int, radius double")

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            to_pivot = _distances(_vectors(batch.column("features")), pivots)
            added = [to_pivot.argmin(axis=1).astype("int32"), to_pivot.min(axis=1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *map(pa.array, added)], names=[*batch.schema.names, *located.names]
            )

    return points.mapInArrow(locate, StructType(points.schema.fields + located.fields))


class _Rings:
    """Extent and size of each occupied ring: at most MAX_PIVOTS * RINGS entries.

    Rings that follow each other are one unit of at most ``unit_rows`` points; a larger
    ring is a unit of ``n_sub`` shares.
    """

    def __init__(self, rows: list, k: int, unit_rows: int = UNIT_ROWS):
        rows = sorted(rows, key=lambda r: (r["cell"], r["ring"]))
        self.cell = np.array([r["cell"] for r in rows])
        self.low = np.array([r["low"] for r in rows])
        self.high = np.array([r["high"] for r in rows])
        self.size = np.array([r["n"] for r in rows])
        self.key = [(r["cell"], r["ring"]) for r in rows]
        # Per cell the radius around its pivot that holds k + 1 points.
        self.reach = np.full(self.cell.max() + 1, np.inf)
        for cell in np.unique(self.cell):
            mine = np.flatnonzero(self.cell == cell)
            enough = np.flatnonzero(self.size[mine].cumsum() > k)
            if len(enough):
                self.reach[cell] = self.high[mine[enough[0]]]
        # Per unit the first ring and the shares.
        self.first: list[int] = []
        self.n_sub: list[int] = []
        held = unit_rows
        for at, size in enumerate(self.size.tolist()):
            if held + size > unit_rows:
                self.first.append(at)
                self.n_sub.append(ceil(size / unit_rows))
                held = 0
            held += size
        self.unit = np.repeat(np.arange(len(self.first)), np.diff([*self.first, len(self.cell)]))

    def targets(self, to_pivot: np.ndarray, reached: np.ndarray) -> np.ndarray:
        """Which units hold a wanted ring of each row."""
        return np.logical_or.reduceat(self.wanted(to_pivot, reached), self.first, axis=1)

    def wanted(self, to_pivot: np.ndarray, reached: np.ndarray) -> np.ndarray:
        """Which rings can hold one of the k nearest neighbours of each row.

        k neighbours lie within ``bound``: the k-th distance ``reached`` inside
        the row's own block, or what the pivots promise. A ring matters only
        if, by the triangle inequality, it comes that near.
        """
        promised = (to_pivot[:, : len(self.reach)] + self.reach).min(axis=1)
        bound = (np.minimum(promised, reached) * (1 + SLACK) + SLACK)[:, None]
        centre = to_pivot[:, self.cell]
        nearest = to_pivot.min(axis=1, keepdims=True)
        return (
            (self.low[None] <= centre + bound)
            & (self.high[None] >= centre - bound)
            & (centre - nearest <= 2 * bound)
        )


def _reach_in_block(k: int):
    """The points with ``ask`` and how far the k-th nearest other row of their share is."""

    def reach(block: pa.Table) -> pa.Table:
        rows = _vectors(block.column("features"))
        asked = np.flatnonzero(block.column("ask").to_numpy())
        reached = np.empty(len(asked))
        # The row itself is among the k + 1 nearest, at distance 0.
        for part, square, off in _squares(rows[asked], rows):
            reached[part] = np.sqrt(np.maximum(_smallest(square, k), 0) + off)
        return block.select(["id", "features"]).take(asked).append_column("reached", pa.array(reached))

    return reach


def _visits(pivots: np.ndarray, rings: _Rings):
    """Add the units that a point has to visit, a few points at a time."""

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, HELD_NUMBERS // len(rings.cell))
        for whole in batches:
            for start in range(0, len(whole), step):
                batch = whole.slice(start, step)
                to_pivot = _distances(_vectors(batch.column("features")), pivots)
                wanted = rings.targets(to_pivot, batch.column("reached").to_numpy())
                ends = np.concatenate([[0], wanted.sum(axis=1).cumsum()]).astype("int32")
                units = pa.ListArray.from_arrays(ends, np.nonzero(wanted)[1].astype("int32"))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, units], names=[*batch.schema.names, "targets"]
                )

    return visits


def _closest(k: int):
    """The k nearest candidates of each query inside one pair of shares, ties by id.

    A query with ``reached`` has k neighbours within that distance, so farther ones are
    left out. What the product of the vectors leaves is compared number by number.
    """

    def closest(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        candidates = candidates.take(pc.sort_indices(candidates.column("id")))
        rows, others = _vectors(queries.column("features")), _vectors(candidates.column("features"))
        ids = pc.unique(candidates.column("id"))
        named = lambda t: pc.index_in(t.column("id"), value_set=ids).to_numpy()
        own, their = np.nan_to_num(named(queries), nan=-1.0), named(candidates)
        # The candidates with the query's own id.
        first, last = np.searchsorted(their, own, "left"), np.searchsorted(their, own, "right")
        known = "reached" in queries.column_names
        reached = queries.column("reached").to_numpy() if known else np.full(len(rows), np.inf)
        found: list[tuple[np.ndarray, ...]] = [(np.empty(0, int), np.empty(0, int), np.empty(0))]
        for part, square, off in _squares(rows, others):
            for more in range((last - first)[part].max(initial=0)):
                row = np.flatnonzero(first[part] + more < last[part])
                square[row, first[part][row] + more] = np.inf
            limit = np.minimum(_smallest(square, k - 1) + off, reached[part] ** 2 * (1 + SLACK)) + off
            i, j = np.nonzero((square <= limit[:, None]) & np.isfinite(square))
            step = max(1, HELD_NUMBERS // max(1, rows.shape[1]))
            cuts = [slice(at, at + step) for at in range(0, len(i), step)]
            far = [_pair_distances(rows[part][i[c]], others[j[c]]) for c in cuts]
            distance = np.concatenate(far) if far else np.empty(0)
            order = np.lexsort((j, distance, i))
            i, j, distance = i[order], j[order], distance[order]
            best = (np.arange(len(i)) - np.searchsorted(i, i) < k) & np.isfinite(distance)
            found.append((i[best] + part.start, j[best], distance[best]))
        i, j, distance = map(np.concatenate, zip(*found))
        return pa.table(
            [queries.column("id").take(pa.array(i)), candidates.column("id").take(pa.array(j)), pa.array(distance)],
            names=["id", "neighbour_id", "distance"],
        )

    return closest


def nearest_neighbours(
    points: DataFrame,
    k: int = NEIGHBOURS,
    id_col: str = "id",
    features_col: str = "features",
    max_pivots: int = MAX_PIVOTS,
    rings: int = RINGS,
    block_rows: int = BLOCK_ROWS,
    wanted: DataFrame | None = None,
    search: Callable[[DataFrame, int], DataFrame] | None = None,
) -> DataFrame:
    """The k nearest other points of every point: id, rank, neighbour_id, distance.

    Exact, ties by neighbour id; with ``wanted`` (a column ``id``) only these points
    are searched for, among all. Equal vectors are one point with the k + 1 smallest
    of their ids, which is all that k neighbours can need, so copies are never
    compared with each other.

    Distinct vectors are located in rings around a few pivots, about one ring per
    ``block_rows`` points. Rings that follow each other are a unit of at most UNIT_ROWS
    points, larger ones are cut into shares of that size. A first pass inside each
    share bounds how far a point's neighbours can be; the point is then sent only to
    units with a ring that comes that near. A task compares two bounded shares and
    returns at most k rows per point, however small the blocks and however dense one
    region is. What comes to the driver is the pivots and one summary row per ring.
    Vectors with missing or non-finite components are near none but their copies.

    ``search`` takes the place of the exact search among distinct vectors (id, features,
    ask), such as ``lsh.near_vectors``; it is never chosen by size.
    """
    points = materialize(
        points.select(
            F.col(id_col).alias("id"), F.col(features_col).cast("array<double>").alias("features")
        ),
        "knn-points",
    )
    # Cut on the map side: a vector that many points share never meets in full.
    in_order = Window.partitionBy("features").orderBy("id")
    first = points.withColumn("place", F.row_number().over(in_order)).where(F.col("place") <= k + 1)
    groups = first.groupBy("features").agg(
        F.min("id").alias("group"), F.sort_array(F.collect_list("id")).alias("ids")
    )
    groups = materialize(groups, "knn-groups")
    asked = points if wanted is None else points.join(wanted.select("id"), "id", "left_semi")
    asked = asked.join(groups.select("features", "group"), "features").select("id", "group")
    asked = materialize(asked, "knn-asked")
    searched = asked.select("group").distinct().withColumn("ask", F.lit(True))
    distinct = groups.join(searched, "group", "left").select(
        F.col("group").alias("id"), "features", F.coalesce("ask", F.lit(False)).alias("ask")
    )
    distinct = materialize(distinct, "knn-distinct")
    if search is not None:
        near = search(distinct, k)
    else:
        near = _nearest_distinct(distinct, k, max_pivots, rings, block_rows)
    own = searched.select(
        F.col("group").alias("id"), F.col("group").alias("neighbour_id"), F.lit(0.0).alias("distance")
    )
    members = groups.select(
        F.col("group").alias("neighbour_id"), F.explode("ids").alias("member")
    )
    lists = near.select("id", "neighbour_id", "distance").unionByName(own)
    candidates = lists.join(members, "neighbour_id").select(
        "id", F.col("member").alias("neighbour_id"), "distance"
    )
    best = _ranked(candidates, k + 1).select(F.col("id").alias("group"), "neighbour_id", "distance")
    found = asked.join(best, "group").where(F.col("id") != F.col("neighbour_id"))
    return _ranked(found, k)


def _nearest_distinct(
    points: DataFrame, k: int, max_pivots: int, rings: int, block_rows: int
) -> DataFrame:
    """The k nearest other vectors of every vector with ``ask``."""
    spark = points.sparkSession
    points = points.where(F.forall("features", lambda x: F.abs(x) < F.lit(float("inf"))))
    n = points.count()
    n_blocks = ceil(n / block_rows)
    if n_blocks <= 1:
        return _ranked(_compare_all_in_one_block(points, k), k)
    # About one block per ring: a point that must look everywhere is sent to
    # no more rings than there are blocks.
    n_pivots = min(max_pivots, ceil(n_blocks**0.5))
    n_rings = min(rings, ceil(n_blocks / n_pivots))

    chosen = points.orderBy(shuffle_key(["id"], "pivot"), "id").limit(n_pivots)
    pivots = np.array([r["features"] for r in chosen.collect()])
    located = materialize(_locate(points, pivots), "knn-located")
    widest = located.agg(F.max("radius")).first()[0] or 1.0
    ring = F.least(F.floor(F.col("radius") / F.lit(widest) * n_rings), F.lit(n_rings - 1))
    located = located.withColumn("ring", ring.cast("int"))
    extents = located.groupBy("cell", "ring").agg(
        F.count("*").alias("n"), F.min("radius").alias("low"), F.max("radius").alias("high")
    )
    unit_rows = UNIT_ROWS
    summary = _Rings(extents.collect(), k, unit_rows)
    sizes = F.broadcast(
        spark.createDataFrame(
            [(int(i), *key, summary.n_sub[i]) for i, key in zip(summary.unit, summary.key)],
            "target int, cell int, ring int, n_sub bigint",
        )
    )
    shared = located.join(sizes, ["cell", "ring"]).withColumn(
        "sub", F.pmod(F.xxhash64(F.lit("sub"), "id"), F.col("n_sub"))
    )
    own = shared.select("target", "sub", "id", "features", "ask")
    asked = points.select("id", "features").schema.fields
    with_reach = StructType([*asked, StructField("reached", DoubleType())])
    with_units = StructType([*with_reach.fields, StructField("targets", ArrayType(IntegerType()))])
    reached = own.groupBy("target", "sub").applyInArrow(_reach_in_block(k), with_reach)
    visits = materialize(reached.mapInArrow(_visits(pivots, summary), with_units), "knn-visits")
    per_unit = visits.select(F.explode("targets").alias("target")).groupBy("target").count()
    parts = F.broadcast(
        spark.createDataFrame(
            [
                (r["target"], summary.n_sub[r["target"]], ceil(r["count"] / unit_rows))
                for r in per_unit.collect()
            ],
            "target int, n_sub bigint, n_part bigint",
        )
    )
    queries = (
        visits.select("id", "features", "reached", F.explode("targets").alias("target"))
        .join(parts, "target")
        .withColumn("part", F.pmod(F.xxhash64(F.lit("part"), "id"), F.col("n_part")))
        .withColumn("sub", _each(F.col("n_sub")))
        .select("target", "sub", "part", "id", "features", "reached")
    )
    candidates = (
        shared.drop("n_sub").join(parts, "target")
        .withColumn("part", _each(F.col("n_part")))
        .select("target", "sub", "part", "id", "features")
    )
    share = ["target", "sub", "part"]
    found = (
        queries.groupBy(*share)
        .cogroup(candidates.groupBy(*share))
        .applyInArrow(_closest(k), _found_schema(points))
    )
    return _ranked(found, k)


def _each(n: Column) -> Column:
    """One row per number from 0 up to but not including ``n`` (at least 1)."""
    return F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1))


def _found_schema(points: DataFrame) -> StructType:
    id_type = points.schema["id"].dataType
    return StructType(
        [
            StructField("id", id_type),
            StructField("neighbour_id", id_type),
            StructField("distance", DoubleType()),
        ]
    )


def _compare_all_in_one_block(points: DataFrame, k: int) -> DataFrame:
    """Fewer points than one block holds: a single bounded comparison."""
    closest = _closest(k)
    return points.groupBy().applyInArrow(
        lambda block: closest(block.filter(block.column("ask")), block), _found_schema(points)
    )


def _ranked(found: DataFrame, k: int) -> DataFrame:
    nearest = Window.partitionBy("id").orderBy("distance", "neighbour_id")
    return (
        found.withColumn("rank", F.row_number().over(nearest))
        .where(F.col("rank") <= k)
        .select("id", "rank", "neighbour_id", "distance")
    )


def synthesize(
    minority: DataFrame,
    n_minority: int,
    n_new: int,
    k: int = NEIGHBOURS,
    seed: int = 42,
    id_col: str = "id",
    features_col: str = "features",
    **blocks,
) -> DataFrame:
    """``n_new`` points, each on the segment from a minority point to one of its
    k nearest neighbours: draw, base_id, neighbour_id, gap, features.

    Base points take turns, so each gets the same number of draws up to one.
    Which neighbour and how far along follow from the draw number and the seed.
    """
    spark = minority.sparkSession
    k = min(k, n_minority - 1)
    points = minority.select(
        F.col(id_col).alias("id"), F.col(features_col).cast("array<double>").alias("features")
    )
    # Only points that are drawn need neighbours.
    indexed = shuffled_row_number(points, ["id"], f"base:{seed}", name="base_index")
    indexed = materialize(indexed.where(F.col("base_index") <= min(n_new, n_minority)), "bases")
    near = nearest_neighbours(points, k, wanted=indexed, **blocks)
    near = near.select("id", "rank", "neighbour_id")
    ends = points.select(F.col("id").alias("neighbour_id"), F.col("features").alias("end"))
    # Copies of one point all have the same few neighbours: a hot key.
    segments = salted_join(
        near.join(indexed, "id"), [ends], ["neighbour_id"], ["id", "rank"], "inner"
    )
    draw_text = F.md5(F.concat_ws(":", F.col("draw").cast("string"), F.lit(f"draw:{seed}")))
    draws = (
        spark.range(n_new)
        .withColumnRenamed("id", "draw")
        .withColumn("base_index", F.col("draw") % F.lit(n_minority) + F.lit(1))
        .withColumn("rank", (small_int(draw_text, k) + F.lit(1)).cast("int"))
        .withColumn("gap", unit_interval(draw_text))
    )
    along = F.zip_with("features", "end", lambda a, b: a + F.col("gap") * (b - a))
    return draws.join(segments, ["base_index", "rank"]).select(
        "draw", F.col("id").alias("base_id"), "neighbour_id", "gap", along.alias("features")
    )


def oversample(
    df: DataFrame,
    id_col: str = "id",
    features_col: str = "features",
    label_col: str = "label",
    k: int = NEIGHBOURS,
    seed: int = 42,
    **blocks,
) -> DataFrame:
    """Fill every smaller class up to the size of the largest with synthetic points.

    Skipped while the smallest class has fewer than six rows. Added rows have a
    null id. Rows without a label are no class and stay as they are.
    """
    known = require_few_classes(df.where(F.col(label_col).isNotNull()), label_col)
    rows = known.groupBy(label_col).agg(F.count("*").alias("n")).collect()
    original = df.select(id_col, features_col, label_col).withColumn(
        features_col, F.col(features_col).cast("array<double>")
    )
    if not rows:
        return original
    largest = max(r["n"] for r in rows)
    if min(r["n"] for r in rows) < MIN_MINORITY:
        return original
    out = original
    for r in sorted(rows, key=lambda r: str(r[label_col])):
        if r["n"] == largest:
            continue
        members = df.where(F.col(label_col) == F.lit(r[label_col]))
        added = synthesize(
            members, r["n"], largest - r["n"], k, seed, id_col, features_col, **blocks
        )
        out = out.unionByName(
            added.select(
                F.lit(None).cast(df.schema[id_col].dataType).alias(id_col),
                F.col("features").alias(features_col),
                F.lit(r[label_col]).cast(df.schema[label_col].dataType).alias(label_col),
            )
        )
    return out
