"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagemart.sources.scratch import materialize


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns ``u`` and ``v``, any one
    orderable type); ``root`` is the smallest node of the component.

    Alternating large and small stars: every node is hooked to its smallest
    neighbour until only stars remain. The number of rounds is logarithmic in
    practice, a round is two aggregations with map-side combining and two joins
    that adaptive execution splits at hot nodes, and no round makes more rows
    than there are edges. Null ends and loops are no edges.
    """
    now = (
        edges.where("u != v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    now = materialize(now, "edges")
    state = _state(now)
    while state[0]:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.where("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        large = large.where("u != v").distinct()
        large = materialize(large, "large")
        parents = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(parents, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionAll(parents.withColumnRenamed("m", "v")).distinct()
        now = materialize(small, "small")
        last, state = state, _state(now)
        if state == last:
            break
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)
