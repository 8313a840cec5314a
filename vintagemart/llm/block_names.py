"""Exact duplicates by deterministic block naming.

Texts are cut into blocks of a fixed number of bytes. The distinct blocks are sorted
and numbered; from then on a block is its number. Numbers that stand side by side in a
document make a pair, the distinct pairs are sorted and numbered in turn, and so on
until each document is one number. Two documents have the same number, reached after
the same number of rounds, if and only if their texts are equal: every number stands
for one content, compared byte by byte, and never for a hash.

DataFrame operations only. Distinct blocks are found with partial aggregation, so a
block that a third of all rows hold leaves each task once. Numbers find their way back
over integers: blocks travel once, and their places look the number up under a key of
128 hash bits, after a check that no two of the distinct blocks share a key (if two
did, keys grow until none do). Rows halve from round to round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintagemart.sources.scratch import materialize

WHITE = r"[\x20\x09-\x0D]+"
# Stands for the missing right half of a pair; numbers are never negative.
NONE = -1
# Hash words of a key at first.
WORDS = 2


def normalized(text: Column) -> Column:
    """Runs of ASCII white space become one space; null becomes the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def _numbered(distinct: DataFrame, order: list[str]) -> DataFrame:
    """``order`` without its last column, which may be large, and ``name``: the task and
    the rank within it. The rows must be distinct; the result is written once."""
    ranked = distinct.sortWithinPartitions(*order)
    return ranked.withColumn("name", F.monotonically_increasing_id())


def _block_names(pieces: DataFrame, hash_bits: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """(places, names, key): places of blocks with their keys, and the number of each key."""
    words = WORDS
    while True:
        key = [f"key{i}" for i in range(words)]
        # The number of the word is the seed of its hash.
        hashes = [
            F.shiftrightunsigned(F.xxhash64(F.lit(i), "block"), 64 - hash_bits).alias(k)
            for i, k in enumerate(key)
        ]
        distinct = pieces.select(*hashes, "block").distinct()
        names = materialize(_numbered(distinct, [*key, "block"]).drop("block"), "block-names")
        if names.groupBy(*key).count().where("count > 1").isEmpty():
            break
        words += 1
    first = F.col("pos") == 0
    places = pieces.select(
        "row",
        "pos",
        "n",
        *hashes,
        F.when(first, F.col("id")).alias("id"),
        F.when(first, F.col("sha")).alias("sha"),
    )
    return materialize(places, "block-places"), names, key


def document_names(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = 1024,
    hash_bits: int = 64,
) -> DataFrame:
    """(row, id, sha, round, name): a row per document; texts are equal if and only if
    ``round`` and ``name`` are. ``row`` is unique, ``sha`` the hex SHA-256 of the
    normalised text. ``hash_bits`` per word of a key only decides how soon a key is
    widened, never the result."""
    if block_bytes < 1 or not 1 <= hash_bits <= 64:
        raise ValueError("block_bytes must be positive and hash_bits from 1 to 64")
    texts = docs.select(F.col(id_col).alias("id"), normalized(F.col(text_col)).alias("text"))
    blocks = F.expr(f"greatest(1, (octet_length(text) + {block_bytes - 1}) div {block_bytes})")
    whole = texts.select(
        F.monotonically_increasing_id().alias("row"),
        "id",
        F.sha2("text", 256).alias("sha"),
        F.col("text").cast("binary").alias("bytes"),
        blocks.cast("int").alias("n"),
    )
    places = whole.select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("pos"))
    block = F.expr(f"substring(bytes, pos * {block_bytes} + 1, {block_bytes})")
    pieces = places.select("row", "id", "sha", "n", "pos", block.alias("block"))
    level, names, key = _block_names(pieces, hash_bits)
    starts = level.where("pos = 0").select("row", "id", "sha")
    rounds = (max(level.agg(F.max("n")).first()[0] or 1, 1) - 1).bit_length()

    done = []
    for k in range(rounds + 1):
        named = level.join(names, key)
        ready = named.where("n = 1").select("row", F.lit(k).alias("round"), "name")
        done.append(ready)
        if k == rounds:
            break
        left = F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left")
        right = F.max(F.when(F.col("pos") % 2 == 1, F.col("name")))
        pairs = named.where("n > 1").groupBy("row", F.expr("pos div 2").cast("int").alias("pos"))
        level = materialize(
            pairs.agg(
                left,
                F.coalesce(right, F.lit(NONE)).alias("right"),
                F.max(F.expr("cast((n + 1) div 2 as int)")).alias("n"),
            ),
            "pairs",
        )
        key = ["left", "right"]
        names = materialize(_numbered(level.select(*key).distinct(), key), "pair-names")
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    return found.join(starts, "row").select("row", "id", "sha", "round", "name")


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = 1024,
    hash_bits: int = 64,
) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256): a row for every row of ``docs``.

    Texts are equal if they are the same after every run of ASCII white space became one
    space; null counts as empty. Of equal texts one row is kept, the one with the
    smallest id; a null id only if the group has no other, and of repeated ids the row
    read first. Texts of any length are compared whole. Other columns aren't read; an
    empty table gives an empty one.
    """
    named = materialize(document_names(docs, id_col, text_col, block_bytes, hash_bits), "named")
    name = ["round", "name"]
    # Only groups need a look-up. Hot ones are pre-aggregated here and, as both sides are
    # stored tables, split in the join.
    groups = named.groupBy(*name).agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row")).alias("keep"),
        F.count("*").alias("group_size"),
    )
    groups = materialize(groups.where("group_size > 1"), "groups")
    joined = named.join(groups, name, "left")
    alone = F.col("keep").isNull()
    return joined.select(
        "id",
        F.when(alone, F.col("id")).otherwise(F.col("keep.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("keep.row") == F.col("row"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def without_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The kept rows of ``docs``, all columns; ids must be unique and not null."""
    kept = exact_duplicates(docs, id_col, text_col).where("kept")
    return docs.join(kept.select(F.col("id").alias(id_col)), id_col, "left_semi")
