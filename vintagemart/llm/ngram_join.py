"""Exact Jaccard self-join on word shingles by filters under several token orders.

Two sets of similarity at least t must share a token among the first
``n - ceil(t n) + 1`` of either, whatever global order the tokens stand in. If
the hashes of tokens are cut into more ranges than tokens can differ, two such
sets also have the same tokens in one of the ranges. So a pair has to pass these
filters all at once:

1. one pass counts words in a sketch of fixed size, which only feeds the orders;
2. one pass turns each text into its set, a 128-bit name of the set, the names of
   its parts and one prefix per order. The first order puts shingles with the
   rarest word first, the second those with the least frequent words overall,
   tie-broken by unlike hashes. Any numbers in the sketch give valid orders, so it
   can't lose a link;
3. equal sets are one node. Nodes that share a part fall into one cell, cells are
   cut again by the prefix tokens of the first and of the second order, so a pair
   that passes every filter never gets separated, and no pairs are listed. Texts
   that share a passage only hardly ever have a part in common, so cells don't grow
   with the table through them. Below ``PARTS_FROM`` percent there are no parts;
4. what hangs together through others only is cut pair by pair: each set has marks,
   one bit per two to one tokens, that tell a lower bound of how many tokens two
   sets don't share. A task compares the marks of two bounded blocks of a cell and
   gives back a spanning forest of the pairs that may still be linked. Its trees
   are the cells that are left, hardly more than the classes themselves;
5. these are verified exactly: small ones many to a task, a large one dealt into
   blocks by set size and hash, of which a task compares two. It gives back a
   spanning forest of the links and the number of links of each node.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintagemart.llm.components import components
from vintagemart.llm.shingles import (
    WordHashes,
    list_rows,
    long_lists,
    mixed,
    shingle_hashes,
    text_bytes,
)
from vintagemart.llm.worker import per_worker, slices
from vintagemart.sources.scratch import materialize

# Slots of the word-count sketch (16 MB); its size doesn't depend on the data.
SKETCH_SLOTS = 1 << 24
# Entries (rows and what their lists hold) up to which a table of ids or hashes is
# broadcast (16 to 32 MB); others are shuffled.
BROADCAST_ROWS = 1_000_000
# Sets and tokens that one block of a large cell holds on average, and tokens of the
# small cells that share a task.
BLOCK_SETS = 512
BLOCK_TOKENS = 1 << 20
BUCKET_TOKENS = 1 << 16
# The same for blocks of marks, which take one to two bits a token.
MARK_SETS = 2048
MARK_TOKENS = 1 << 25
MARK_BUCKET_TOKENS = 1 << 21
# Percent from which on sets are cut into parts: below it, parts hold so few tokens that
# texts which share a passage often have one in common, and there are more of them.
PARTS_FROM = 85
# Ratio of the largest sets of neighbouring classes in which sets are cut into parts.
PART_CLASS = 1.4
_START = np.zeros(1, np.int64)
# Names of sets that a task remembers.
TOLD_SETS = 1 << 16
# Bits of the shortest marks.
LEAST_MARKS = 64

SET_SCHEMA = "id long, tag long, n long, node binary, marks binary, first array<long>, second array<long>, parts array<long>"
UNITS = "array<struct<bucket:long,k1:int,k2:int,i:int,j:int,side:int>>"
UNIT = ["bucket", "large", "k1", "k2", "i", "j"]


class Blocks(NamedTuple):
    """Sets and tokens of a block of a large cell, and tokens of a bucket of small ones."""

    sets: int
    tokens: int
    bucket: int


def bounded_join(left: DataFrame, right: DataFrame, on, how: str = "inner", listed: str | None = None) -> DataFrame:
    """Join with a stored right side: broadcast if it is counted to be small, with the
    entries of the list column ``listed``."""
    if listed is None:
        small = right.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    else:
        small = (right.agg(F.sum(F.size(listed) + 1)).first()[0] or 0) <= BROADCAST_ROWS
    return left.join(F.broadcast(right) if small else right, on, how)


def _slots(words: np.ndarray) -> np.ndarray:
    return (words & np.uint64(SKETCH_SLOTS - 1)).astype(np.int32)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = per_worker("word_hashes", WordHashes)
    counts = np.zeros(SKETCH_SLOTS, np.uint32)
    held: list[np.ndarray] = []
    size = 0

    def add() -> None:
        slots, more = np.unique(np.concatenate(held), return_counts=True)
        counts[slots] += more.astype(np.uint32)
        held.clear()

    for batch in slices(batches):
        for text in text_bytes(batch.column(0)):
            held.append(_slots(hashes.of(text)))
            size += len(held[-1])
            if size > 1 << 20:
                add()
                size = 0
    if held:
        add()
    used = np.flatnonzero(counts)
    for start in range(0, len(used), 1 << 16):
        part = used[start : start + (1 << 16)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(counts[part], pa.int64())], names=["slot", "n"]
        )


def word_rarity(texts: DataFrame) -> np.ndarray:
    """Half-log2 counts of all words, one byte per sketch slot."""
    rows = texts.mapInArrow(_count_words, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    rank = F.least(F.round(F.log2(F.col("n") + 1) * 2), F.lit(63)).cast("byte")
    found = rows.where("n > 1").select("slot", rank.alias("rank")).toArrow()
    ranks = np.full(SKETCH_SLOTS, 2, np.uint8)
    ranks[found.column("slot").to_numpy()] = found.column("rank").to_numpy()
    return ranks


def _distinct(values: np.ndarray) -> np.ndarray:
    """What np.unique gives, sorted several times faster than by its hash tables."""
    values = np.sort(values)
    return values[np.concatenate([values[:1] == values[:1], values[1:] != values[:-1]])]


def _ordered(words: np.ndarray, size: int, rarity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles under both orders. A token is its rank in the order
    (6 bits) followed by 58 bits of its hash."""
    tokens = shingle_hashes(words, size)
    if not len(tokens):
        return tokens, tokens
    ranks = rarity[_slots(words)]
    width = min(size, len(words))
    runs = [ranks[i : i + len(tokens)] for i in range(width)]
    rarest = np.minimum.reduce(runs).astype(np.uint64)
    overall = np.minimum(np.add.reduce(runs, dtype=np.uint32), 63).astype(np.uint64)
    low = np.uint64(6)
    first = (rarest << np.uint64(58)) | (tokens >> low)
    second = (overall << np.uint64(58)) | (mixed(tokens) >> low)
    return _distinct(first), _distinct(second)


def prefix_length(n: int, percent: int) -> int:
    """Tokens to look at; 0 for sets too small to be linked with an unequal one."""
    if 100 * n < percent * (n + 1):
        return 0
    return n - (percent * n + 99) // 100 + 1


@cache
def _size_limits() -> list[int]:
    """The largest sizes of the classes in which sets are cut into parts."""
    limits = [1]
    while limits[-1] < 1 << 40:
        limits.append(max(limits[-1] + 1, int(limits[-1] * PART_CLASS)))
    return limits


def _most_unlike(n: int, limit: int, percent: int) -> int:
    """How many tokens a set of ``n`` and a linked one of up to ``limit`` don't share at most."""
    return (n + min(limit, 100 * n // percent)) * (100 - percent) // (100 + percent)


@cache
def _part_count(at: int, percent: int) -> int:
    """Parts for the sets of a class: few, yet nearly always enough that more of them
    hold tokens than can differ."""
    limit = _size_limits()[at]
    sizes = (limit, _size_limits()[at - 1] + 1 if at else 1)
    count = _most_unlike(limit, limit, percent) + 1
    while count < 8 * limit:
        for n in sizes:
            empty = math.exp(-n / count)
            spread = math.sqrt(count * empty * (1 - empty))
            if count * (1 - empty) - 2 * spread < _most_unlike(n, limit, percent) + 1:
                break
        else:
            return count
        count += 1 + count // 64
    return count


@cache
def _class_salt(at: int) -> np.ndarray:
    return mixed(np.array([at], np.uint64))


def _parts(tokens: np.ndarray, percent: int) -> np.ndarray:
    """Names of the parts of a set, of which two linked sets have one in common.

    The parts are ranges of the hashes in the tokens, as many as suit the sizes of a class.
    Of those that hold tokens of either set, no more can differ than tokens do, so one
    of the first ones is the same. A set that hasn't more than can differ gets the name
    that all such sets of the class get. A set is cut for its own class and for those
    of larger sets it can be linked with.
    """
    n = len(tokens)
    if not prefix_length(n, percent):
        return tokens[:0]
    limits = _size_limits()
    # Without the rank; what is left is as good as random, and so are its sums.
    spread = np.sort(tokens << np.uint64(6))
    high = spread >> np.uint64(32)
    found = []
    for at in range(bisect_left(limits, n), bisect_left(limits, 100 * n // percent) + 1):
        place = (high * np.uint64(_part_count(at, percent))) >> np.uint64(32)
        starts = np.concatenate([_START, np.flatnonzero(place[1:] != place[:-1]) + 1])
        names = np.add.reduceat(spread, starts)[: _most_unlike(limits[at], limits[at], percent) + 1]
        found.append(mixed(names + _class_salt(at)))
        if len(starts) <= _most_unlike(n, limits[at], percent):
            found.append(_class_salt(at))
    return np.concatenate(found)


def _name(tokens: np.ndarray) -> bytes | None:
    """128 bits that name a set of sorted tokens."""
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else None


def _marks(tokens: np.ndarray) -> bytes | None:
    """One bit per slot, set if an odd number of tokens fall there. The slots are the
    low bits of the hash, the next power of two from the number of tokens on."""
    if not len(tokens):
        return None
    width = max(LEAST_MARKS, 1 << (len(tokens) - 1).bit_length())
    slots = (tokens & np.uint64(width - 1)).astype(np.int64)
    odd = (np.bincount(slots, minlength=width) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").tobytes()


def _prefixes(size: int, percent: int, rarity: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = per_worker("word_hashes", WordHashes)
        # Copies of a set are one node: their prefixes are told once, as far as remembered.
        told: set[bytes | None] = set()
        for batch in slices(batches):
            sizes, names, marks, firsts, seconds, parts = [], [], [], [], [], []
            for text in text_bytes(batch.column("text")):
                first, second = _ordered(hashes.of(text), size, rarity)
                kept = prefix_length(len(first), percent)
                sizes.append(len(first))
                names.append(_name(first))
                marks.append(_marks(first))
                if names[-1] in told:
                    kept = 0
                elif len(told) >= TOLD_SETS:
                    told.clear()
                told.add(names[-1])
                firsts.append(first[:kept].copy())
                seconds.append(second[:kept].copy())
                parts.append(_parts(first, percent) if kept and percent >= PARTS_FROM else first[:0])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("tag"),
                    pa.array(sizes, pa.int64()),
                    pa.array(names, pa.binary()),
                    pa.array(marks, pa.binary()),
                    long_lists(firsts),
                    long_lists(seconds),
                    long_lists(parts),
                ],
                names=["id", "tag", "n", "node", "marks", "first", "second", "parts"],
            )

    return run


def _sets(size: int, rarity: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = per_worker("word_hashes", WordHashes)
        done: set[bytes] = set()
        for batch in slices(batches):
            nodes = batch.column("node").to_pylist()
            # Rows repeated with their id stand for one node, those that share id and tag
            # with another text for none.
            fresh = []
            for i, node in enumerate(nodes):
                if node not in done:
                    done.add(node)
                    fresh.append(i)
            batch = batch.take(pa.array(fresh, pa.int64()))
            nodes = [nodes[i] for i in fresh]
            found = [_ordered(hashes.of(t), size, rarity)[0] for t in text_bytes(batch.column("text"))]
            keep = []
            for i, tokens in enumerate(found):
                if _name(tokens) == nodes[i]:
                    keep.append(i)
                else:
                    done.discard(nodes[i])
            rest = batch.select(["node", "copies", "cell", "units"]).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, long_lists([found[i] for i in keep])],
                names=["node", "copies", "cell", "units", "tokens"],
            )

    return run


def _size_class(percent: int):
    """Linked sets lie in the same class or in neighbouring ones."""
    return F.floor(F.log(F.col("n").cast("double")) / float(np.log(100.0 / (percent - 1)))).cast("int")


def _cells(prefixes: DataFrame) -> DataFrame:
    """(key, cell): nodes that share a token, directly or through others.

    ``prefixes`` is (key, token). Every node is hooked to the smallest one of each of
    its tokens. The rows meet by token once and nothing else of them moves, as they
    are what the join shuffles most; those of one token are read twice in their task
    and go to its disk if they are many.
    """
    low = F.min("key").over(Window.partitionBy("token"))
    hooked = prefixes.select("key", "token").withColumn("low", low).where("key != low")
    edges = hooked.select(F.col("key").alias("u"), F.col("low").alias("v"))
    return components(edges).select(F.col("node").alias("key"), F.col("root").alias("cell"))


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two bounded lists of sets."""
    lengths = [len(s) for s in left]
    tokens, at = np.unique(np.concatenate(left), return_inverse=True)
    rows = np.repeat(np.arange(len(left)), lengths)
    other = np.concatenate(right)
    columns = np.repeat(np.arange(len(right)), [len(s) for s in right])
    place = np.searchsorted(tokens, other).clip(0, len(tokens) - 1)
    common = tokens[place] == other
    place, columns = place[common], columns[common]
    # Only tokens on both sides count; the rest would be columns of zeros.
    seen, place = np.unique(place, return_inverse=True)
    new = np.full(len(tokens), -1)
    new[seen] = np.arange(len(seen))
    at = new[at]
    rows, at = rows[at >= 0], at[at >= 0]
    total = np.zeros((len(left), len(right)), np.float32)
    by_left, by_right = np.argsort(at, kind="stable"), np.argsort(place, kind="stable")
    rows, at, columns, place = rows[by_left], at[by_left], columns[by_right], place[by_right]
    step = 4096
    for start in range(0, len(seen), step):
        a, b = np.searchsorted(at, (start, start + step))
        c, d = np.searchsorted(place, (start, start + step))
        one = np.zeros((len(left), step), np.float32)
        two = np.zeros((len(right), step), np.float32)
        one[rows[a:b], at[a:b] - start] = 1
        two[columns[c:d], place[c:d] - start] = 1
        total += one @ two.T
    return total.astype(np.int64)


def _forest(links: np.ndarray) -> np.ndarray:
    """For a symmetric link matrix, the smallest index that each one can reach."""
    root = np.arange(len(links))
    while True:
        best = np.where(links, root[None, :], len(links)).min(axis=1, initial=len(links))
        new = np.minimum(root, best)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _verified(
    nodes: list, sets: list, copies: np.ndarray, side: np.ndarray, alone: bool, percent: int
) -> tuple:
    """Node, smallest node reached and number of linked rows, for one block pair, or
    for a block that is compared with itself. Blocks may be empty."""
    _, first = np.unique(np.array(nodes, object), return_index=True)
    nodes, sets = [nodes[i] for i in first], [sets[i] for i in first]
    copies, side = copies[first], side[first]
    one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if alone:
        two = one
    if not len(one) or not len(two) or len(nodes) < 2:
        return [], [], []
    sizes = np.array([len(s) for s in sets])
    common = _overlaps([sets[i] for i in one], [sets[i] for i in two])
    union = sizes[one][:, None] + sizes[two][None, :] - common
    linked = np.zeros((len(nodes), len(nodes)), bool)
    linked[np.ix_(one, two)] = 100 * common >= percent * union
    linked |= linked.T
    np.fill_diagonal(linked, False)
    root = _forest(linked)
    links = linked @ copies
    keep = np.flatnonzero(links)
    return [nodes[i] for i in keep], [nodes[root[i]] for i in keep], links[keep].tolist()


def _verify(percent: int) -> Callable[[pa.Table], pa.Table]:
    def run(block: pa.Table) -> pa.Table:
        nodes = np.array(block.column("node").to_pylist(), object)
        sets = list(list_rows(block.column("tokens").combine_chunks()))
        copies = block.column("copies").to_numpy()
        side = block.column("side").to_numpy()
        cell = block.column("cell").to_numpy()
        k1, k2, i, j = (block.column(c)[0].as_py() for c in ("k1", "k2", "i", "j"))
        alone = k1 == k2 and i == j
        order = np.argsort(cell, kind="stable")
        found: tuple[list, list, list] = ([], [], [])
        for rows in np.split(order, np.flatnonzero(np.diff(cell[order])) + 1):
            own = [sets[r] for r in rows]
            got = _verified(nodes[rows].tolist(), own, copies[rows], side[rows], alone, percent)
            for all_rows, new in zip(found, got):
                all_rows += new
        return pa.table(
            [pa.array(found[0], pa.binary()), pa.array(found[1], pa.binary()), pa.array(found[2], pa.int64())],
            names=["u", "v", "links"],
        )

    return run


def _unlike(marks: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Slots in which one row of marks differs from each row of ``other``."""
    return np.bitwise_count(other ^ marks).sum(axis=1, dtype=np.int64)


def _folded(marks: np.ndarray) -> np.ndarray:
    """The marks for half the slots."""
    half = marks.shape[1] // 2
    return marks[:, :half] ^ marks[:, half:]


def _near(sizes: np.ndarray, marks: list[bytes], side: np.ndarray, alone: bool, percent: int) -> np.ndarray:
    """The matrix of pairs of both sides that may be linked.

    Linked sets differ in at most ``(100 - percent) / (100 + percent)`` of the sum of
    their sizes, and every slot that differs takes a token that differs. Sets whose
    marks have four times the slots have more than twice the tokens.
    """
    near = np.zeros((len(sizes), len(sizes)), bool)
    lengths = np.array([len(m) for m in marks])
    for width in np.unique(lengths):
        here = np.flatnonzero(lengths == width)
        same = np.frombuffer(b"".join(marks[i] for i in here), np.uint64).reshape(len(here), -1)
        twice = np.flatnonzero(lengths == 2 * width)
        if len(twice):
            wide = np.frombuffer(b"".join(marks[i] for i in twice), np.uint64).reshape(len(twice), -1)
            same = np.concatenate([same, _folded(wide)])
        rows = np.concatenate([here, twice])
        order = np.argsort(sizes[rows], kind="stable")
        rows, same = rows[order], same[order]
        held = sizes[rows]
        # Each set against those that are as large or larger, up to the last that can be linked.
        ends = np.searchsorted(held, held * 100 // percent, side="right")
        for at, row in enumerate(rows):
            other = rows[at + 1 : ends[at]]
            if not len(other):
                continue
            fits = np.ones(len(other), bool) if alone else side[other] != side[row]
            fits &= (lengths[other] == width) | (lengths[row] == width)
            picked = np.flatnonzero(fits)
            if len(picked):
                differ = _unlike(same[at], same[at + 1 + picked])
                most = (sizes[other[picked]] + sizes[row]) * (100 - percent)
                near[row, other[picked[differ * (100 + percent) <= most]]] = True
    return near | near.T


def _compare_marks(percent: int) -> Callable[[pa.Table], pa.Table]:
    def run(block: pa.Table) -> pa.Table:
        key, n, side, cell = (block.column(c).to_numpy() for c in ("key", "n", "side", "cell"))
        marks = block.column("marks").to_pylist()
        k1, k2, i, j = (block.column(c)[0].as_py() for c in ("k1", "k2", "i", "j"))
        alone = k1 == k2 and i == j
        order = np.argsort(cell, kind="stable")
        us, vs = [], []
        for rows in np.split(order, np.flatnonzero(np.diff(cell[order])) + 1):
            near = _near(n[rows], [marks[r] for r in rows], side[rows], alone, percent)
            root = _forest(near)
            kept = np.flatnonzero(near.any(axis=1))
            us.append(key[rows[kept]])
            vs.append(key[rows[root[kept]]])
        return pa.table([np.concatenate(us), np.concatenate(vs)], names=["u", "v"])

    return run


def _near_cells(members: DataFrame, percent: int) -> DataFrame:
    """(key, cell): members of one cell whose marks are close enough for a link,
    directly or through others; those that are close to none are left out."""
    units = _units(members, percent, Blocks(MARK_SETS, MARK_TOKENS, MARK_BUCKET_TOKENS))
    large = F.when(F.col("unit.bucket") == 0, F.col("cell")).alias("large")
    units = units.withColumn("unit", F.explode("units")).select("key", "n", "marks", "cell", large, "unit.*")
    near = units.groupBy(*UNIT).applyInArrow(_compare_marks(percent), "u long, v long")
    near = materialize(near.where("u != v"), "near")
    return components(near).select(F.col("node").alias("key"), F.col("root").alias("cell"))


def _units(members: DataFrame, percent: int, blocks: Blocks) -> DataFrame:
    """``members`` with the list of block pairs that each one takes part in.

    A small cell is one unit, and many of them share a task (``bucket``). A large
    one is dealt into blocks by size class and hash; all pairs of blocks of one
    class and of neighbouring classes are units of their own.
    """
    whole = members.groupBy("cell").agg(F.count("*").alias("rows"), F.sum("n").alias("tokens"))
    fits = (F.col("rows") <= blocks.sets) & (F.col("tokens") <= blocks.tokens)
    whole = materialize(whole.where("rows > 1").select("*", fits.alias("fits")), "wholes")
    held = whole.where("fits").agg(F.sum("tokens")).first()[0] or 0
    buckets = F.lit(-(-held // blocks.bucket) or 1)
    members = members.join(whole.select("cell", "fits"), "cell")
    alone = F.struct(F.pmod(F.xxhash64("cell"), buckets) + 1, *[F.lit(0)] * 5)
    small = members.where("fits").withColumn("units", F.array(alone).cast(UNITS)).drop("fits")

    large = members.where("not fits").withColumn("class", _size_class(percent))
    counts = large.groupBy("cell", "class").agg(F.count("*").alias("rows"), F.sum("n").alias("tokens"))
    parts = F.greatest(F.ceil(F.col("rows") / blocks.sets), F.ceil(F.col("tokens") / blocks.tokens))
    counts = materialize(counts.select("cell", "class", parts.cast("int").alias("parts")), "blocks")
    below = counts.select("cell", (F.col("class") + 1).alias("class"), F.col("parts").alias("below"))
    above = counts.select("cell", (F.col("class") - 1).alias("class"), F.col("parts").alias("above"))
    counts = counts.join(below, ["cell", "class"], "left").join(above, ["cell", "class"], "left")
    large = large.join(counts.fillna(0), ["cell", "class"]).withColumn(
        "part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")
    )
    pair = "named_struct('bucket', 0L, 'k1', {}, 'k2', {}, 'i', {}, 'j', {}, 'side', {})"
    # sequence(0, n) has one number more than there are blocks.
    pairs = f"""concat(
        transform(sequence(part, parts - 1), x -> {pair.format("class", "class", "part", "x", 0)}),
        transform(slice(sequence(0, part), 1, part), x -> {pair.format("class", "class", "x", "part", 1)}),
        transform(slice(sequence(0, above), 1, above), x -> {pair.format("class", "class + 1", "part", "x", 0)}),
        transform(slice(sequence(0, below), 1, below), x -> {pair.format("class - 1", "class", "x", "part", 1)}))"""
    large = large.withColumn("units", F.expr(pairs).cast(UNITS)).select(*small.columns)
    return small.unionByName(large)


def _classes(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """(id, tag, n, label, component, links) per row; ``tag`` is a hash of the text
    and ``label`` names the class, null if the set is empty."""
    if not 50 <= percent <= 99:
        raise ValueError("percent must lie between 50 and 99; equal sets need no join")
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("tag"), text.alias("text"))
    rarity = word_rarity(rows.select("text"))
    named = materialize(rows.mapInArrow(_prefixes(size, percent, rarity), SET_SCHEMA), "prefixes")

    key = F.xxhash64("node").alias("key")
    told = named.where("n > 0").withColumn("key", key)
    filters = ["parts", "first", "second"] if percent >= PARTS_FROM else ["first", "second"]
    cells = materialize(_cells(told.select("key", F.explode(filters[0]).alias("token"))), "cells")
    for name in filters[1:]:
        held = bounded_join(told, cells, "key").select("cell", "key", F.explode(name).alias("token"))
        # Two cells that meet in a hash would only be one.
        cells = materialize(_cells(held.select("key", F.xxhash64("cell", "token").alias("token"))), "cells")

    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "tag")).alias("least")
    known = named.where("n > 0").groupBy("node", "n").agg(
        F.count("*").alias("copies"), least, F.first("marks").alias("marks")
    )
    known = materialize(known.select("node", "n", "copies", "least.id", "least.tag", "marks", key), "nodes")
    members = bounded_join(known.select("key", "n", "marks"), cells, "key")
    cells = materialize(_near_cells(materialize(members, "members"), percent), "near-cells")
    known = known.drop("marks")
    members = materialize(bounded_join(known, cells, "key"), "members")
    chosen = _units(members, percent, Blocks(BLOCK_SETS, BLOCK_TOKENS, BUCKET_TOKENS))
    chosen = chosen.withColumnsRenamed({"id": "chosen_id", "tag": "chosen_tag"})
    same = rows["id"].eqNullSafe(F.col("chosen_id")) & (rows["tag"] == F.col("chosen_tag"))
    texts = bounded_join(rows, materialize(chosen, "chosen"), same, listed="units")
    sets = texts.select("text", "node", "copies", "cell", "units").mapInArrow(
        _sets(size, rarity), f"node binary, copies long, cell long, units {UNITS}, tokens array<long>"
    )
    large = F.when(F.col("unit.bucket") == 0, F.col("cell"))
    sets = sets.withColumn("unit", F.explode("units")).select(
        "node", "copies", "cell", "tokens", large.alias("large"), "unit.*"
    )
    links = sets.groupBy(*UNIT).applyInArrow(
        _verify(percent), "u binary, v binary, links long"
    )
    links = materialize(links, "links")

    roots = components(links.select("u", "v")).withColumnRenamed("root", "label")
    degrees = links.groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("links"))
    groups = known.select("node", "copies", "id").join(roots, "node", "left").join(degrees, "node", "left")
    groups = groups.select(
        "node",
        F.coalesce("label", "node").alias("label"),
        "id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
    )
    groups = materialize(groups, "groups")
    lowest = groups.groupBy("label").agg(F.min("id").alias("component"))
    found = groups.join(lowest, "label").select("node", "label", "component", "links")
    return named.join(found, "node", "left").select(
        "id",
        "tag",
        "n",
        "label",
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component"),
        F.coalesce("links", F.lit(0)).alias("links"),
    )


def jaccard_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    percent: int = 80,
) -> DataFrame:
    """(id, n_shingles, component, links) for every row of ``docs``.

    Rows are linked when ``100 * |intersection| >= percent * |union|`` of their
    shingle sets; ``component`` is the smallest id reachable over links and
    ``links`` the number of other rows a row is linked with.

    Null and empty texts have an empty set, no link and their own id. A row with a
    null id is linked like any other, but can't name a component, so a component
    of null ids alone is null. Repeated rows are copies of each other; rows of one
    id with unlike texts are linked each on its own. Other columns aren't read.
    """
    found = _classes(docs, id_col, text_col, size, percent)
    return found.select("id", F.col("n").alias("n_shingles"), "component", "links")


def one_per_class(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    percent: int = 80,
) -> DataFrame:
    """``docs`` with the row of the smallest id of every class of ``jaccard_classes``,
    and the rows with an empty set, which are in no class.

    Null ids come last; rows of one id go by a hash of the text, and of rows with the
    same id and text one stays. All columns stay, whatever they are called.
    """
    found = materialize(_classes(docs, id_col, text_col, size, percent), "classes")
    named = found.where("label is not null")
    best = named.groupBy("label").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "tag")).alias("best"))
    kept = best.select("best.id", "best.tag").unionAll(found.where("label is null").select("id", "tag").distinct())
    kept = materialize(kept.toDF("kept_id", "kept_tag"), "kept")
    names = [f"c{i}" for i in range(len(docs.columns))]
    row_id, text = names[docs.columns.index(id_col)], names[docs.columns.index(text_col)]
    rows = docs.toDF(*names)
    same = F.col(row_id).cast("long").eqNullSafe(F.col("kept_id")) & (F.xxhash64(text) == F.col("kept_tag"))
    rows = bounded_join(rows, kept, same, "left_semi")
    repeated = named.groupBy("id", "tag").agg(F.count("*").alias("times")).where("times > 1")
    repeated = materialize(repeated.toDF("kept_id", "kept_tag", "times"), "repeated")
    if not repeated.isEmpty():
        once = bounded_join(rows, repeated, same, "left_anti")
        rows = once.unionAll(bounded_join(rows, repeated, same, "left_semi").dropDuplicates([row_id, text]))
    return rows.toDF(*docs.columns)
