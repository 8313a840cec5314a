"""Benchmark items inside documents: MinHash containment search, verified exactly.

An item leaks into a document if at least ``percent`` of the item's distinct word
shingles occur in the document. Jaccard similarity says nothing here, since the
document may be a thousand times longer, so the search asks for the item's MinHash
values in the document's shingles, which is blind to the document's length.

Items are partitioned by set size, in powers of two. All items of a partition keep
the bottom-k MinHash sketch that its largest size calls for: with at most ``m``
shingles missing, ``m + 1`` of them can't all be missing. An item of ``n`` shingles
in a partition with ``k`` values is a candidate when at least ``k - m`` of them are
met, so no leak is lost, and the exact containment of candidates follows.

The sketches go to the tasks in blocks of bounded size, and documents are only
mapped: no shuffle, and no task holds more than one block and one batch of texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintagemart.llm.shingles import WordHashes, shingle_hashes
from vintagemart.llm.worker import per_worker, slices

# Characters of item texts that one block holds on average.
BLOCK_CHARS = 16_000_000
# Bits of the table that answers most lookups at once.
TABLE_BITS = 20

# ASCII letters fold to lower case; ASCII characters other than letters and digits
# separate words, all bytes above 127 belong to words.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def plain_words(text: str | bytes | None) -> bytes:
    """Lower-case words with single separators where ASCII punctuation was."""
    if text is None:
        return b""
    return (text.encode() if isinstance(text, str) else text).translate(_FOLD)


class ItemIndex:
    """Sketches and exact sets of one block of items, by size partition."""

    def __init__(self, texts: list[str | None], size: int, percent: int) -> None:
        hashes = WordHashes()
        sets = [np.unique(shingle_hashes(hashes.of(plain_words(t)), size)) for t in texts]
        self.size, self.percent = size, percent
        self.lengths = np.array([len(s) for s in sets], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self.tokens = np.concatenate([*sets, np.empty(0, np.uint64)])
        missing = self.lengths - self._least(self.lengths)
        top = 2 ** np.ceil(np.log2(np.maximum(self.lengths, 1))).astype(np.int64)
        sketch = np.minimum(top - self._least(top) + 1, self.lengths)
        self.needed = sketch - missing
        # Sorted sets start with their bottom-k values: the hashes are uniform.
        values = [s[:k] for s, k in zip(sets, sketch)]
        owners = np.repeat(np.arange(len(sets)), sketch) if sets else np.empty(0, np.int64)
        flat = np.concatenate([*values, np.empty(0, np.uint64)])
        order = np.argsort(flat, kind="stable")
        self.values, self.owners = flat[order], owners[order]
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[self.values & np.uint64((1 << TABLE_BITS) - 1)] = True

    def _least(self, n: np.ndarray) -> np.ndarray:
        return (self.percent * n + 99) // 100

    def search(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Items that leak into a document, and how many of their shingles it has."""
        none = np.empty(0, np.int64)
        probable = shingles[self.table[shingles & np.uint64((1 << TABLE_BITS) - 1)]]
        if not len(probable):
            return none, none
        probable = np.unique(probable)
        low = np.searchsorted(self.values, probable, "left")
        met = np.searchsorted(self.values, probable, "right") - low
        if not met.any():
            return none, none
        # One place in the sorted sketch values per met value and owner.
        first = np.repeat(low - np.concatenate([[0], np.cumsum(met)[:-1]]), met)
        owners, hits = np.unique(self.owners[first + np.arange(met.sum())], return_counts=True)
        owners = owners[hits >= self.needed[owners]]
        if not len(owners):
            return none, none
        there = np.unique(shingles)
        shared = []
        for item in owners:
            own = self.tokens[self.starts[item] : self.starts[item + 1]]
            place = np.searchsorted(there, own).clip(0, len(there) - 1)
            shared.append(int((there[place] == own).sum()))
        found = np.array(shared, np.int64)
        leaked = 100 * found >= self.percent * self.lengths[owners]
        return owners[leaked], found[leaked]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> Iterator[tuple]:
    """(item ids, index) of bounded blocks that together hold every item."""
    chars = benchmark.agg(F.sum(F.length(text_col))).first()[0] or 0
    parts = -(-chars // BLOCK_CHARS) or 1
    block = F.pmod(F.xxhash64(id_col, text_col), F.lit(parts))
    for part in range(parts):
        rows = benchmark.where(block == part).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        found = rows.toArrow()
        yield found.column("id").combine_chunks(), ItemIndex(found.column("text").to_pylist(), size, percent)


def _document_shingles(index: ItemIndex, column: pa.Array, hashes: WordHashes) -> Iterator[np.ndarray]:
    for text in column.cast(pa.binary()).to_pylist():
        yield shingle_hashes(hashes.of(plain_words(text)), index.size)


def _pairs(item_ids: pa.Array, index: ItemIndex) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = per_worker("word_hashes", WordHashes)
        for batch in slices(batches):
            rows, items, counts = [], [], []
            for at, shingles in enumerate(_document_shingles(index, batch.column(1), hashes)):
                found, shared = index.search(shingles)
                rows += [at] * len(found)
                items += found.tolist()
                counts += shared.tolist()
            total = index.lengths[items] if items else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    item_ids.take(pa.array(items, pa.int64())),
                    pa.array(total, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(np.array(counts, np.int64) / np.maximum(total, 1), pa.float64()),
                ],
                names=["doc_id", "item_id", "n_shingles", "n_shared", "containment"],
            )

    return run


def _clean(index: ItemIndex, text_at: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = per_worker("word_hashes", WordHashes)
        for batch in slices(batches):
            keep = [
                not len(index.search(shingles)[0])
                for shingles in _document_shingles(index, batch.column(text_at), hashes)
            ]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return run


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    size: int = 5,
    percent: int = 80,
) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared, containment), a row for every document
    row and item row with ``100 * n_shared >= percent * n_shingles``.

    Null and empty texts, and texts without a word, have no shingles: such items and
    documents match nothing. A text of fewer than ``size`` words is one shingle of
    all its words, so a shorter item is met by documents that say just the same.
    Null ids are given back as they are; repeated rows match each on its own. Empty
    tables give no rows; other columns aren't read.
    """
    rows = docs.select(F.col(id_col), F.col(text_col))
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[id_col].dataType),
            T.StructField("item_id", benchmark.schema[item_col].dataType),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("n_shared", T.LongType()),
            T.StructField("containment", T.DoubleType()),
        ]
    )
    found = [
        rows.mapInArrow(_pairs(ids, index), schema)
        for ids, index in _blocks(benchmark, item_col, item_text_col, size, percent)
    ]
    return reduce(DataFrame.unionAll, found)


def without_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    size: int = 5,
    percent: int = 80,
) -> DataFrame:
    """The rows of ``docs``, with all their columns, into which no item leaks; see
    ``leaks`` for what that means for null, empty and short texts."""
    at = docs.columns.index(text_col)
    for _, index in _blocks(benchmark, item_col, item_text_col, size, percent):
        docs = docs.mapInArrow(_clean(index, at), docs.schema)
    return docs
