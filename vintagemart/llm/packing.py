"""Best-fit packing of tokenized documents into sequences of fixed capacity.

Documents become pieces of at most ``capacity`` tokens, and pieces are packed by
best fit in rounds, the longest pieces first. A round takes all pieces of one length
and all gaps at once: both stand sorted by size, every piece looks for its successor
among the gaps (the smallest one that holds it), pieces that want the same gaps are
told apart by their ranks, the gaps shrink, and the sweep goes on until the round
has no piece left or no gap that holds one; the rest open new sequences.

Lengths are whole numbers up to ``capacity``, so the sorted order of pieces and gaps
is a table of classes with counts, and gaps of one class that came about together
are a range of sequence numbers. A round therefore moves ranges, however many rows
they stand for: the plan has a size that depends on ``capacity`` and not on the
data. Rows are touched by three distributed passes: one tokenizes, counts per
partition give every piece its rank among those of its length, and one sweep looks
rank and length up in the plan. The result is that of sequential best fit decreasing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain, compress, repeat
from operator import is_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintagemart.llm.ngram_join import bounded_join
from vintagemart.llm.shingles import text_bytes
from vintagemart.llm.worker import per_worker, small_batches
from vintagemart.sources.scratch import materialize

# Word forms remembered per worker before the memory starts anew.
REMEMBERED_FORMS = 1_000_000
# Marks that may follow a word; the apostrophe isn't one, as it may begin an ending.
MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
LAST_LATIN = "\u024f"
# Bytes of ids that a task hands over at once.
HANDED_OVER = 4 << 20


class TokenIds(dict):
    """Lower-case word form -> its ids as packed little-endian 32-bit numbers.

    The tokenizer lower-cases, drops white space and never joins across it, so a text
    is the sum of its forms. A text with a control string goes to the tokenizer whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # The same model without the steps that change nothing in plain letters.
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def packed(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _learn_words(self, forms: list[bytes], text: str) -> None:
        """Forms of letters alone, in lower case in one text: each goes up to the next
        id that ends a word."""
        ids = np.array(self.plain.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        ends = 4 * (np.flatnonzero(self.ends_word[ids]) + 1)
        data, start = ids.tobytes(), 0
        for form, end in zip(forms, ends.tolist(), strict=True):
            self[form] = data[start:end]
            start = end

    def learn(self, forms: set[bytes]) -> None:
        stems, marked = set(), []
        for form in forms:
            stem = form.rstrip(MARKS)
            if len(stem) == len(form):
                stems.add(form)
            # Marks after a letter or digit are a token of their own; a capital may become
            # a letter and a mark that isn't one.
            elif stem and (97 <= stem[-1] <= 122 or stem.decode().lower()[-1].isalnum()):
                marked.append((form, stem))
                stems.add(stem)
            else:
                self[form] = self.packed(form.decode())
        plain, latin, lower = [], [], []
        # Looked up one by one: ``stems.difference(self)`` walks through all of the memory.
        for stem in stems:
            if stem in self:
                continue
            if stem.isalpha():
                plain.append(stem)
                continue
            text = stem.decode()
            # Latin letters have one lower-case letter each, and are composed already.
            if text.isalpha() and max(text) <= LAST_LATIN and len(text) == len(low := text.lower()):
                latin.append(stem)
                lower.append(low)
            else:
                self[stem] = self.packed(text)
        for start in range(0, len(plain), 512):
            part = plain[start : start + 512]
            self._learn_words(part, b" ".join(part).decode())
        for start in range(0, len(latin), 512):
            self._learn_words(latin[start : start + 512], " ".join(lower[start : start + 512]))
        for form, stem in marked:
            marks = form[len(stem) :]
            if marks not in self:
                self[marks] = self.packed(marks.decode())
            self[form] = self[stem] + self[marks]

    def of(self, texts: list[bytes | None]) -> Iterator[bytes]:
        """The ids of each text; null counts as empty."""
        for start in range(0, len(texts), 256):
            part = [t or b"" for t in texts[start : start + 256]]
            if len(self) > REMEMBERED_FORMS:
                self.clear()
            forms = [[] if b"<|" in t else t.lower().split() for t in part]
            found = [list(map(self.get, words)) for words in forms]
            gaps = [(words, ids) for words, ids in zip(forms, found) if None in ids]
            if gaps:
                self.learn(set(chain.from_iterable(compress(w, map(is_, i, repeat(None))) for w, i in gaps)))
            for words, ids in gaps:
                at = -1
                for _ in range(ids.count(None)):
                    at = ids.index(None, at + 1)
                    ids[at] = self[words[at]]
            for text, ids in zip(part, found):
                yield self.packed(text.decode()) if b"<|" in text else b"".join(ids)


def _pieces(path: str, capacity: int, end_id: int | None) -> Callable:
    width = 4 * capacity
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = per_worker(f"token_ids:{path}", lambda: TokenIds(path))
        context = TaskContext.get()
        part = context.partitionId() if context else 0
        met = np.zeros(capacity + 1, np.int64)

        def rows(held: list, ids: pa.Array) -> pa.RecordBatch:
            at, piece, start, packed, rank = zip(*held)
            length = np.array([len(p) // 4 for p in packed], np.int32)
            return pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(at, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int32()),
                    pa.array(packed, pa.binary()),
                    pa.array(np.full(len(at), part), pa.int64()),
                    pa.array(rank, pa.int64()),
                ],
                names=["id", "piece", "start", "length", "ids", "part", "rank"],
            )

        for batch in batches:
            held, size = [], 0
            slices = (batch.column(1).slice(start, 256) for start in range(0, len(batch), 256))
            texts = chain.from_iterable(tokens.of(text_bytes(s)) for s in slices)
            for at, packed in enumerate(texts):
                packed += end
                for piece, start in enumerate(range(0, len(packed), width)):
                    cut = packed[start : start + width]
                    held.append((at, piece, start // 4, cut, int(met[len(cut) // 4])))
                    met[len(cut) // 4] += 1
                    size += len(cut)
                if size > HANDED_OVER:
                    yield rows(held, batch.column(0))
                    held, size = [], 0
            if held:
                yield rows(held, batch.column(0))

    return run


class Plan:
    """Where the pieces of each length go: ascending first ranks, and for the range
    that starts there the first sequence and the offset within the sequences."""

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.capacity = capacity
        self.sequences = 0
        self.ranges: dict[int, list[tuple[int, int, int]]] = {}
        # Gap size -> ranges of sequences; the bits of ``sizes`` say which exist.
        self._gaps: dict[int, list[tuple[int, int]]] = {}
        self._sizes = 0
        for length in sorted(counts, reverse=True):
            self._round(length, counts[length])
        self.lookup = {k: tuple(np.array(v, np.int64).T) for k, v in self.ranges.items()}
        del self.ranges, self._gaps

    def _add_gaps(self, size: int, first: int, count: int) -> None:
        if size and count:
            self._gaps.setdefault(size, []).append((first, count))
            self._sizes |= 1 << size

    def _round(self, length: int, count: int) -> None:
        placed, out = 0, self.ranges.setdefault(length, [])
        while placed < count:
            above = self._sizes >> length
            if above:
                size = length + (above & -above).bit_length() - 1
                first, there = self._gaps[size].pop()
                if not self._gaps[size]:
                    self._sizes &= ~(1 << size)
            else:
                size, first = self.capacity, self.sequences
                # As many new sequences as these pieces fill, each several times.
                there = -(-(count - placed) // (self.capacity // length))
                self.sequences += there
            taken = min(there, count - placed)
            out.append((placed, first, self.capacity - size))
            placed += taken
            self._add_gaps(size, first + taken, there - taken)
            self._add_gaps(size - length, first, taken)

    def places(self, length: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """``sequence * capacity + offset`` of each piece."""
        out = np.zeros(len(length), np.int64)
        for size in np.unique(length):
            rows = length == size
            starts, firsts, offsets = self.lookup[int(size)]
            at = np.searchsorted(starts, rank[rows], "right") - 1
            out[rows] = (firsts[at] + rank[rows] - starts[at]) * self.capacity + offsets[at]
        return out


def tokenized_pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int,
    end_id: int | None = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, piece, start, length, ids, part, rank): the pieces of each document, and
    their rank among the pieces of the same length in the same task."""
    schema = T.StructType(
        [
            T.StructField("id", docs.schema[id_col].dataType),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.IntegerType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("part", T.LongType()),
            T.StructField("rank", T.LongType()),
        ]
    )
    return docs.select(id_col, text_col).mapInArrow(_pieces(tokenizer, capacity, end_id), schema)


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    end_id: int | None = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """A row per piece: (id, piece, start, length, ids, sequence_id, offset).

    ``ids`` are packed little-endian unsigned 32-bit numbers. Only documents longer
    than ``capacity`` are cut, into pieces of that size, the last of which may be
    shorter. Sequences are filled from offset 0 without gaps.

    A null or empty text is the end token alone, or gives no row without one. Null
    and repeated ids are kept, a row of pieces for every row of ``docs``; which of
    several equally long pieces goes where is open. Other columns aren't read; an
    empty table gives an empty one.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    with small_batches(docs.sparkSession):
        pieces = materialize(
            tokenized_pieces(docs, tokenizer, capacity, end_id, id_col, text_col), "pieces"
        )
    counts = materialize(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "counts")
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = Plan(totals, capacity)
    # At most one row per task in each window.
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier")
    earlier = materialize(counts.select("length", "part", earlier), "earlier")

    @F.pandas_udf("long")
    def place(length: pd.Series, rank: pd.Series) -> pd.Series:
        return pd.Series(plan.places(length.to_numpy(), rank.to_numpy()))

    ranked = bounded_join(pieces, earlier, ["length", "part"])
    placed = ranked.withColumn("place", place("length", F.col("rank") + F.col("earlier")))
    return placed.select(
        "id",
        "piece",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids",
        F.expr(f"place div {capacity}").alias("sequence_id"),
        F.pmod("place", F.lit(capacity)).alias("offset"),
    )
