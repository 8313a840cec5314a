"""Document scores by masked pseudo-likelihood.

A network predicts every word from the two words on either side of it: one table of
vectors per place of the window, summed, squashed, and followed by two softmax steps,
first over classes of words and then over the words of the class. The score of a
document is the sum of the log-probabilities of all its words.

The vocabulary comes from the counts of all words of all documents. Words beyond it
have one id per length and shape for the network; the log-probability of the word
within its shape follows from the counts of all words: ``n / (N + T)`` for a word met
``n`` times, ``T / (N + T)`` for any word not met, with the ``N`` occurrences and ``T``
words of the shape. Training runs in rounds over all
documents: tasks train copies of the network on bounded shards, and the copies are
averaged block by block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import blake2b
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintagemart.llm.shingles import long_lists
from vintagemart.llm.worker import per_worker, slices
from vintagemart.sources.scratch import materialize

CLASSES = 48
WORDS = CLASSES * CLASSES
PAD = WORDS
WINDOW = (-2, -1, 1, 2)
WIDTH = 32
SHARD_WORDS = 400_000
# Shards whose copies one task adds up, and sums that one task adds up again.
BUNDLE = 4
FAN_IN = 64
ROUNDS = 2
BATCH = 2048
RATE = 0.1
# Positions put in order for scoring, and scored at once; numbers in one block of the averaging.
STRETCH = 1 << 16
PRODUCT = 2048
BLOCK = 4096
# Most frequent words beyond the vocabulary whose counts go to all tasks; those of the
# others are joined.
KNOWN = 1 << 17
SHAPE = 63
# Of each byte: whether it is a mark or a digit, and in the upper half whether it is a digit.
MARKS = np.zeros(256, np.int64)
MARKS[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = 1
MARKS[list(b"0123456789")] = 1 + (1 << 32)
# Marks that end a sentence or a part of it.
ENDS = np.isin(np.arange(256), list(b".,;:!?"))
# Bytes of text that are split into words at once.
PORTION = 1 << 23
# Words remembered per worker before the memory starts anew.
REMEMBERED = 1 << 20
# Powers of e up to this, and sums of them, are far from the ends of single precision.
TAME = 60
ONES = np.ones(CLASSES, np.float32)
# Rows of an id that are added up one by one.
FEW = 4


def _shapes(words: list[bytes]) -> np.ndarray:
    """Of each word the length, up to 12, and whether it has letters only, a mark behind
    them, digits, or other marks."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths)
    letters = np.frombuffer(b"".join(words), np.uint8)
    found = np.add.reduceat(MARKS[letters], ends - lengths)
    kinds = np.where(found >> 32, 2, 3)
    kinds[(found & 0xFFFFFFFF == 1) & ENDS[letters[ends - 1]]] = 1
    kinds[found == 0] = 0
    return (12 * kinds + np.minimum(lengths, 12) - 1).astype(np.uint64)


def word_keys(words: list[bytes]) -> np.ndarray:
    """58 bits of the hash of each lower-case word, followed by its shape."""
    found = [np.empty(0, np.uint64)]
    for start in range(0, len(words), 1 << 16):
        some = words[start : start + (1 << 16)]
        hashes = np.frombuffer(b"".join([blake2b(w, digest_size=8).digest() for w in some]), "<u8")
        found.append(hashes & ~np.uint64(SHAPE) | _shapes(some))
    return np.concatenate(found)


class WordPlaces(dict):
    """Lower-case word -> its place in ``keys``, which are worked out for many new words at once."""

    def __init__(self) -> None:
        self.keys, self.new = np.empty(0, np.uint64), []

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the distinct words of all texts, the number of each word among these, one text
        after the other, and where the words of each text end."""
        texts = texts.cast(pa.binary()).view(pa.string()).fill_null("")
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        found = split.flatten().dictionary_encode()
        numbers = found.indices.to_numpy()
        ends = np.cumsum(split.value_lengths().to_numpy(), dtype=np.int64)
        words = found.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        # White space at either end of a text leaves an empty word there.
        empty = words.index(b"") if b"" in words else None
        if empty is not None:
            del words[empty]
            real = numbers != empty
            ends = np.concatenate([[0], np.cumsum(real)])[ends]
            numbers = numbers[real]
            numbers = numbers - (numbers > empty)
        places = np.fromiter(map(self.get, words, repeat(-1)), np.int32, len(words))
        unmet = np.flatnonzero(places < 0)
        places[unmet] = np.arange(len(self), len(self) + len(unmet))
        new = [words[i] for i in unmet.tolist()]
        self.update(zip(new, range(len(self), len(self) + len(new))))
        self.new += new
        return places, numbers, ends

    def learn(self) -> np.ndarray:
        """The keys of all words."""
        if self.new:
            self.keys = np.concatenate([self.keys, word_keys(self.new)])
            self.new = []
        return self.keys

    def forget(self) -> None:
        self.clear()
        self.__init__()


class Vocabulary(dict):
    """Word key -> id. Of the words beyond: sorted keys and logs of the known ones, ``rest`` (key, log) with the others or None, and the ``unseen`` log by shape."""

    keys_known: np.ndarray
    logs_known: np.ndarray
    unseen: np.ndarray
    rest: DataFrame | None = None


class WordIds:
    """Ids of words; those beyond the vocabulary go by length and shape. For these,
    also the logs of the known ones and of those not met."""

    def __init__(self, vocabulary: dict[int, int]) -> None:
        keys = np.fromiter(vocabulary, np.uint64, len(vocabulary))
        order = np.argsort(keys)
        self.keys, self.numbers = keys[order], np.fromiter(vocabulary.values(), np.int16, len(keys))[order]
        self.keys_known = getattr(vocabulary, "keys_known", self.keys[:0])
        self.logs_known = getattr(vocabulary, "logs_known", np.empty(0))
        self.unseen = getattr(vocabulary, "unseen", np.zeros(SHAPE + 1))
        self.whole = getattr(vocabulary, "rest", None) is None
        self.places = per_worker("word_places", WordPlaces)
        self._start()

    def _start(self) -> None:
        self.ids, self.logs, self.open = np.empty(0, np.int16), np.empty(0), np.empty(0, bool)

    def _learn(self) -> None:
        keys = self.places.learn()[len(self.ids) :]
        if not len(keys):
            return
        shape = (keys & np.uint64(SHAPE)).astype(np.int64)
        place, hit = _found(self.keys, keys)
        ids = shape.astype(np.int16)
        ids[hit] = self.numbers[place[hit]]
        place, known = _found(self.keys_known, keys)
        logs = self.unseen[shape] if self.whole else np.zeros(len(keys))
        logs[known] = self.logs_known[place[known]]
        logs[hit] = 0
        self.ids, self.logs = np.concatenate([self.ids, ids]), np.concatenate([self.logs, logs])
        self.open = np.concatenate([self.open, ~(hit | known | self.whole)])

    def of(self, text: bytes | None) -> np.ndarray:
        places, numbers, _ = self.places.of(pa.array([text], pa.binary()))
        self._learn()
        return self.ids[places][numbers]

    def coded(self, texts: pa.Array) -> tuple[list[bytes], np.ndarray, list[np.ndarray]]:
        """Of each text: packed ids, the logs of the words beyond within their shapes,
        and the keys of those whose logs aren't here."""
        if len(self.places) > REMEMBERED:
            self.places.forget()
            self._start()
        places, numbers, ends = self.places.of(texts)
        self._learn()
        starts = np.concatenate([[0], ends[:-1]])
        bounds = list(zip(starts.tolist(), ends.tolist()))
        ids, logs = self.ids[places][numbers], self.logs[places][numbers]
        left = [np.empty(0, np.uint64)] * len(texts)
        if not self.whole:
            open_ = np.flatnonzero(self.open[places][numbers])
            keys = self.places.keys[places[numbers[open_]]]
            left = np.split(keys, np.searchsorted(open_, ends[:-1]))
        return [ids[s:e].tobytes() for s, e in bounds], np.array([logs[s:e].sum() for s, e in bounds]), left


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in sorted ``keys`` and whether the wanted key is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    place = np.searchsorted(keys, wanted).clip(0, len(keys) - 1)
    return place, keys[place] == wanted


@dataclass
class Network:
    """``tables``: a vector per window place and word; ``classes`` and ``words`` with
    their biases: the two softmax steps."""

    tables: np.ndarray
    bias: np.ndarray
    classes: np.ndarray
    class_bias: np.ndarray
    words: np.ndarray
    word_bias: np.ndarray

    def __post_init__(self) -> None:
        # Each step's vectors beside their biases, which meet a column of ones.
        self.upper = np.concatenate([self.classes, self.class_bias[None]])
        self.lower = np.concatenate([np.ascontiguousarray(self.words.transpose(0, 2, 1)), self.word_bias[:, None]], axis=1)
        self.classes, self.class_bias = self.upper[:-1], self.upper[-1]
        self.words, self.word_bias = self.lower[:, :-1].transpose(0, 2, 1), self.lower[:, -1]

    @staticmethod
    def new(seed: int = 7) -> Network:
        numbers = np.random.default_rng(seed)
        draw = lambda *shape: numbers.normal(0, 0.1, shape).astype(np.float32)
        zero = lambda *shape: np.zeros(shape, np.float32)
        return Network(
            draw(len(WINDOW), WORDS + 1, WIDTH),
            zero(WIDTH),
            draw(WIDTH, CLASSES),
            zero(CLASSES),
            draw(CLASSES, CLASSES, WIDTH),
            zero(CLASSES, CLASSES),
        )

    def parts(self) -> list[np.ndarray]:
        return [self.tables, self.bias, self.classes, self.class_bias, self.words, self.word_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def with_numbers(self, flat: np.ndarray) -> Network:
        cuts = np.cumsum([p.size for p in self.parts()])[:-1]
        return Network(*(new.reshape(p.shape).copy() for new, p in zip(np.split(flat, cuts), self.parts())))

    def hidden(self, context: np.ndarray) -> np.ndarray:
        """``context``: a row per window place."""
        total = self.tables[0].take(context[0], axis=0)
        for table, ids in zip(self.tables[1:], context[1:]):
            total += table.take(ids, axis=0)
        total += self.bias
        return np.tanh(total, out=total)

    def log_probabilities(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        # By class: both steps of its words are one product.
        order = np.argsort(target, kind="stable")
        klass, word = np.divmod(target[order], CLASSES)
        context, logs = context[:, order], np.empty(len(target), np.float32)
        for k, run in _runs(np.bincount(klass, minlength=CLASSES)):
            both = np.concatenate([self.upper, self.lower[k]], axis=1)
            for start in range(run.start, run.stop, PRODUCT):
                rows = slice(start, min(start + PRODUCT, run.stop))
                logits = (_with_ones(self.hidden(context[:, rows])) @ both).reshape(-1, CLASSES)
                _tame(logits)
                part = logits[::2, k] + logits[1::2][np.arange(len(logits) // 2), word[rows]]
                sums = np.log(np.exp(logits, out=logits) @ ONES)
                logs[rows] = part - sums[::2] - sums[1::2]
        out = np.empty_like(logs)
        out[order] = logs
        return out

    def train(self, context: np.ndarray, target: np.ndarray, past: Network) -> None:
        """One step downhill; ``past`` gathers the squares of the gradients."""
        order = np.argsort(target, kind="stable")
        self.train_sorted(context[:, order], target[order], past)

    def train_sorted(self, context: np.ndarray, target: np.ndarray, past: Network) -> None:
        """The same for words in the order of their ids."""
        picks = np.divmod(target, CLASSES)
        runs = _runs(np.bincount(picks[0], minlength=CLASSES))
        hidden = self.hidden(context)
        state = _with_ones(hidden)
        both, words = np.empty((2, len(target), CLASSES), np.float32), list(self.lower)
        wrong, off = both
        np.dot(state, self.upper, out=wrong)
        parts = [(k, state[run], off[run]) for k, run in runs]
        for k, known, part in parts:
            np.dot(known, words[k], out=part)
        _softmax(both.reshape(-1, CLASSES))
        both.ravel()[CLASSES * np.arange(2 * len(target)) + np.concatenate(picks)] -= 1
        back, slopes, words = wrong @ self.classes.T, np.zeros_like(self.lower), list(self.words)
        lower = np.empty_like(back)
        for (k, known, part), (_, run) in zip(parts, runs):
            np.dot(part, words[k], out=lower[run])
            np.dot(known.T, part, out=slopes[k])
        back += lower
        _step(self.lower, past.lower, slopes)
        _step(self.upper, past.upper, state.T @ wrong)
        hidden *= hidden
        back *= np.subtract(1, hidden, out=hidden)
        _step(self.bias, past.bias, state[:, -1] @ back)
        # The four tables as one, the word of each place by its row there.
        height = self.tables.shape[1]
        used, slope = _sums((context + height * np.arange(len(WINDOW), dtype=np.int16)[:, None]).ravel(), back)
        tables, squares = self.tables.reshape(-1, WIDTH), past.tables.reshape(-1, WIDTH)
        grown = squares.take(used, axis=0)
        values = tables.take(used, axis=0)
        _step(values, grown, slope)
        tables[used], squares[used] = values, grown


def _with_ones(rows: np.ndarray) -> np.ndarray:
    out = np.empty((len(rows), rows.shape[1] + 1), np.float32)
    out[:, :-1], out[:, -1] = rows, 1
    return out


def _runs(counts: np.ndarray) -> list[tuple[int, slice]]:
    ends = np.cumsum(counts)
    met = np.flatnonzero(counts)
    return [(k, slice(s, e)) for k, s, e in zip(met.tolist(), (ends - counts)[met].tolist(), ends[met].tolist())]


def _sums(ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids and the sum of the rows of each; ``ids`` go round all rows again and again."""
    order = np.argsort(ids, kind="stable")
    counts = np.bincount(ids)
    found = np.flatnonzero(counts)
    counts = counts[found]
    starts = np.cumsum(counts) - counts
    # The ids met most often come first.
    by = np.argsort(-np.minimum(counts, FEW + 1).astype(np.int8), kind="stable")
    starts, counts = starts[by], counts[by]
    at = np.tile(np.arange(len(rows)), len(ids) // len(rows))[order]
    sums = rows.take(at[starts], axis=0)
    for step in range(1, FEW):
        more = np.count_nonzero(counts > step)
        sums[:more] += rows.take(at[starts[:more] + step], axis=0)
    # What is left of these is added up two numbers at a time.
    more = np.count_nonzero(counts > FEW)
    if more:
        ends = np.cumsum(counts[:more] - FEW)
        begins = np.concatenate([[0], ends[:-1]])
        places = np.arange(ends[-1]) + np.repeat(starts[:more] + FEW - begins, counts[:more] - FEW)
        several = rows.take(at[places], axis=0)
        sums[:more] += np.add.reduceat(several.view(np.complex64), begins, axis=0).view(np.float32)
    out = np.empty_like(sums)
    out[by] = sums
    return found.astype(ids.dtype), out


def _step(values: np.ndarray, squares: np.ndarray, slope: np.ndarray) -> None:
    """``slope`` is used up."""
    grown = slope * slope
    squares += grown
    np.add(squares, 1e-6, out=grown)
    slope *= RATE
    slope /= np.sqrt(grown, out=grown)
    values -= slope


def _tame(logits: np.ndarray) -> None:
    """Logits of either sign are fine as they are unless their powers leave single precision."""
    if logits.size and max(logits.max(), -logits.min()) > TAME:
        logits -= logits.max(axis=1, keepdims=True)


def _softmax(logits: np.ndarray) -> np.ndarray:
    _tame(logits)
    np.exp(logits, out=logits)
    logits *= np.reciprocal(logits @ ONES)[:, None]
    return logits


def _padded(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All ids in a row with the window's width of padding around each text, and the
    places of the words."""
    reach = max(WINDOW)
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(lengths + reach) - lengths
    flat = np.full(int((lengths + reach).sum()) + reach, PAD, np.int16)
    places = np.concatenate([np.arange(s, s + n) for s, n in zip(starts, lengths)] or [np.empty(0, np.int64)])
    flat[places] = np.concatenate(texts) if texts else flat[:0]
    return flat, places


def _context(flat: np.ndarray, places: np.ndarray) -> np.ndarray:
    return flat.take(places + np.array(WINDOW)[:, None])


def document_scores(network: Network, texts: list[np.ndarray]) -> np.ndarray:
    """The summed log-probabilities of each text."""
    flat, places = _padded(texts)
    logs = np.empty(len(places) + 1, np.float64)
    for start in range(0, len(places), STRETCH):
        part = places[start : start + STRETCH]
        logs[start : start + len(part)] = network.log_probabilities(_context(flat, part), flat[part])
    total = np.concatenate([[0.0], np.cumsum(logs[:-1])])
    lengths = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]


def _portions(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, by the length of the texts of the column."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        number = np.cumsum(sizes, dtype=np.int64) // PORTION
        cuts = (np.flatnonzero(np.diff(number)) + 1).tolist()
        for start, end in zip([0, *cuts], [*cuts, len(batch)]):
            if end > start:
                yield batch.slice(start, end - start)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    places = per_worker("word_places", WordPlaces)
    counts = np.zeros(0, np.int64)

    def counted() -> pa.RecordBatch:
        met = np.flatnonzero(counts)
        return pa.RecordBatch.from_arrays(
            [pa.array(places.learn()[met].view(np.int64)), pa.array(counts[met])], names=["word", "n"]
        )

    for batch in _portions(batches, 0):
        if len(places) > REMEMBERED:
            yield counted()
            places.forget()
            counts = counts[:0]
        met, numbers, _ = places.of(batch.column(0))
        if len(counts) < len(places):
            counts = np.concatenate([counts, np.zeros(len(places), np.int64)])
        counts[met] += np.bincount(numbers, minlength=len(met))
    found = counted()
    if len(found):
        yield found


def vocabulary(texts: DataFrame) -> tuple[Vocabulary, int]:
    """Ids of the most frequent words of all texts (after the ids of shapes) with what
    is known of the others, and the number of all words."""
    counted = texts.mapInArrow(_word_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counted = materialize(counted, "words")
    total = counted.agg(F.sum("n")).first()[0] or 0
    top = counted.orderBy(F.desc("n"), "word").limit(WORDS - CLASSES).collect()
    found = Vocabulary({row["word"] & ((1 << 64) - 1): CLASSES + at for at, row in enumerate(top)})
    beyond = counted.where(F.lit(False))
    if len(top) == WORDS - CLASSES:
        last = top[-1]
        beyond = counted.where((F.col("n") < last["n"]) | (F.col("n") == last["n"]) & (F.col("word") > last["word"]))
    shape = F.col("word").bitwiseAND(F.lit(SHAPE))
    often = F.floor(4 * F.log2("n")).cast("int")
    parts = beyond.groupBy(shape.alias("shape"), often.alias("often")).agg(F.count("*"), F.sum("n")).collect()
    sizes, by_often = np.zeros((2, SHAPE + 1)), {}
    for kind, rank, words, n in parts:
        sizes[:, kind] += n, words
        by_often[rank] = by_often.get(rank, 0) + words
    whole = np.maximum(sizes.sum(axis=0), 1)
    found.unseen = np.log(np.where(sizes[1] > 0, sizes[1], 1) / whole)
    least, held = max(by_often, default=0) + 1, 0
    while least - 1 >= min(by_often, default=least) and held + by_often.get(least - 1, 0) <= KNOWN:
        least -= 1
        held += by_often.get(least, 0)
    log = F.log(F.col("n") / F.array(*map(F.lit, whole.tolist()))[shape.cast("int")])
    beyond = beyond.select(F.col("word").alias("key"), log.alias("log"), often.alias("often"))
    known = beyond.where(F.col("often") >= least).select("key", "log").toArrow()
    keys = known.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    found.keys_known, found.logs_known = keys[order], known.column("log").to_numpy()[order]
    if held < sum(by_often.values()):
        found.rest = beyond.where(F.col("often") < least).select("key", "log")
    return found, total


def _coded(words: Vocabulary) -> Callable:
    vocabulary = Vocabulary(words)
    vocabulary.keys_known, vocabulary.logs_known, vocabulary.unseen = words.keys_known, words.logs_known, words.unseen
    # A table stays with the driver; tasks only ask whether there is one.
    vocabulary.rest = None if words.rest is None else True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = WordIds(vocabulary)
        context = TaskContext.get()
        row = (context.partitionId() if context else 0) << 40
        for batch in _portions(batches, 2):
            packed, logs, left = ids.coded(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("shard"),
                    pa.array(packed, pa.binary()),
                    pa.array(logs, pa.float64()),
                    pa.array(row + np.arange(len(packed)), pa.int64()),
                    long_lists(left),
                ],
                names=["id", "shard", "ids", "logs", "row", "rare"],
            )
            row += len(packed)

    return run


def coded(docs: DataFrame, words: Vocabulary, shards: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, shard, ids, logs, row, rare) of every row: the packed ids of its words, and of the words beyond the
    vocabulary the summed logs within their shapes and, beside a number of the row, the keys of those whose
    logs are to be joined."""
    schema = T.StructType(
        [
            T.StructField("id", docs.schema[id_col].dataType),
            T.StructField("shard", T.IntegerType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("logs", T.DoubleType()),
            T.StructField("row", T.LongType()),
            T.StructField("rare", T.ArrayType(T.LongType())),
        ]
    )
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shard = F.pmod(F.xxhash64("text", "id"), F.lit(shards)).cast("int") if shards > 1 else F.lit(0)
    return rows.select("id", shard.alias("shard"), "text").mapInArrow(_coded(words), schema)


def _train_shard(network: Network, turn: int, texts: list[bytes]) -> np.ndarray:
    # In an order that doesn't depend on how the rows arrived.
    flat, places = _padded([np.frombuffer(t, np.int16) for t in sorted(texts)])
    numbers = np.random.default_rng([turn, len(places)])
    numbers.shuffle(places)
    own, past = network.with_numbers(network.flat()), network.with_numbers(0 * network.flat())
    for start in range(0, len(places), BATCH):
        part = places[start : start + BATCH]
        part = part[np.argsort(flat[part], kind="stable")]
        own.train_sorted(_context(flat, part), flat[part], past)
    return own.flat()


SUMS = "block int, part long, n long, numbers binary"


def _train_bundle(network: Network, turn: int) -> Callable[[pa.Table], pa.Table]:
    """Sums of the copies trained on the shards of a bundle, block by block."""

    def run(bundle: pa.Table) -> pa.Table:
        shard = bundle.column("shard").to_numpy()
        ids = bundle.column("ids").to_pylist()
        own = np.unique(shard)
        total = sum(
            _train_shard(network, turn, [ids[i] for i in np.flatnonzero(shard == s)]).astype(np.float64) for s in own
        ).astype(np.float32)
        blocks = [total[s : s + BLOCK].tobytes() for s in range(0, len(total), BLOCK)]
        parts, copies = [int(own[0]) // BUNDLE] * len(blocks), [len(own)] * len(blocks)
        return pa.table(
            [pa.array(range(len(blocks)), pa.int32()), pa.array(parts), pa.array(copies), pa.array(blocks, pa.binary())],
            names=["block", "part", "n", "numbers"],
        )

    return run


def _sum(rows: pa.Table) -> pa.Table:
    parts, numbers = rows.column("part").to_numpy(), rows.column("numbers").to_pylist()
    total = sum(np.frombuffer(numbers[i], np.float32).astype(np.float64) for i in np.argsort(parts, kind="stable"))
    n = int(rows.column("n").to_numpy().sum())
    return pa.table(
        [
            rows.column("block")[:1],
            pa.array([int(parts[0]) // FAN_IN]),
            pa.array([n]),
            pa.array([total.astype(np.float32).tobytes()], pa.binary()),
        ],
        names=["block", "part", "n", "numbers"],
    )


def _trained(picked: DataFrame, shards: int) -> Network:
    network = Network.new()
    picked = picked.select("shard", "ids")
    bundle = F.expr(f"shard div {BUNDLE}").alias("bundle")
    for turn in range(ROUNDS):
        sums = picked.groupBy(bundle).applyInArrow(_train_bundle(network, turn), SUMS)
        parts = -(-shards // BUNDLE)
        while True:
            sums = sums.groupBy("block", F.expr(f"part div {FAN_IN}").alias("next")).applyInArrow(_sum, SUMS)
            if parts <= FAN_IN:
                break
            parts = -(-parts // FAN_IN)
        means = sums.collect()
        if means:
            ordered = sorted(means, key=lambda row: row["block"])
            network = network.with_numbers(
                np.concatenate([np.frombuffer(row["numbers"], np.float32) / row["n"] for row in ordered]).astype(np.float32)
            )
    return network


def _coded_and_trained(docs: DataFrame, id_col: str, text_col: str) -> tuple[Vocabulary, DataFrame, Network]:
    words, total = vocabulary(docs.select(F.col(text_col).alias("text")))
    shards = max(1, round(total / SHARD_WORDS))
    picked = materialize(coded(docs, words, shards, id_col, text_col), "shards")
    return words, picked, _trained(picked, shards)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[Vocabulary, Network]:
    """The vocabulary of all documents and the network trained on them."""
    words, _, network = _coded_and_trained(docs, id_col, text_col)
    return words, network


def train_and_score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``score_documents`` of the documents trained on; each text is taken apart for both at once."""
    words, picked, network = _coded_and_trained(docs, id_col, text_col)
    return _scored(picked, words, network)


def _score(network: Network) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            held: list[np.ndarray] = []
            scores, sizes, waiting = [], [], 0
            packed = batch.column("ids").to_pylist()
            for at, ids in enumerate(packed):
                held.append(np.frombuffer(ids, np.int16))
                sizes.append(len(held[-1]))
                waiting += sizes[-1]
                if at == len(packed) - 1 or waiting > 1 << 18:
                    scores += document_scores(network, held).tolist()
                    held, waiting = [], 0
            scores = np.array(scores) + batch.column("logs").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(scores, pa.float64()), batch.column("row")],
                names=["id", "n_words", "log_likelihood", "row"],
            )

    return run


def _scored(picked: DataFrame, words: Vocabulary, network: Network) -> DataFrame:
    """``picked``: stored if some logs are to be joined, so that rows keep their numbers."""
    schema = T.StructType(
        [
            picked.schema["id"],
            T.StructField("n_words", T.LongType()),
            T.StructField("log_likelihood", T.DoubleType()),
            T.StructField("row", T.LongType()),
        ]
    )
    found = picked.select("id", "ids", "logs", "row").mapInArrow(_score(network), schema)
    if words.rest is not None:
        shape = F.col("key").bitwiseAND(F.lit(SHAPE)).cast("int")
        unseen = F.array(*map(F.lit, words.unseen.tolist()))[shape]
        rare = picked.select("row", F.explode("rare").alias("key"))
        more = rare.join(words.rest, "key", "left").groupBy("row").agg(F.sum(F.coalesce("log", unseen)).alias("more"))
        log = F.col("log_likelihood") + F.coalesce("more", F.lit(0.0))
        found = found.join(more, "row", "left").withColumn("log_likelihood", log)
    total = F.round("log_likelihood", 4)
    mean = F.when(F.col("n_words") > 0, F.round(F.col("log_likelihood") / F.col("n_words"), 6))
    return found.select("id", "n_words", total.alias("log_likelihood"), mean.alias("per_word"))


def score_documents(
    docs: DataFrame,
    words: Vocabulary,
    network: Network,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, n_words, log_likelihood, per_word) of every row of ``docs``.

    ``log_likelihood`` sums the conditional log-probabilities of all words of the
    whole text, each within its shape too if it is beyond the vocabulary, to four
    decimals, and ``per_word`` is its mean. Null and empty texts
    have no words, the sum 0 and a null mean. Ids may be null or repeat; equal texts
    score alike; other columns aren't read; an empty table gives no rows. A network
    that saw no words scores with its starting numbers.
    """
    picked = coded(docs, words, 1, id_col, text_col)
    if words.rest is not None:
        picked = materialize(picked, "coded")
    return _scored(picked, words, network)
