"""Ordinal quality classifier on hashed texts.

Ratings are ordered grades 0 .. K-1. One score per document, a weighted sum of
hashed words (present or not) and a few shape rates, is shared by all grades; K-1
ordered thresholds cut the score: ``P(grade >= k) = sigmoid(score - threshold_k)``.
The sum of these tail probabilities is the expected grade, and one of them selects.

A word takes part only if its presence goes with a grade far beyond chance: words
that don't would add up to noise that grows with the length of a text. Features are
worked out inside tasks. The fit sees a bounded sample of the rated
documents (``SAMPLE_ROWS``, the smallest hashes of their ids), as sparse rows of
numbers; every document is scored, on its whole text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintagemart.llm.decontaminate import plain_words
from vintagemart.llm.shingles import WordHashes, text_bytes
from vintagemart.llm.worker import per_worker, slices

# Rated documents that the fit may see.
SAMPLE_ROWS = 20_000
# Hashed features; a word counts if it is in so many sampled documents, and if in one
# grade it is so many standard deviations more or less frequent than by chance.
BITS = 20
LEAST_DOCUMENTS = 5
LEAST_DEVIATION = 6.0
# Shape rates are cut at so many standard deviations.
SHAPE_LIMIT = 30.0
SHAPES = ("capitals", "marks", "bars", "digits", "repeats", "distinct", "word_length", "log_words")
RIDGE = 1.0
SHAPE_RIDGE = 0.01

_CAPITALS = bytes(range(65, 91))
_MARKS = b"!#$%&*@^~<>{}[]\\=+_?"
_DIGITS = b"0123456789"


def features(text: bytes | None, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct word slots, shape rates) of a whole text."""
    raw = text or b""
    words = hashes.of(plain_words(raw))
    slots = (words & np.uint64((1 << BITS) - 1)).astype(np.int32)
    used = np.unique(slots)
    size, n = max(len(raw), 1), max(len(words), 1)
    rate = lambda those: (len(raw) - len(raw.translate(None, those))) / size
    shape = np.array(
        [
            rate(_CAPITALS),
            rate(_MARKS),
            rate(b"|"),
            rate(_DIGITS),
            float((slots[1:] == slots[:-1]).sum()) / n,
            np.log(n) - np.log(max(len(used), 1)),
            len(raw) / n,
            np.log1p(len(words)),
        ]
    )
    return used, shape


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = per_worker("word_hashes", WordHashes)
    for batch in slices(batches):
        found = [features(t, hashes) for t in text_bytes(batch.column(1))]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([f[0] for f in found], pa.list_(pa.int32())),
                pa.array([f[1] for f in found], pa.list_(pa.float64())),
            ],
            names=["grade", "slots", "shape"],
        )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class OrdinalModel:
    """``weights`` by word slot, then the shape rates' ``centre``, ``scale`` and
    weights, and the ascending thresholds. Without rated documents there are no
    thresholds."""

    weights: np.ndarray
    shape_weights: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    thresholds: np.ndarray

    def tails(self, text: bytes | None, hashes: WordHashes) -> np.ndarray:
        """P(grade >= k) for k = 1 .. K-1; a text without words has grade 0."""
        slots, shape = features(text, hashes)
        if not len(slots):
            return np.zeros(len(self.thresholds))
        score = self.weights[slots].sum(dtype=np.float64)
        score += ((shape - self.centre) / self.scale).clip(-SHAPE_LIMIT, SHAPE_LIMIT) @ self.shape_weights
        return _sigmoid(score - self.thresholds)


def _loss(params: np.ndarray, data: tuple, cuts: int) -> tuple[float, np.ndarray]:
    """Penalised negative log likelihood and its gradient. Thresholds are the first
    one and the logarithms of the steps between them, so that they stay ordered."""
    rows, columns, shape, grade, size = data
    steps, weights, other = params[:cuts], params[cuts : cuts + size], params[cuts + size :]
    jumps = np.exp(np.clip(steps[1:], -20, 20))
    thresholds = np.concatenate([steps[:1], steps[0] + np.cumsum(jumps)])
    score = np.bincount(rows, weights[columns], len(grade)) + shape @ other
    # P(grade >= k) for k = 0 .. K, of which the first is 1 and the last is 0.
    tails = _sigmoid(score[:, None] - thresholds)
    tails = np.hstack([np.ones((len(grade), 1)), tails, np.zeros((len(grade), 1))])
    at = np.arange(len(grade))
    upper, lower = tails[at, grade], tails[at, grade + 1]
    chance = np.maximum(upper - lower, 1e-12)
    slope = tails * (1 - tails)
    to_score = -(slope[at, grade] - slope[at, grade + 1]) / chance
    to_cut = np.zeros_like(tails)
    to_cut[at, grade] += slope[at, grade] / chance
    to_cut[at, grade + 1] -= slope[at, grade + 1] / chance
    by_cut = to_cut[:, 1 : cuts + 1].sum(0)
    to_steps = np.concatenate([[by_cut.sum()], np.cumsum(by_cut[::-1])[::-1][1:] * jumps])
    to_weights = np.bincount(columns, to_score[rows], size) + RIDGE * weights
    to_other = shape.T @ to_score + SHAPE_RIDGE * other
    value = -np.log(chance).sum() + (RIDGE * (weights**2).sum() + SHAPE_RIDGE * (other**2).sum()) / 2
    return value, np.concatenate([to_steps, to_weights, to_other])


def _minimise(loss: Callable, start: np.ndarray, rounds: int = 120, memory: int = 8) -> np.ndarray:
    """Limited-memory quasi-Newton steps with backtracking."""
    x, (value, slope) = start, loss(start)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        step, kept = -slope, []
        for s, y in reversed(pairs):
            a = s @ step / (s @ y)
            step = step - a * y
            kept.append(a)
        if pairs:
            s, y = pairs[-1]
            step = step * (s @ y) / (y @ y)
        else:
            step = step / max(1.0, np.abs(slope).max())
        for (s, y), a in zip(pairs, reversed(kept)):
            step = step + (a - y @ step / (s @ y)) * s
        length, downhill = 1.0, slope @ step
        while True:
            new_value, new_slope = loss(x + length * step)
            if new_value <= value + 1e-4 * length * downhill or length < 1e-8:
                break
            length /= 2
        moved, turned = length * step, new_slope - slope
        done = value - new_value <= 1e-6 * abs(value)
        x, value, slope = x + moved, new_value, new_slope
        if done:
            break
        if moved @ turned > 1e-10:
            pairs = [*pairs[-memory + 1 :], (moved, turned)]
    return x


def _telling(slots: np.ndarray, grades: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Which slots go with a grade: ``slots`` and ``grades`` of every (document, word)."""
    there = np.bincount(slots, minlength=1 << BITS)
    most = np.zeros(1 << BITS)
    for grade, share in enumerate(shares):
        own = np.bincount(slots[grades == grade], minlength=1 << BITS)
        spread = np.sqrt(there * share * (1 - share) + 1e-9)
        np.maximum(most, np.abs(own - there * share) / spread, out=most)
    return (there >= LEAST_DOCUMENTS) & (most >= LEAST_DEVIATION)


def fit(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> OrdinalModel:
    """Fit on ``ratings`` (id, ``grade`` 0, 1, ...). Ratings with a null grade or
    without a document are left out; a document rated twice counts twice. Grades up
    to the highest one that occurs are modelled."""
    sample = ratings.where("grade is not null").select(F.col(id_col).alias("id"), F.col("grade").cast("int"))
    sample = sample.orderBy(F.xxhash64("id"), "id", "grade").limit(SAMPLE_ROWS)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = texts.join(F.broadcast(sample), "id").select("grade", "text")
    found = rows.mapInArrow(_feature_rows, "grade int, slots array<int>, shape array<double>").toArrow()

    empty = np.zeros(1 << BITS, np.float32)
    zeros = np.zeros(len(SHAPES))
    grade = found.column("grade").to_numpy().astype(np.int64)
    cuts = int(grade.max()) if len(grade) else 0
    if not cuts:
        return OrdinalModel(empty, zeros, zeros, zeros + 1, np.empty(0))
    lists = found.column("slots").combine_chunks()
    slots = lists.flatten().to_numpy()
    rows_of = np.repeat(np.arange(len(grade)), lists.value_lengths().to_numpy())
    telling = _telling(slots, grade[rows_of], np.bincount(grade) / len(grade))
    known = np.flatnonzero(telling)
    place = np.cumsum(telling) - 1
    used = telling[slots]
    shape = found.column("shape").combine_chunks().flatten().to_numpy().reshape(-1, len(SHAPES))
    centre, scale = shape.mean(0), np.maximum(shape.std(0), 1e-6)
    shape = ((shape - centre) / scale).clip(-SHAPE_LIMIT, SHAPE_LIMIT)
    data = (rows_of[used], place[slots[used]], shape, grade, len(known))
    start = np.zeros(cuts + len(known) + len(SHAPES))
    params = _minimise(lambda p: _loss(p, data, cuts), start)
    steps = params[:cuts]
    empty[known] = params[cuts : cuts + len(known)]
    thresholds = np.concatenate([steps[:1], steps[0] + np.cumsum(np.exp(np.clip(steps[1:], -20, 20)))])
    return OrdinalModel(empty, params[cuts + len(known) :], centre, scale, thresholds)


def _scores(model: OrdinalModel, at: int, grade: int, least: float | None, passed: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = per_worker("word_hashes", WordHashes)
        for batch in slices(batches):
            tails = [model.tails(t, hashes) for t in text_bytes(batch.column(at))]
            tail = np.array([t[grade - 1] for t in tails])
            expected = pa.array([float(t.sum()) for t in tails], pa.float64())
            columns = [*batch.columns[:passed], expected, pa.array(tail, pa.float64())]
            names = [*batch.schema.names[:passed], "expected_grade", "tail_probability"]
            scored = pa.RecordBatch.from_arrays(columns, names=names)
            yield scored if least is None else scored.filter(pa.array(tail >= least))

    return run


def score(
    docs: DataFrame,
    model: OrdinalModel,
    grade: int,
    least: float | None = None,
    columns: list[str] | None = None,
    text_col: str = "text",
) -> DataFrame:
    """``columns`` (all if not given) of every row of ``docs`` with ``expected_grade``
    and ``tail_probability``, the chance of ``grade`` or better; with ``least``, only
    rows whose chance is that high.

    Null and empty texts, and texts without a word, get 0. A grade above all rated
    ones has chance 0, and grade 0 chance 1. With a model that saw no ratings both
    numbers are null and every row stays. Equal texts score alike; columns that have
    the names of the two numbers are refused.
    """
    columns = docs.columns if columns is None else columns
    clash = {"expected_grade", "tail_probability"} & set(columns)
    if clash:
        raise ValueError(f"there are such columns already: {sorted(clash)}")
    if not len(model.thresholds):
        null = F.lit(None).cast("double")
        return docs.select(*columns, null.alias("expected_grade"), null.alias("tail_probability"))
    if not 1 <= grade <= len(model.thresholds):
        chance = float(grade < 1)
        scored = score(docs, model, 1, None, columns, text_col).withColumn("tail_probability", F.lit(chance))
        return scored if least is None else scored.where(F.col("tail_probability") >= least)
    needed = [*columns, *([] if text_col in columns else [text_col])]
    schema = docs.select(*columns).schema
    schema = T.StructType([*schema.fields, T.StructField("expected_grade", T.DoubleType())])
    schema = schema.add("tail_probability", T.DoubleType())
    at = needed.index(text_col)
    return docs.select(*needed).mapInArrow(_scores(model, at, grade, least, len(columns)), schema)
