"""Packing against plain best fit decreasing and the tokenizer itself."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vintagemart.llm import packing
from vintagemart.llm.packing import Plan, TokenIds, pack
from vintagemart.llm.queries import QUERIES
from vintagemart.sources.scratch import materialize

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None,
    "",
    " \n\t ",
    "The quick, brown fox. It's THERE!",
    "É é ß ñ ıİ ΑΣ Σας. naïve,naïve",
    "é ǻ. x y z\x1c w\x85v",
    "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>.",
    "don't we'll I'm 's. 12.5, a1. ... ,,, a.b,c .,",
    "日本語 текст. 🙂 🙂.",
    "word " * 9000,
]


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for length in sorted(lengths, reverse=True):
        fits = [i for i, g in enumerate(gaps) if g >= length]
        if fits:
            gaps[min(fits, key=lambda i: gaps[i])] -= length
        else:
            gaps.append(capacity - length)
    return len(gaps)


def test_forms_give_the_tokenizers_ids():
    tokenizer = Tokenizer.from_file(PATH)
    own = list(TokenIds(PATH).of([t and t.encode() for t in TEXTS]))
    for text, packed in zip(TEXTS, own):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(packed, "<u4").tolist() == ids, text


def test_memory_of_forms_starts_anew(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED_FORMS", 3)
    tokens = TokenIds(PATH)
    for _ in range(3):
        for text, packed in zip(TEXTS, tokens.of([t and t.encode() for t in TEXTS])):
            assert packed == tokens.packed(text or "")


def test_new_forms_dont_walk_through_the_memory():
    class Memory(TokenIds):
        def __iter__(self):
            raise AssertionError("all forms were walked through")

    tokens = Memory(PATH)
    for _ in range(2):
        for text, packed in zip(TEXTS, tokens.of([t and t.encode() for t in TEXTS])):
            assert packed == tokens.packed(text or "")


@pytest.mark.parametrize("capacity", [1, 7, 50, 2048])
def test_plan_is_best_fit_decreasing(capacity):
    rng = random.Random(capacity)
    for count in (0, 1, 10, 500):
        lengths = [rng.randint(1, capacity) for _ in range(count)]
        counts = {k: lengths.count(k) for k in set(lengths)}
        plan = Plan(counts, capacity)
        assert plan.sequences == best_fit_decreasing(lengths, capacity)
        filled: dict[int, list] = {}
        for length, n in counts.items():
            for place in plan.places(np.full(n, length), np.arange(n)).tolist():
                filled.setdefault(place // capacity, []).append((place % capacity, length))
        for pieces in filled.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            assert at <= capacity


def check(rows, texts, capacity, end):
    """Every text comes back from its pieces, and every sequence is gapless."""
    tokenizer = Tokenizer.from_file(PATH)
    by_id, sequences = {}, {}
    for r in rows:
        by_id.setdefault(r["id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for key, text in texts:
        pieces = sorted(by_id.get(key, []), key=lambda r: r["piece"])
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + ([0] if end else [])
        assert np.frombuffer(b"".join(p["ids"] for p in pieces), "<u4").tolist() == ids
        assert [p["piece"] for p in pieces] == list(range(len(pieces)))
        assert all(p["start"] == capacity * p["piece"] for p in pieces)
        assert all(p["length"] == capacity for p in pieces[:-1])
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


@pytest.mark.parametrize("end", [0, None])
def test_tables(spark, end):
    rng = random.Random(8)
    texts = list(enumerate(TEXTS)) + [
        (100 + i, " ".join(rng.choice(["alpha", "beta.", "Gamma", "d,"]) for _ in range(rng.randrange(1, 200))))
        for i in range(150)
    ]
    df = spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id long, text string, length string")
    df = df.repartition(5)
    rows = pack(df, PATH, capacity=64, end_id=end).collect()
    n = check(rows, texts, 64, end is not None)
    assert n == best_fit_decreasing([r["length"] for r in rows], 64)


def test_null_and_repeated_ids_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c"), (1, "d")], "doc_id long, text string")
    rows = pack(df, PATH, capacity=8).collect()
    assert sorted((r["id"] or 0, r["length"]) for r in rows) == [(0, 2), (1, 2), (1, 3), (1, 3)]
    assert len({r["sequence_id"] for r in rows}) == best_fit_decreasing([3, 3, 2, 2], 8)
    assert pack(df.limit(0), PATH).count() == 0
    with pytest.raises(ValueError):
        pack(df, PATH, capacity=0)


def test_query_keeps_its_contract(spark, sf_dir):
    df = QUERIES["op1_best_fit_packing"](spark, sf_dir)
    assert dict(df.dtypes) == {
        "doc_id": "bigint",
        "piece": "int",
        "start": "bigint",
        "length": "bigint",
        "ids_crc32": "bigint",
        "sequence_id": "bigint",
        "offset": "bigint",
    }
    rows = df.collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit(""))).collect()
    tokenizer = Tokenizer.from_file(PATH)
    expected = set()
    for key, text in docs:
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        for piece, start in enumerate(range(0, len(ids), 2048)):
            cut = ids[start : start + 2048]
            expected.add((key, piece, start, len(cut), zlib.crc32(cut.tobytes())))
    assert {tuple(r)[:5] for r in rows} == expected and len(rows) == len(expected)
    assert len({r["sequence_id"] for r in rows}) == best_fit_decreasing([r["length"] for r in rows], 2048)


def test_random_texts_give_the_tokenizers_ids():
    tokenizer, rng = Tokenizer.from_file(PATH), random.Random(4)
    parts = ["İ", "I", "ı", "ß", "é", "é", "̇", "a", "Z", "7", "日", "Ω", "ς", ".", ",", "'s", "!?", "(", "🙂", " ", "  ", "\n"]
    texts = ["BİLGİ.", "İ,", "tarihİ;", "İ́."]
    texts += ["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(20_000)]
    for text, packed in zip(texts, TokenIds(PATH).of([t.encode() for t in texts])):
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(packed, "<u4").tolist() == ids, text


def test_workers_get_small_batches(spark, monkeypatch):
    """Whole texts reach a worker a few hundred at a time; the session keeps its setting."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, during = spark.conf.get(setting), {}

    def stored(df, name):
        during[name] = int(spark.conf.get(setting))
        return materialize(df, name)

    monkeypatch.setattr(packing, "materialize", stored)
    docs = spark.range(3).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    assert pack(docs, PATH).count() == 3
    assert during["pieces"] <= 500 and spark.conf.get(setting) == before
