"""The network's gradient and scores against word-by-word arithmetic."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vintagemart.llm import lm_scores
from vintagemart.llm.lm_scores import (
    CLASSES,
    PAD,
    WINDOW,
    Network,
    WordIds,
    document_scores,
    score_documents,
    train,
    train_and_score,
    vocabulary,
)

SCHEMA = "doc_id long, text string, n_words string"


def plain_score(network, ids):
    """Sums over single words, in plain arithmetic."""
    total = 0.0
    for at, word in enumerate(ids):
        state = network.bias.astype(float)
        for table, step in zip(network.tables, WINDOW):
            there = at + step
            state = state + table[ids[there] if 0 <= there < len(ids) else PAD]
        state = np.tanh(state)
        klass, member = divmod(int(word), CLASSES)
        for logits, pick in (
            (state @ network.classes + network.class_bias, klass),
            (network.words[klass] @ state + network.word_bias[klass], member),
        ):
            total += logits[pick] - math.log(sum(math.exp(x) for x in logits))
    return total


def test_scores_word_by_word(monkeypatch):
    monkeypatch.setattr(lm_scores, "STRETCH", 16)
    rng = np.random.default_rng(1)
    network = Network.new()
    texts = [rng.integers(0, PAD, n).astype(np.int16) for n in (0, 1, 2, 5, 40, 0, 17)]
    expected = [plain_score(network, t) for t in texts]
    assert document_scores(network, texts) == pytest.approx(expected, rel=1e-4, abs=1e-4)
    assert document_scores(network, []).tolist() == []


def test_training_lowers_the_loss():
    rng = np.random.default_rng(2)
    # Every word is fixed by its neighbours.
    text = np.tile(rng.permutation(60)[:12] * 30, 200).astype(np.int16)
    network, past = Network.new(), Network.new().with_numbers(0 * Network.new().flat())
    flat, places = lm_scores._padded([text])
    before = document_scores(network, [text])[0] / len(text)
    for _ in range(20):
        network.train(lm_scores._context(flat, places), flat[places], past)
    assert document_scores(network, [text])[0] / len(text) > before / 4


def test_words_beyond_the_vocabulary():
    ids = WordIds({})
    found = ids.of(b"a bb, c3 d- " + b"x" * 30 + b" A a")
    assert len(set(found[:5])) == 5 and found[5] == found[6] == found[0]
    assert (found < CLASSES).all()


def corpus(spark, n=200):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["the cat sat", "on a mat", "dogs ran"]) for _ in range(60)), "x") for i in range(n)]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(4)


def test_vocabulary_counts_all_words(spark):
    rows, df = corpus(spark)
    words, total = vocabulary(df.select("text"))
    assert total == sum(len(t.split()) for _, t, _ in rows)
    assert sorted(words.values()) == list(range(CLASSES, CLASSES + 8))


def test_fluent_text_scores_higher_and_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(lm_scores, "SHARD_WORDS", 10_000)
    rows, df = corpus(spark)
    words, network = train(df)
    again, same = train(df)
    assert words == again and np.array_equal(network.flat(), same.flat())
    shuffled = rows[0][1].split()
    random.Random(1).shuffle(shuffled)
    odd = [(1000, " ".join(shuffled), "x"), (1001, None, "x"), (1002, "", None), (None, rows[0][1], "x"), rows[0]]
    odd.append((1003, "the cat sat " * 20_000, "x"))
    found = score_documents(df.unionAll(spark.createDataFrame(odd, SCHEMA)), words, network)
    assert found.columns == ["id", "n_words", "log_likelihood", "per_word"]
    scored = found.collect()
    assert len(scored) == len(rows) + len(odd)
    by_id = {r["id"]: r for r in scored}
    assert by_id[0]["per_word"] > by_id[1000]["per_word"] + 0.5
    assert [(by_id[i]["n_words"], by_id[i]["log_likelihood"], by_id[i]["per_word"]) for i in (1001, 1002)] == [(0, 0.0, None)] * 2
    alike = [r["log_likelihood"] for r in scored if r["id"] in (0, None)]
    assert len(alike) == 3 and max(alike) - min(alike) < 1e-2
    assert by_id[1003]["n_words"] == 60_000
    ids = WordIds(words)
    expected = plain_score(network, ids.of(rows[0][1].encode()))
    assert by_id[0]["log_likelihood"] == pytest.approx(expected, rel=1e-3)


@pytest.mark.parametrize("known", [0, 1, 1 << 17])
def test_words_beyond_the_vocabulary_count_as_words(spark, monkeypatch, known):
    network = Network.new()
    monkeypatch.setattr(lm_scores, "KNOWN", known)
    # All but the words of shapes: two words are left in the vocabulary.
    monkeypatch.setattr(lm_scores, "WORDS", CLASSES + 2)
    often = "the and " * 20
    texts = [often + "cat cat cat dog", often + "xqz cat", often + "cat", None, "", often + "cat. dog dog", "cat"]
    df = spark.createDataFrame([(i % 5, t, "x") for i, t in enumerate(texts)], SCHEMA).repartition(3)
    words, total = vocabulary(df.select("text"))
    assert len(words) == 2 and (words.rest is None) == (known > 1) and total == sum(len((t or "").split()) for t in texts)
    odd = spark.createDataFrame([(9, "pqr dog", "x"), (9, "zzzz", "x")], SCHEMA)
    found = score_documents(df.unionAll(odd), words, network).collect()
    # Of three letters: cat 6 times, dog 3 times, xqz once.
    log = {"cat": 6 / 13, "dog": 3 / 13, "xqz": 1 / 13, "pqr": 3 / 13, "zzzz": 1, "cat.": 1 / 2, "the": 1, "and": 1}
    ids = WordIds(dict(words))
    expected = [
        (i, plain_score(network, ids.of(t.encode())) + sum(math.log(log[w]) for w in t.split()))
        for i, t in [*((i % 5, t or "") for i, t in enumerate(texts)), (9, "pqr dog"), (9, "zzzz")]
    ]
    got = sorted((r["id"], r["log_likelihood"]) for r in found)
    for one, two in zip(got, sorted(expected), strict=True):
        assert one == pytest.approx(two, abs=1e-2)


def test_every_document_is_trained_on(spark, monkeypatch):
    class Stop(Exception):
        pass

    found = []

    def seen(df, name):
        if name == "shards":
            found.append(df.agg(F.sum(F.length("ids")), F.count("*"), F.countDistinct("shard")).first())
            raise Stop
        return df

    monkeypatch.setattr(lm_scores, "materialize", seen)
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("a b c d "), 300).alias("text"))
    with pytest.raises(Stop):
        train(df)
    assert tuple(found[0]) == (2 * 3000 * 1200, 3000, 9)


def test_copies_are_averaged_over_all_shards(spark, monkeypatch):
    monkeypatch.setattr(lm_scores, "SHARD_WORDS", 1_000)
    monkeypatch.setattr(lm_scores, "ROUNDS", 1)
    _, df = corpus(spark, n=100)
    _, one = train(df)
    monkeypatch.setattr(lm_scores, "BUNDLE", 1)
    monkeypatch.setattr(lm_scores, "FAN_IN", 2)
    _, two = train(df)
    assert np.allclose(one.flat(), two.flat(), atol=1e-5)
    assert not np.array_equal(one.flat(), Network.new().flat())


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    words, network = train(df)
    assert words == {} and score_documents(df, words, network).count() == 0


def test_rows_are_added_up_by_id():
    rng = np.random.default_rng(4)
    for n in (1, 5, 300):
        rows = rng.normal(size=(n, 32)).astype(np.float32)
        ids = (rng.zipf(1.3, 4 * n) % 90).astype(np.int16)
        used, sums = lm_scores._sums(ids, rows)
        expected = np.zeros((90, 32))
        np.add.at(expected, ids, np.tile(rows, (4, 1)))
        assert used.tolist() == np.unique(ids).tolist()
        assert np.allclose(sums, expected[used], atol=1e-4)


def test_logits_of_any_size():
    rng = np.random.default_rng(5)
    text = rng.integers(0, PAD, 30).astype(np.int16)
    for times in (100, 1_000):
        network = Network.new()
        network.classes *= times
        network.words *= times
        expected = plain_score(network, text)
        assert document_scores(network, [text])[0] == pytest.approx(expected, rel=1e-3)
        assert np.isfinite(network.flat()).all()


def test_texts_are_taken_apart_once_for_training_and_scores(spark, monkeypatch):
    """Texts are read to count their words and once more; scores are those of both steps apart."""
    monkeypatch.setattr(lm_scores, "KNOWN", 0)
    monkeypatch.setattr(lm_scores, "WORDS", CLASSES + 2)
    monkeypatch.setattr(lm_scores, "PAD", CLASSES + 2)
    rows, df = corpus(spark, n=40)
    odd = [(1, None, "x"), (None, "", "x"), (2, "a rare word", "x"), (2, "a rare word", "x")]
    df = df.unionAll(spark.createDataFrame(odd, SCHEMA)).localCheckpoint()
    expected = score_documents(df, *train(df)).collect()
    coded, passes = lm_scores.coded, []
    monkeypatch.setattr(lm_scores, "coded", lambda *given: passes.append(1) or coded(*given))
    found = train_and_score(df).collect()
    assert len(passes) == 1
    key = lambda r: (r["id"] is None, r["id"], r["n_words"])
    for one, two in zip(sorted(found, key=key), sorted(expected, key=key), strict=True):
        assert tuple(one)[:2] == tuple(two)[:2] and one["log_likelihood"] == pytest.approx(two["log_likelihood"], abs=1e-3)


def test_memory_of_words_starts_anew(spark, monkeypatch):
    _, df = corpus(spark, n=60)
    words, total = vocabulary(df.select("text"))
    expected = sorted(map(tuple, score_documents(df, words, Network.new()).collect()))
    monkeypatch.setattr(lm_scores, "REMEMBERED", 2)
    again, same = vocabulary(df.select("text"))
    assert (again, same) == (words, total)
    assert sorted(map(tuple, score_documents(df, words, Network.new()).collect())) == expected


def test_rare_words_are_joined_from_the_coded_texts(spark, monkeypatch):
    """Rows and their rare words are stored once, and go to the join without being counted by row first."""
    monkeypatch.setattr(lm_scores, "KNOWN", 0)
    monkeypatch.setattr(lm_scores, "WORDS", CLASSES + 2)
    monkeypatch.setattr(lm_scores, "PAD", CLASSES + 2)
    stored, store = [], lm_scores.materialize
    monkeypatch.setattr(lm_scores, "materialize", lambda df, name: stored.append(name) or store(df, name))
    _, df = corpus(spark, n=40)
    found = train_and_score(df)
    assert stored == ["words", "shards"]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode(rare" in plan and plan.count("Aggregate [") == 1


def test_words_are_looked_up_once_for_all_texts():
    texts = [None, b"", b" \t", b" a B\x0b\x0cb  a\r\n", b"a", b"\x1c \xc2\xa0a\xc2\x85 \x00 \xc3\x89A \xc3\xa9a", None]
    looked = []

    class Places(lm_scores.WordPlaces):
        def get(self, word, default=None):
            looked.append(word)
            return super().get(word, default)

    places = Places()
    for _ in range(2):
        looked.clear()
        met, numbers, ends = places.of(pa.array([b"cut off", *texts], pa.binary()).slice(1))
        words = list(places)
        got = [[words[p] for p in met[part]] for part in np.split(numbers, ends[:-1])]
        assert got == [(t or b"").lower().split() for t in texts]
        assert len(looked) == len(set(looked)) == len(words) == 7
    assert places.learn().tolist() == lm_scores.word_keys(words).tolist()


def test_shapes_of_words():
    words = [b"abc", b"ab,", b"a,b", b"a1", b"1", b",", b"--", b"\xc3\xa9", b"\xc3\xa9.", b"x" * 30, b"." * 70_000, b"x'"]
    kinds = [0, 1, 3, 2, 2, 1, 3, 0, 1, 0, 3, 3]
    expected = [12 * k + min(len(w), 12) - 1 for k, w in zip(kinds, words)]
    assert lm_scores._shapes(words).tolist() == expected
    assert (lm_scores.word_keys(words) & np.uint64(lm_scores.SHAPE)).tolist() == expected


def test_portions_go_by_the_length_of_texts(monkeypatch):
    monkeypatch.setattr(lm_scores, "PORTION", 10)
    for sizes in ([], [0, 0], [4, 4, 4, 25, None, 1], [30]):
        texts = pa.array([None if n is None else "x" * n for n in sizes], pa.string())
        found = list(lm_scores._portions(iter([pa.RecordBatch.from_arrays([texts], names=["text"])]), 0))
        assert sum((b.column(0).to_pylist() for b in found), []) == texts.to_pylist()
        assert all(len(b) and sum(len(t or "") for t in b.column(0).to_pylist()[1:]) < 10 for b in found)
