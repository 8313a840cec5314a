"""Containment search against exact sets, and the query beside its SQL."""

import random

import pytest
from oracle import connect, differences

from vintagemart.llm import decontaminate
from vintagemart.llm.decontaminate import leaks, plain_words, without_leaks
from vintagemart.llm.queries import ORACLES, QUERIES

DOCS = "doc_id long, text string, item_id string"
ITEMS = "item_id long, text string, doc_id string"


def shingles(text, size=5):
    words = plain_words(text).split()
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*[words[i:] for i in range(size)]))


def brute(docs, items):
    out = []
    for doc, text in docs:
        there = shingles(text)
        for item, own in items:
            own = shingles(own)
            shared = len(own & there)
            if own and 100 * shared >= 80 * len(own):
                out.append((doc, item, len(own), shared, shared / len(own)))
    return sorted(out, key=repr)


def fixture(seed=2):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(200)}"
    items = [(i, " ".join(word() for _ in range(rng.randrange(3, 60)))) for i in range(40)]
    items += [(100, None), (101, ""), (102, "..."), (103, "two words"), (1, items[1][1]), (None, items[2][1])]
    docs = []
    for i in range(120):
        text = [word() for _ in range(rng.randrange(0, 400))]
        if i % 2:
            own = items[rng.randrange(40)][1].split()
            for _ in range(rng.randrange(3)):
                own[rng.randrange(len(own))] = "other"
            at = rng.randrange(len(text) + 1)
            text[at:at] = own
        docs.append((i, " ".join(text)))
    docs += [(200, None), (201, ""), (202, "Two, WORDS!"), (1, docs[1][1]), (None, docs[3][1])]
    docs.append((300, " ".join(word() for _ in range(30_000)) + " " + items[7][1].upper()))
    return docs, items


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(i, t, "x") for i, t in docs], DOCS),
        spark.createDataFrame([(i, t, "x") for i, t in items], ITEMS),
    )


@pytest.mark.parametrize("chars", [16_000_000, 500])
def test_as_brute_force(spark, monkeypatch, chars):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", chars)
    docs, items = fixture()
    d, b = frames(spark, docs, items)
    found = sorted((tuple(r) for r in leaks(d, b).collect()), key=repr)
    assert found == brute(docs, items)
    assert found
    bad = {text for doc, text in docs if any(r[0] == doc for r in brute([(doc, text)], items))}
    kept = without_leaks(d, b)
    assert kept.columns == d.columns
    expected = sorted(((i, t, "x") for i, t in docs if t not in bad), key=repr)
    assert sorted((tuple(r) for r in kept.collect()), key=repr) == expected


def test_empty_tables(spark):
    docs, items = fixture()
    d, b = frames(spark, docs, items)
    assert leaks(d.limit(0), b).count() == 0
    assert leaks(d, b.limit(0)).count() == 0
    assert without_leaks(d, b.limit(0)).count() == len(docs)


def test_query_as_sql(spark, sf_dir):
    name = "op2_benchmark_decontamination"
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) is None
