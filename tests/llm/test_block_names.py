"""Exact duplicates: every group, beside a dictionary of normalised texts."""

import hashlib
import random
import re

import pytest

from vintagemart.llm.block_names import document_names, exact_duplicates, without_duplicates

SCHEMA = "doc_id long, text string, name string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA).repartition(3)


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def check(rows, texts):
    groups = {}
    for i, t in texts:
        groups.setdefault(plain(t), []).append(i)
    shas = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    assert len(rows) == len(texts)
    kept = {}
    for r in rows:
        ids = shas[r["text_sha256"]]
        assert r["group_size"] == len(ids)
        known = [i for i in ids if i is not None]
        assert r["keep_id"] == (min(known) if known else None)
        kept[r["text_sha256"]] = kept.get(r["text_sha256"], 0) + r["kept"]
        if r["kept"]:
            assert r["id"] == r["keep_id"]
    assert set(kept.values()) <= {1} and len(kept) == len(groups)


def some_texts():
    rng = random.Random(5)
    words = ["a", "b", "é", "漢字", "\t", " \n", "\x0b", " ", "x" * 9]
    texts = [(i, " ".join(rng.choices(words, k=rng.choice([1, 2, 3, 40])))) for i in range(250)]
    texts += [(500 + i, "copy of a text that many rows hold " * 5) for i in range(150)]
    texts += [(700, None), (701, ""), (702, " \t "), (703, " "), (None, None), (None, "only null"), (9, "nine")]
    texts += [(9, "nine"), (9, "nine "), (800, "y" * 5000), (801, "y" * 5000), (802, "y" * 5001)]
    # Blocks in another order, and the same blocks one more time.
    return texts + [(803, "ab" * 8 + "cd" * 8), (804, "cd" * 8 + "ab" * 8), (805, "ab" * 16), (806, "ab" * 8)]


@pytest.mark.parametrize(("block", "bits"), [(16, 64), (7, 2), (1024, 64)])
def test_same_groups_as_a_dictionary(spark, block, bits):
    texts = some_texts()
    check(exact_duplicates(frame(spark, texts), block_bytes=block, hash_bits=bits).collect(), texts)


def test_names_are_free_of_collisions_with_weak_keys(spark):
    texts = [(i, f"{i:05d}" * 3) for i in range(300)]
    rows = document_names(frame(spark, texts), block_bytes=4, hash_bits=1).collect()
    assert len({(r["round"], r["name"]) for r in rows}) == 300


def test_empty_table_names_and_errors(spark):
    df = frame(spark, [(1, "a"), (2, "a"), (3, "b")])
    assert exact_duplicates(df.limit(0)).collect() == []
    assert sorted(without_duplicates(df).select("doc_id", "name").collect()) == [(1, "x"), (3, "x")]
    other = df.withColumnRenamed("name", "row").withColumn("n", df.doc_id).withColumn("key0", df.doc_id)
    assert exact_duplicates(other).count() == 3
    with pytest.raises(ValueError):
        exact_duplicates(df, block_bytes=0)
