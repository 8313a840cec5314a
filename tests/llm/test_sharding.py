"""Shards: near equal bytes, contiguous slots, whole groups, stored files."""

import zlib

import pytest

from vintagemart.llm.queries import QUERIES
from vintagemart.llm.sharding import shard_by_bytes, write_shards

SCHEMA = "doc_id long, text string, size string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA).repartition(3)


def check(rows, texts, shards):
    """Size law, gapless slots, one row per document."""
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in rows) == sorted(
        (i is None, i or 0, t or "") for i, t in texts
    )
    total, largest = sum(r["shard_size"] for r in rows), max(r["shard_size"] for r in rows)
    for shard in range(shards):
        own = [r for r in rows if r["shard"] == shard]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        assert abs(sum(r["shard_size"] for r in own) - total / shards) <= 2 * largest
    assert all(r["shard_size"] == len((r["text"] or "").encode()) + 1 for r in rows)


def test_bytes_law_with_groups(spark):
    texts = [(i, f"text {i} " + "é" * (i % 50)) for i in range(400)]
    # A third of all rows is one text; some are pairs; one is very long.
    texts += [(1000 + i, "the common text of many rows") for i in range(200)]
    texts += [(2000 + i, f"pair {i // 2}") for i in range(60)] + [(3000, "long " * 400)]
    texts += [(None, None), (None, "null id"), (5, None), (6, ""), (7, "seven"), (7, "seven")]
    rows = shard_by_bytes(frame(spark, texts), 7, ["doc_id", "text"]).collect()
    check(rows, texts, 7)
    of = {}
    for r in rows:
        of.setdefault(r["text"], []).append(r["shard"])
    largest = max(r["shard_size"] for r in rows)
    for text, shards in of.items():
        if text is not None and len(shards) * (len(text.encode()) + 1) <= largest:
            assert len(set(shards)) == 1
    assert len(set(of["the common text of many rows"])) > 1


def test_few_rows_names_and_errors(spark):
    df = frame(spark, [(1, "a"), (2, "b")])
    assert {r["shard"] for r in shard_by_bytes(df, 5, ["doc_id"]).collect()} <= set(range(5))
    out = shard_by_bytes(df.withColumnRenamed("size", "part"), 2, ["part", "doc_id"])
    assert out.columns == ["part", "doc_id", "shard_size", "shard", "slot"]
    assert shard_by_bytes(df.limit(0), 4, ["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        shard_by_bytes(df, 0, ["doc_id"])
    with pytest.raises(ValueError):
        shard_by_bytes(df.withColumnRenamed("size", "slot"), 2, ["slot"])


def test_files(spark, tmp_path):
    texts = [(i, f"text {i}") for i in range(100)]
    sharded = shard_by_bytes(frame(spark, texts), 4, ["doc_id", "text"])
    write_shards(sharded, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out")).collect()
    check(back, texts, 4)
    assert len(list((tmp_path / "out").glob("shard=*"))) == 4


def test_query_keeps_its_contract(spark, sf_dir):
    df = QUERIES["op5_byte_balanced_shards"](spark, sf_dir)
    assert df.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = df.collect()
    assert len(rows) == len(docs)
    for r in rows:
        text = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(text) + 1, zlib.crc32(text))
        assert r["law"] == "bytes" and r["grown_shard"] is None
    total = sum(r["size"] for r in rows)
    for shard in range(16):
        own = [r for r in rows if r["shard"] == shard]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / 16) <= 2 * max(r["size"] for r in rows)


def test_groups_across_partitions_without_a_task_per_group(spark):
    # More range partitions than groups: most groups go on in another partition.
    texts = [(i, f"group {i // 9}") for i in range(90)] + [(200, "long " * 40), (201, None)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        placed = shard_by_bytes(frame(spark, texts), 5, ["doc_id", "text"])
        plan = placed._jdf.queryExecution().sparkPlan().toString()
        rows = placed.collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    check(rows, texts, 5)
    of = {}
    for r in rows:
        of.setdefault(r["text"], set()).add(r["shard"])
    assert all(len(shards) == 1 for shards in of.values())
    assert "SortMergeJoin" not in plan
