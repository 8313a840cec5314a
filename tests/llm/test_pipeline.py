"""The pipeline, stage by stage, against plain versions on whole small tables."""

import pytest
from test_ngram_join import brute
from test_packing import check
from test_decontaminate import shingles as item_shingles

import corpus_pipeline
from vintagemart.llm.pseudonyms import Pseudonymizer
from vintagemart.llm.quality import fit, score
from vintagemart.llm.queries import PSEUDONYM_KEY, graded, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def docs(spark, sf_dir, tmp_path_factory):
    """The given documents with copies, leaks, nulls and empty texts added."""
    given = table(spark, sf_dir, "documents")
    item = table(spark, sf_dir, "benchmark").first()["text"]
    long_text = max((r["text"] for r in given.collect()), key=len)
    more = spark.createDataFrame(
        [
            (10_001, long_text, "en", "src0", 1),
            (10_002, " ".join(long_text.split()[:-3]), "en", "src0", 1),
            (10_003, f"{long_text[: len(long_text) // 2]} {item}", "en", "src1", 1),
            (10_004, None, None, None, None),
            (10_005, "", "en", "src2", 0),
        ],
        given.schema,
    )
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    given.unionByName(more).write.parquet(path)
    return spark.read.parquet(path)


def test_stages_have_the_asked_order():
    assert len(corpus_pipeline.STAGES) == 5
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == [
        "quality", "deduplicate", "decontaminate", "pseudonyms", "packing",
    ]


def test_quality(spark, sf_dir, docs):
    kept = corpus_pipeline.quality(spark, docs, sf_dir)
    assert kept.columns == COLUMNS
    model = fit(docs, graded(table(spark, sf_dir, "labels")))
    chance = {r["doc_id"]: r["tail_probability"] for r in score(docs, model, 2).collect()}
    assert rows_of(kept) == [r for r in rows_of(docs) if chance[r[0]] >= 0.5]
    ids = {r["doc_id"] for r in kept.collect()}
    assert ids and not ids & {10_004, 10_005}


def test_deduplicate(spark, sf_dir, docs):
    kept = corpus_pipeline.deduplicate(spark, docs, sf_dir)
    assert kept.columns == COLUMNS
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    best = {key for key, n, component, _ in brute(rows, 5, 80) if component == key or not n}
    assert rows_of(kept) == [r for r in rows_of(docs) if r[0] in best]
    assert kept.count() < docs.count()


def test_decontaminate(spark, sf_dir, docs):
    kept = corpus_pipeline.decontaminate(spark, docs, sf_dir)
    assert kept.columns == COLUMNS
    items = [item_shingles(r["text"]) for r in table(spark, sf_dir, "benchmark").collect()]

    def leaks(text):
        there = item_shingles(text)
        return any(100 * len(own & there) >= 80 * len(own) for own in items)

    assert rows_of(kept) == [r for r in rows_of(docs) if not leaks(r[1])]
    assert 10_003 not in {r["doc_id"] for r in kept.collect()}


def test_pseudonyms(spark, sf_dir, docs):
    done = corpus_pipeline.pseudonyms(spark, docs, sf_dir)
    assert done.columns == COLUMNS
    rule = Pseudonymizer(PSEUDONYM_KEY)
    expected = []
    for key, text, *rest, _ in rows_of(docs):
        new = rule.text(text)[0]
        expected.append((key, new, *rest, None if new is None else len(new)))
    assert rows_of(done) == sorted(expected, key=repr)


def test_packing(spark, sf_dir, docs):
    rows = corpus_pipeline.packing(spark, docs, sf_dir).withColumnRenamed("doc_id", "id").collect()
    check(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], 2048, True)


def test_whole_run(spark, sf_dir):
    expected = table(spark, sf_dir, "documents")
    for _, stage in corpus_pipeline.STAGES:
        expected = stage(spark, expected, sf_dir)
    key = ["doc_id", "piece", "start", "length"]
    found = corpus_pipeline.run(spark, sf_dir)
    assert found.columns == expected.columns
    assert rows_of(found.select(*key, "ids")) == rows_of(expected.select(*key, "ids"))
    assert corpus_pipeline.ORACLE_SQL is None


def test_empty_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0


def test_stages_release_what_they_wrote(spark, tmp_path):
    from vintagemart.sources.scratch import in_use, materialize

    @corpus_pipeline.staged
    def stage(spark, docs, sf_dir):
        return materialize(docs.withColumn("x", docs.id + 1), "of-a-stage").drop("x")

    docs = spark.range(10)
    first = stage(spark, docs, "")
    mine = [p for p in in_use() if "of-a-stage" in p][-1]
    # Not stored yet: the next stage reads it, so it stays.
    second = stage(spark, first, "")
    assert mine in in_use() and second.count() == 10
    second.write.parquet(str(tmp_path / "second"))
    own = [p for p in in_use() if "of-a-stage" in p][-1]
    third = stage(spark, spark.read.parquet(str(tmp_path / "second")), "")
    assert own not in in_use() and third.count() == 10
