"""The numbered operators bound to the given tables: name -> query, name -> SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintagemart.llm.block_names import exact_duplicates
from vintagemart.llm.chat import END, ESCAPE, START, chat_examples, read_loss, read_turns
from vintagemart.llm.decontaminate import leaks
from vintagemart.llm.lm_scores import train_and_score
from vintagemart.llm.merkle import build_manifest, folded, proofs, row_digest, siblings
from vintagemart.llm.ngram_join import jaccard_classes
from vintagemart.llm.packing import pack
from vintagemart.llm.pseudonyms import pseudonymize
from vintagemart.llm.quality import fit, score
from vintagemart.llm.sharding import shard_by_bytes
from vintagemart.llm.token_alignment import align_tokens
from vintagemart.llm.topk import top_k
from vintagemart.llm.wrappers import extract_main_text

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Links of all pairs that share a shingle, and everything that is reachable over them.
OP8_SQL = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (
    SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(words) - 2, 1) + 1),
        lambda i: array_to_string(words[i:i + 2], ' '))) AS shingle FROM w WHERE len(words) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
    FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (
    SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
    WHERE 100 * common >= 90 * (x.n + y.n - common)),
r AS (SELECT doc_id, doc_id AS other FROM w UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.other = l.a)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.other) AS component_id,
       (SELECT count(*) FROM l WHERE l.a = w.doc_id) AS n_links
FROM w LEFT JOIN n USING (doc_id) JOIN r ON r.doc_id = w.doc_id GROUP BY w.doc_id
"""


@query("op8_ngram_jaccard_join", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_classes(table(spark, sf_dir, "documents"), size=3, percent=90)
    return found.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        F.col("component").alias("component_id"),
        F.col("links").alias("n_links"),
    )


WORDS_SQL = """list_filter(string_split(regexp_replace(
    translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-/:-@\\[-`{{-\\x7f]', ' ', 'g'), ' '), lambda w: w <> '')"""
# The distinct runs of five words of a text; all its words if there are fewer.
SHINGLES_SQL = """
    SELECT DISTINCT id, shingle FROM (
        SELECT id, unnest(list_transform(range(1, greatest(len(words) - 4, 1) + 1),
                                         lambda i: array_to_string(words[i:i + 4], ' '))) AS shingle
        FROM (SELECT {0} AS id, {1} AS words FROM {2} WHERE text IS NOT NULL) WHERE len(words) > 0)
"""
OP2_SQL = f"""
WITH d AS ({SHINGLES_SQL.format("doc_id", WORDS_SQL.format("text"), "documents")}),
     b AS ({SHINGLES_SQL.format("item_id", WORDS_SQL.format("text"), "benchmark")}),
     n AS (SELECT id, count(*) AS n FROM b GROUP BY id)
SELECT d.id AS doc_id, b.id AS item_id, max(n.n) AS n_shingles, count(*) AS n_shared,
       count(*)::DOUBLE / max(n.n) AS containment
FROM d JOIN b USING (shingle) JOIN n ON n.id = b.id
GROUP BY d.id, b.id HAVING 100 * count(*) >= 80 * max(n.n)
"""


@query("op2_benchmark_decontamination", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# Whoever runs this on real data passes a secret key of their own.
PSEUDONYM_KEY = b"key of the registered query"


@query("op7_pii_pseudonyms")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymize(docs, PSEUDONYM_KEY, count=True)


def graded(labels: DataFrame) -> DataFrame:
    """Grade 0: toxic, 1: of low quality, 2: neither."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1)
    return labels.where("quality is not null and toxic is not null").select(
        "doc_id", grade.otherwise(2).alias("grade")
    )


@query("op4_quality_classifier")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that are more likely good than not."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, graded(table(spark, sf_dir, "labels")))
    return score(docs, model, grade=2, least=0.5, columns=["doc_id"])


@query("op1_best_fit_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return found.select(
        F.col("id").alias("doc_id"),
        "piece",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "sequence_id",
        "offset",
    )


@query("op5_byte_balanced_shards")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32")
    found = shard_by_bytes(docs.select("doc_id", "text", crc), 16, ["doc_id", "text_crc32"])
    return found.select(
        "doc_id",
        F.col("shard_size").alias("size"),
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


OP3_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS weights FROM embeddings
    WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.weights, c.weights)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@query("op3_exact_top_k", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = top_k(table(spark, sf_dir, "embeddings"), 20, F.col("id") % 20 == 0)
    return found.withColumnRenamed("id", "vec_id")


OP6_SQL = f"""
WITH t AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
f AS (
    SELECT *, {len(START) + len(END) + 2} + length(role)
              + length(regexp_replace(text, '{ESCAPE}', '\\1\\\\\\2\\3', 'g')) AS chars,
           lead(turn) OVER w IS NULL AS is_last
    FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
g AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS total FROM f)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (sum(total) FILTER (role = 'assistant' OR is_last))::BIGINT AS formatted_chars
FROM g GROUP BY conv_id
"""


@query("op6_chat_formatting", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.lit("</s>[INST] ok [/INST]").alias("text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role")
    more = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), role, said)
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    read = chat_examples(turns).select(
        "conv_id",
        "example",
        F.length("formatted").cast("long").alias("chars"),
        read_loss(F.col("formatted"), F.col("loss_start"), F.col("loss_length")).alias("loss"),
        read_turns(F.col("formatted")).alias("turns"),
    )
    losses = "transform(array_sort(collect_list(struct(example, loss))), x -> x.loss)"
    found = read.groupBy("conv_id").agg(
        F.expr(f"array_join({losses}, '')").alias("loss"),
        F.sum("chars").alias("formatted_chars"),
        F.max_by("turns", "example").alias("turns"),
    )
    told = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return found.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query("op10_html_extraction")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_main_text(table(spark, sf_dir, "pages"), ["page_id", "url"])
    return found.withColumn("n_chars", F.length("text").cast("long"))


@query("op9_lm_scores")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train_and_score(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


OP13_SQL = r"""
WITH t AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1 AS kept, sha256(text) AS text_sha256
FROM t WINDOW same AS (PARTITION BY text)
"""


@query("op13_exact_dedup", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


# Node by node: the levels of each tree, the siblings on each level, and a walk from
# every leaf to its tree's root and on to the root of all.
LEAF_SQL = """sha256(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')
    || coalesce(strlen({0}) || ':' || {0}, '-'))"""
NODES_SQL = """
    SELECT tree, 0 AS level, row_number() OVER (PARTITION BY tree ORDER BY {1}) - 1 AS idx,
           count(*) OVER (PARTITION BY tree) AS n, digest FROM {0}
    UNION ALL
    SELECT tree, level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx))
    FROM {2} WHERE n > 1 GROUP BY tree, level, idx // 3, n"""
BESIDE_SQL = """
    SELECT a.tree, a.level, a.idx, coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
           coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
    FROM {0} a JOIN {0} b ON a.tree = b.tree AND a.level = b.level AND a.idx // 3 = b.idx // 3
    WHERE a.n > 1 GROUP BY 1, 2, 3"""
WALK_SQL = """
    SELECT w.doc_id, w.tree, w.level + 1, w.idx // 3, (w.n + 2) // 3, sha256(l || w.acc || r), w.path || l || r
    FROM {0} w JOIN {1} s ON s.tree = w.tree AND s.level = w.level AND s.idx = w.idx WHERE w.n > 1"""
OP12_SQL = f"""
WITH RECURSIVE c AS (
    SELECT *, list_reduce([4294967295::UBIGINT] || list_transform(string_split(doc_id::VARCHAR, ''),
                              lambda x: ascii(x)::UBIGINT),
                          lambda crc, byte: list_reduce([xor(crc, byte)] || list_transform(range(8), lambda i: 0::UBIGINT),
                              lambda a, b: xor(a >> 1, (a & 1) * 3988292384::UBIGINT))) AS crc FROM documents),
d AS (SELECT doc_id, coalesce('=' || source, '') AS tree, {LEAF_SQL.format("text")} AS digest,
             CASE WHEN xor(crc, 4294967295::UBIGINT) % 2 = 0 THEN {LEAF_SQL.format("replace(text, chr(10), '')")}
                  ELSE {LEAF_SQL.format("text")} END AS altered FROM c),
nodes AS ({NODES_SQL.format("d", "doc_id NULLS FIRST, digest", "nodes")}),
subroots AS (SELECT '' AS tree, tree AS name, digest FROM nodes WHERE n = 1),
tops AS ({NODES_SQL.format("subroots", "name", "tops")}),
beside AS ({BESIDE_SQL.format("nodes")}),
beside_tops AS ({BESIDE_SQL.format("tops")}),
walk AS (
    SELECT doc_id, tree, 0 AS level, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS idx,
           count(*) OVER (PARTITION BY tree) AS n, altered AS acc, '' AS path FROM d
    UNION ALL {WALK_SQL.format("walk", "beside")}),
walk_tops AS (
    SELECT w.doc_id, '' AS tree, 0 AS level, s.idx, s.n, w.acc, w.path
    FROM walk w JOIN (SELECT *, row_number() OVER (ORDER BY name) - 1 AS idx, count(*) OVER () AS n FROM subroots) s
      ON s.name = w.tree WHERE w.n = 1
    UNION ALL {WALK_SQL.format("walk_tops", "beside_tops")})
SELECT d.doc_id, d.digest AS leaf, s.digest AS subroot, t.digest AS root, sha256(w.path) AS proof_sha256,
       w.acc AS folded_root, w.acc = t.digest AS verified
FROM d JOIN subroots s ON s.name = d.tree JOIN walk_tops w ON w.doc_id = d.doc_id AND w.n = 1
CROSS JOIN (SELECT digest FROM tops WHERE n = 1) t
"""


@query("op12_merkle_manifest", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row's proof, folded from a row of which line ends may have been lost."""
    told = ["doc_id", "source", "lang", "n_chars"]
    lost = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(lost, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    manifest = build_manifest(
        table(spark, sf_dir, "documents"),
        [*told, "text"],
        carry={"altered": row_digest(*[F.col(c) for c in told], text)},
    )
    root = F.lit(manifest.root).cast("string")
    found = proofs(manifest).withColumn("folded_root", folded(F.col("altered"), F.col("path")))
    return found.select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        root.alias("root"),
        F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )


@query("op11_cross_tokenizer_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    byte, piece = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    found = align_tokens(table(spark, sf_dir, "documents"), byte, piece, as_text=False)
    return found.withColumnsRenamed({"id": "doc_id", "groups": "groups_sha256"})
