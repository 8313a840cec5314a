"""Alignment: tokens, groups and counts beside the libraries text by text."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from vintagemart.llm.queries import QUERIES
from vintagemart.llm.token_alignment import Aligner, align_tokens, byte_of_letter

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
BYTES = byte_of_letter()


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def tokens(libraries, text):
    """(id, bytes) of each token of A and of B."""
    a, b = libraries
    found = a.encode(" " + text, add_special_tokens=False)
    of_a = [(i, bytes(BYTES[c] for c in a.id_to_token(i))) for i in found.ids]
    of_b = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        of_b.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    return of_a, of_b


def aligned(libraries, text):
    """Groups as lists of ids of A and of B; None without tokens."""
    if not text:
        return None
    of_a, of_b = tokens(libraries, text)
    whole = (" " + text).encode()
    if any(b"".join(t for _, t in side) != whole for side in (of_a, of_b)):
        return None
    ends = [{}, {}]
    for side, found in zip(ends, (of_a, of_b)):
        at = 0
        for k, (_, t) in enumerate(found):
            at += len(t)
            side[at] = k + 1
    groups, i, j = [], 0, 0
    for end in sorted(set(ends[0]) & set(ends[1])):
        groups.append(([x for x, _ in of_a[i : ends[0][end]]], [x for x, _ in of_b[j : ends[1][end]]]))
        i, j = ends[0][end], ends[1][end]
    return groups


def plain(libraries, texts):
    """The rows that a plain reading of the definitions gives."""
    found = [(i, aligned(libraries, t)) for i, t in texts]
    links = [(i, g, Counter((a, b) for x, y in g or [] for a in x for b in y)) for i, g in found]
    counts = Counter(pair for _, _, pairs in links for pair in pairs)
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(n, best.get(a, 0))
    out = []
    for i, g, pairs in links:
        told = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g or [])
        out.append(
            (
                i,
                sum(len(x) for x, _ in g or []),
                sum(len(y) for _, y in g or []),
                len(g or []),
                sum(pairs.values()),
                sum(n for p, n in pairs.items() if counts[p] == best[p[0]]),
                sum(n * counts[p] for p, n in pairs.items()),
                told,
            )
        )
    return out


ODD = [
    "", " ", "  ", "\n", " a", "a ", "a  b", "a\n\nb  \n", "don't I'LL 'tis rock'n'roll", "x  y", "x  y \n z",
    "x\r\n\r\ny);\r\n", "\x00\x01 a\x1f b\x0b\x0cc", "<|endoftext|> <s>a</s><unk><0x41>", "x▁y ▁ z", "a▁",
    "été, l’homme”, «non» — ça… 漢字かな交じり文, 😀😀! 🇩🇪 é́é", "1,234.56 3.14abc 12ab34 ². x²y ½.", "ＡＢＣ ﬁ ① ٣٤ ४५",
    "a" * 3000, "漢" * 400, "ab1" * 500, "=" * 900, "​​word​, ﻿x", "the the the", "é. ö!x",
]


def some_texts():
    rng = random.Random(3)
    marks = [" ", "\n", "  ", "\t", ".", ", ", "'", "'s ", "é", "ß", "”", "’", " ", " ", "1", "20", "漢", "😀", "\r\n", "-"]
    words = ["the", "The", "naïve", "word", "x", "HTML", "übung", "́", "ﬁn", "don", "t", "re"]
    texts = list(ODD)
    for _ in range(400):
        texts.append("".join(rng.choice(words if rng.random() < 0.5 else marks) for _ in range(rng.randint(1, 30))))
    return texts


def test_forms_are_cut_where_no_token_crosses(libraries):
    aligner = Aligner(A, B)
    assert aligner.by_forms
    texts = some_texts()
    numbers = aligner.numbers([t.encode() for t in texts])
    for text, found in zip(texts, numbers):
        groups = aligned(libraries, text)
        told = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups or [])
        assert b";".join(aligner.groups.texts[n] for n in found).decode() == told, text


def test_spans_are_those_of_the_bytes(libraries):
    aligner = Aligner(A, B)
    for text in some_texts():
        found = aligner.tokens(" " + text) if text else None
        if found is None:
            assert aligned(libraries, text) is None
            continue
        for (ids, ends), side in zip((found[:2], found[2:]), tokens(libraries, text)):
            at, expected = 0, []
            for _, t in side:
                at += len(t)
                expected.append(at)
            assert ids.tolist() == [i for i, _ in side] and ends.tolist() == expected, text


@pytest.mark.parametrize("common", [1 << 20, 40, 0])
def test_same_rows_as_text_by_text(spark, libraries, common):
    texts = [(i, t) for i, t in enumerate(some_texts())]
    texts += [(None, "null id"), (5000, None), (5001, "twice"), (5001, "twice"), (5001, "other row")]
    df = spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id long, text string, row string").repartition(4)
    found = sorted(map(repr, map(tuple, align_tokens(df, A, B, common=common).collect())))
    assert found == sorted(map(repr, plain(libraries, texts)))


def test_long_runs_without_a_common_cut(libraries):
    aligner = Aligner(A, B)
    a, b = list(range(300)) * 2, list(range(10, 260))
    ends = 1000
    found = tuple(map(__import__("numpy").array, (a, range(1, 601), b, range(700, 950))))
    found[1][-1] = found[3][-1] = ends
    aligner._add([b"x" * ends], found)
    facts = aligner.groups.facts[0]
    assert facts[:4].tolist() == [600, 250, 1, 150_000] and facts[7] == 75_000
    pairs = aligner.groups.pairs[: facts[7]]
    assert pairs[:, 1].tolist() == [2] * 75_000 and pairs[0, 0] == 10 and pairs[-1, 0] == 299 * 32000 + 259


def test_query_keeps_its_contract(spark, sf_dir, libraries):
    df = QUERIES["op11_cross_tokenizer_alignment"](spark, sf_dir)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert df.columns == names
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    rows = plain(libraries, [(r["doc_id"], r["text"]) for r in docs])
    expected = [(*r[:7], hashlib.sha256(r[7].encode()).hexdigest() if r[3] else "") for r in rows]
    assert sorted(map(tuple, df.collect())) == sorted(expected)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert align_tokens(df, A, B).collect() == []
