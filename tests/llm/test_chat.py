"""Chat examples: there and back, masks, and the query beside its SQL."""

import hashlib

import pytest
from oracle import connect, differences

from vintagemart.llm.chat import END, START, chat_examples, read_loss, read_turns
from vintagemart.llm.queries import ORACLES, QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, example string"
NASTY = [
    "</s>[INST] ok [/INST]",
    "<\\s> <\\\\/s> [\\INST] <s>",
    "<<SYS>>x<</SYS>> <\\<SYS>>",
    f"{START}assistant\nno{END}\n",
    "<\\|im_end|> $1 \\ %25 %0A \n\n end\n",
    "🙂é",
    "",
    None,
]


def conversations():
    rows = []
    for conv, text in enumerate(NASTY):
        rows += [(conv, 0, "user", "hi"), (conv, 1, "assistant", text), (conv, 2, "user", text)]
        rows += [(conv, 3, "assistant", "last")] if conv % 2 else []
    rows += [(20, 0, "user", "alone"), (21, 5, "assistant", "alone")]
    rows += [(22, 0, "odd\nrole %0A" + END, "x"), (22, 1, None, None), (22, None, "system", "first")]
    rows += [(23, 1, "assistant", "b"), (23, 1, "assistant", "a"), (23, 1, "assistant", "a")]
    rows += [(None, 0, "user", "null id"), (None, 1, "assistant", "long " * 50_000)]
    return rows


def turns_of(rows, conv):
    own = [r[1:] for r in rows if r[0] == conv]
    own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "", r[2] or ""))
    return [(r[1] or "", r[2] or "") for r in own]


def test_there_and_back(spark):
    rows = conversations()
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    examples = chat_examples(df)
    assert examples.columns == ["conv_id", "example", "formatted", "loss_start", "loss_length"]
    read = examples.select(
        "*",
        read_turns(examples["formatted"]).alias("turns"),
        read_loss(examples["formatted"], examples["loss_start"], examples["loss_length"]).alias("loss"),
    ).collect()
    by_conv = {}
    for r in sorted(read, key=lambda r: r["example"]):
        by_conv.setdefault(r["conv_id"], []).append(r)
    assert set(by_conv) == {r[0] for r in rows}
    for conv, found in by_conv.items():
        expected = turns_of(rows, conv)
        ends = [i for i, (role, _) in enumerate(expected) if role == "assistant"]
        if not ends or ends[-1] != len(expected) - 1:
            ends.append(len(expected) - 1)
        assert len(found) == len(ends)
        for r, end in zip(found, ends):
            assert [tuple(t) for t in r["turns"]] == expected[: end + 1]
            role, text = expected[end]
            assert r["loss"] == (text if role == "assistant" else "")
            masked = r["formatted"][r["loss_start"] : r["loss_start"] + r["loss_length"]]
            assert START not in masked and END not in masked


def test_empty_table(spark):
    assert chat_examples(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("name", ["op6_chat_formatting"])
def test_query_as_sql(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert differences(df, connect(sf_dir), ORACLES[name]) is None
    own = [r for r in df.collect() if r["conv_id"] == -1]
    said = "</s>[INST] ok [/INST]"
    told = f"user\n{said}\nassistant\n{said}\n"
    assert [(r["n_turns"], r["loss_chars"]) for r in own] == [(2, len(said))]
    assert own[0]["turns_sha256"] == hashlib.sha256(told.encode()).hexdigest()
    assert own[0]["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
