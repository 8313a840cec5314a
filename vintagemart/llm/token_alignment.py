"""Alignment of two tokenizers over the same texts, with corpus-wide link counts.

A text with a space before it is encoded by a byte-level tokenizer (A) and by a piece
model with byte fallback (B). Both libraries report spans: A character offsets, B the
spans of its proto. They are coarse cuts: tokens that split a multibyte character all
report that character, and byte-fallback tokens report nothing until the last one.
Such runs are refined with the tokens' decoded bytes. Byte offsets where tokens of both
end cut them into groups; tokens of A and B that share a group are linked.

Words repeat, so texts are cut into forms at places that no token of either crosses,
and each worker remembers the groups of a form; a text with a place that isn't safe is
one form. A pair of ids is one number. Each document keeps its distinct pairs, which
are counted over all documents; the most frequent ones, a fixed number, go to the tasks
as sorted arrays, and links of all other pairs look their counts up in a join.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Callable, Iterator
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagemart.llm.worker import per_worker
from vintagemart.sources.scratch import materialize

# White space, then neither letters nor bytes of wide characters, then only these.
FORM = re.compile(rb"[ \n\t]*[^A-Za-z \n\t\x80-\xff]*[A-Za-z\x80-\xff]*")
BLANKS = b" \n\t"
# Beyond this a form is rare: its text is encoded as a whole.
LONGEST_FORM = 512
# A worker forgets its forms beyond so many, or so many bytes of their groups.
FORMS = 400_000
FORM_BYTES = 48 << 20
# Bytes of text, and rows, that are worked on together.
TEXT_BYTES, ROWS = 1 << 20, 512
# Pairs whose counts go to every task, 16 bytes each; all others are joined.
COMMON = 1 << 20
# Pairs that a task counts before it hands the counts over.
COUNTED = 1 << 21


def byte_of_letter() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable Latin-1
    bytes stand for themselves, the others are numbered from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def refined_ends(starts: np.ndarray, ends: np.ndarray, lengths: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """Byte ends of tokens from coarse byte spans and decoded lengths. ``joined`` marks
    tokens whose span doesn't tell them from the one before; such a run begins where its
    first span does, and its cuts follow from the lengths."""
    total = np.cumsum(lengths)
    first = np.maximum.accumulate(np.where(joined, 0, np.arange(len(starts))))
    return np.where(
        joined | np.append(joined[1:], False), starts[first] + total - (total[first] - lengths[first]), ends
    )


class Groups:
    """Counts, link pairs and group texts of forms, by the form's number."""

    def __init__(self) -> None:
        self.index: dict[bytes, int] = {}
        self.texts: list[bytes] = []
        self.text_bytes = 0
        # Per form: tokens of A and B, groups, links, how it may end, whether it is
        # valid, and the first of its pairs and their number.
        self.facts = np.zeros((1024, 8), np.int64)
        self.pairs = np.zeros((4096, 2), np.uint32)
        self.pairs_used = 0

    def _room(self, forms: int, pairs: int) -> None:
        while len(self.texts) + forms > len(self.facts):
            self.facts = np.concatenate([self.facts, np.zeros_like(self.facts)])
        while self.pairs_used + pairs > len(self.pairs):
            self.pairs = np.concatenate([self.pairs, np.zeros_like(self.pairs)])

    def add(self, forms: list[bytes], texts: list[bytes], facts: np.ndarray, pairs: np.ndarray) -> None:
        """``facts`` without the first pair; pairs stand in the order of forms."""
        self._room(len(forms), len(pairs))
        at, used = len(self.texts), self.pairs_used
        rows = self.facts[at : at + len(forms)]
        rows[:, :6] = facts[:, :6]
        rows[:, 6] = used + np.cumsum(facts[:, 6]) - facts[:, 6]
        rows[:, 7] = facts[:, 6]
        self.pairs[used : used + len(pairs)] = pairs
        self.pairs_used += len(pairs)
        self.texts += texts
        self.text_bytes += sum(map(len, texts)) + sum(map(len, forms))
        self.index.update(zip(forms, range(at, at + len(forms))))


class Aligner:
    def __init__(self, byte_path: str, piece_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        letters = byte_of_letter()
        self.a_bytes = [b""] * (max(self.a.get_vocab().values()) + 1)
        for token, i in self.a.get_vocab().items():
            known = all(c in letters for c in token)
            self.a_bytes[i] = bytes(letters[c] for c in token) if known else token.encode()
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            byte = self.b.is_byte(i)
            self.b_bytes.append(bytes([int(piece[1:-1], 16)]) if byte else piece.replace("▁", " ").encode())
        self.a_sizes = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(t) for t in self.b_bytes], np.int64)
        self.a_texts = [str(i).encode() for i in range(len(self.a_bytes))]
        self.b_texts = [str(i).encode() for i in range(len(self.b_bytes))]
        self.by_forms = self._forms_are_safe(byte_path)
        self.groups = Groups()

    def _forms_are_safe(self, byte_path: str) -> bool:
        """Whether no token of B goes on behind a letter with something else, or holds a
        blank behind another character, and A cuts words by its usual pattern."""
        import json

        with open(byte_path, encoding="utf-8") as file:
            told = json.load(file)
        cut = told.get("pre_tokenizer") or {}
        usual = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        if not usual or told.get("normalizer"):
            return False
        for i in range(self.b.get_piece_size()):
            if self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i):
                continue
            piece = self.b.id_to_piece(i)
            if "\n" in piece or "\t" in piece or "▁" in piece.lstrip("▁"):
                return False
            kinds = [unicodedata.category(c)[0] == "L" for c in piece]
            if any(x and not y for x, y in zip(kinds, kinds[1:])):
                return False
        return True

    def _tokens_a(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and byte ends from character offsets."""
        found = self.a.encode(text, add_special_tokens=False)
        ids = np.array(found.ids, np.int64)
        spans = np.array(found.offsets, np.int64).reshape(-1, 2)
        if text.isascii():
            starts, ends = spans[:, 0], spans[:, 1]
        else:
            code = np.frombuffer(text.encode("utf-32-le"), "<u4")
            width = 1 + (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000)
            at = np.append(0, np.cumsum(width))
            starts, ends = at[spans[:, 0]], at[spans[:, 1]]
        joined = np.append(False, spans[1:, 0] < spans[:-1, 1])[: len(ids)]
        return ids, refined_ends(starts, ends, self.a_sizes[ids], joined)

    def _tokens_b(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and byte ends in the text with a space before it, from proto spans."""
        found = [(p.id, p.begin, p.end) for p in self.b.encode(text, return_type="proto").pieces]
        ids, starts, ends = np.array(found, np.int64).reshape(-1, 3).T
        # An empty span belongs to the token that follows; the first one is the space.
        joined = np.append(False, starts[:-1] == ends[:-1])[: len(ids)]
        starts = np.where(starts > 0, starts + 1, 0)
        return ids, refined_ends(starts, ends + 1, self.b_sizes[ids], joined)

    def tokens(self, form: str) -> tuple | None:
        """(ids and byte ends of A, of B), or None if either's bytes differ from the form."""
        a, a_ends = self._tokens_a(form)
        if form.startswith(" ") and form != " ":
            b, b_ends = self._tokens_b(form[1:])
        else:
            # The space and the line end are tokens of their own.
            b, b_ends = self._tokens_b("\n" + form)
            b, b_ends = b[2:], b_ends[2:] - 2
        data = form.encode()
        for ids, known in ((a, self.a_bytes), (b, self.b_bytes)):
            if b"".join(map(known.__getitem__, ids.tolist())) != data:
                return None
        return a, a_ends, b, b_ends

    def _tail(self, form: bytes) -> int:
        """0: any form may follow, 1: only one that begins with a blank, 2: none."""
        last = form[-1]
        if last < 0x80:
            letter = 65 <= last <= 90 or 97 <= last <= 122
            return 0 if letter else 2 if last <= 32 else 1
        last = form[-4:].decode(errors="ignore")[-1]
        kind = unicodedata.category(last)
        return 0 if kind[0] == "L" else 2 if last.isspace() or kind[0] in "ZC" else 1

    def _add(self, forms: list[bytes], found: tuple) -> None:
        """Learn forms from the tokens of all of them joined."""
        a, a_ends, b, b_ends = found
        form_ends = np.cumsum([len(f) for f in forms])
        cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
        of_a, of_b = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
        form = np.searchsorted(form_ends, cuts)
        n_a, n_b = np.bincount(of_a, minlength=len(cuts)), np.bincount(of_b, minlength=len(cuts))
        facts = np.zeros((len(forms), 7), np.int64)
        for k, values in enumerate((n_a, n_b, np.ones(len(cuts), np.int64), n_a * n_b)):
            np.add.at(facts[:, k], form, values)
        facts[:, 4] = [self._tail(f) for f in forms]
        facts[:, 5] = 1

        keyed = self._pairs(a, b, of_a, n_a, n_b, form)
        facts[:, 6] = np.bincount((keyed[:, 0] >> np.uint64(32)).astype(np.int64), minlength=len(forms))
        pairs = keyed.copy()
        pairs[:, 0] &= np.uint64(0xFFFFFFFF)

        # A's ids of a group, then B's, each with the mark that follows it.
        a_more = np.append(of_a[1:] == of_a[:-1], False)
        b_more = np.append(of_b[1:] == of_b[:-1], False)
        last = np.append(form[1:] != form[:-1], True)[of_b]
        told = [self.a_texts[i] + (b"," if m else b"|") for i, m in zip(a.tolist(), a_more.tolist())]
        told += [
            self.b_texts[i] + (b"," if m else b"" if e else b";")
            for i, m, e in zip(b.tolist(), b_more.tolist(), last.tolist())
        ]
        order = np.argsort(np.concatenate([2 * of_a, 2 * of_b + 1]), kind="stable").tolist()
        told = [told[i] for i in order]
        stops = np.cumsum(facts[:, 0] + facts[:, 1]).tolist()
        texts = [b"".join(told[i:j]) for i, j in zip([0, *stops], stops)]
        self.groups.add(forms, texts, facts, pairs.astype(np.uint32))

    def _pairs(self, a, b, of_a, n_a, n_b, form) -> np.ndarray:
        """(form and pair as one number, links), ascending: the pairs of each form."""
        a_start, b_start = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        large = n_a * n_b > 1 << 16
        out = []
        # All links of usual groups, one by one.
        tokens = np.flatnonzero(~large[of_a])
        times = n_b[of_a[tokens]]
        token = np.repeat(tokens, times)
        at = np.arange(len(token)) - np.repeat(np.cumsum(times) - times, times)
        group = of_a[token]
        pair = a[token] * len(self.b_bytes) + b[b_start[group] + at]
        out.append((form[group] << 32 | pair, np.ones(len(pair), np.int64)))
        # Long runs without a common cut: their distinct ids, with products of counts.
        for g in np.flatnonzero(large).tolist():
            x, x_times = np.unique(a[a_start[g] : a_start[g] + n_a[g]], return_counts=True)
            y, y_times = np.unique(b[b_start[g] : b_start[g] + n_b[g]], return_counts=True)
            pair = (x[:, None] * len(self.b_bytes) + y).ravel()
            out.append((form[g] << 32 | pair, (x_times[:, None] * y_times).ravel()))
        return summed(np.concatenate([k for k, _ in out]), np.concatenate([t for _, t in out]))

    def _learn(self, forms: set[bytes]) -> None:
        together = [f for f in forms if f[0] in BLANKS and b"\xe2\x96\x81" not in f and self._tail(f) < 2]
        for start in range(0, len(together), 4096):
            part = together[start : start + 4096]
            # Forms that begin with a blank follow each other as they would in a text.
            text = b"".join(part).decode()
            found = self.tokens(text if text[0] == " " else " " + text)
            if found and text[0] != " ":
                found = self._without_space(found)
            if found is None:
                for form in part:
                    self._learn_alone(form)
            else:
                self._add(part, found)
        for form in forms.difference(together):
            self._learn_alone(form)

    def _without_space(self, found: tuple) -> tuple | None:
        a, a_ends, b, b_ends = found
        if a_ends[0] != 1 or b_ends[0] != 1:
            return None
        return a[1:], a_ends[1:] - 1, b[1:], b_ends[1:] - 1

    def _learn_alone(self, form: bytes) -> None:
        found = self.tokens(form.decode())
        if found is not None and len(found[0]):
            self._add([form], found)
        else:
            # Not valid: no text that holds it has tokens.
            self.groups.add([form], [b""], np.array([[0, 0, 0, 0, self._tail(form), 0, 0]]), np.zeros((0, 2), np.uint32))

    def _forms(self, text: bytes) -> list[bytes]:
        if not text:
            return []
        if not self.by_forms:
            return [b" " + text]
        forms = FORM.findall(b" " + text)
        if not forms[-1]:
            forms.pop()
        return forms if max(map(len, forms)) <= LONGEST_FORM else [b" " + text]

    def numbers(self, texts: list[bytes]) -> list[list[int]]:
        """The forms of each text, as numbers of ``groups``; none if it has no tokens."""
        if len(self.groups.texts) > FORMS or self.groups.text_bytes > FORM_BYTES:
            self.groups = Groups()
        forms = [self._forms(t) for t in texts]
        out = self._numbered(forms)
        whole = [k for k, numbers in enumerate(out) if not self._safe(forms[k], numbers)]
        for k, numbers in zip(whole, self._numbered([[b" " + texts[k]] for k in whole])):
            out[k] = numbers
        valid = self.groups.facts[:, 5]
        return [n if n and valid[n].all() else [] for n in out]

    def _numbered(self, forms: list[list[bytes]]) -> list[list[int]]:
        get = self.groups.index.get
        out = [list(map(get, f)) for f in forms]
        new = {f for words, found in zip(forms, out) if None in found for f, i in zip(words, found) if i is None}
        if new:
            self._learn(new)
            out = [list(map(get, f)) if None in found else found for f, found in zip(forms, out)]
        return out

    def _safe(self, forms: list[bytes], numbers: list[int]) -> bool:
        tails = self.groups.facts[numbers[:-1], 4]
        if not tails.any():
            return True
        at = np.flatnonzero(tails).tolist()
        return all(tails[k] == 1 and forms[k + 1][0] in BLANKS for k in at)


def summed(keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """(key, sum of its values), ascending, as unsigned 64-bit numbers."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    sums = np.add.reduceat(values, first) if len(keys) else values
    return np.stack([keys[first].astype(np.uint64), sums.astype(np.uint64)], axis=1)


def _chunks(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of a bounded number of rows and bytes (or one row)."""
    sizes = np.array(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0), np.int64)
    start, held = 0, 0
    for k, size in enumerate(sizes.tolist()):
        if k > start and (held + size > TEXT_BYTES or k - start >= ROWS):
            yield batch.slice(start, k - start)
            start, held = k, 0
        held += size
    if start < len(batch):
        yield batch.slice(start)


def _aligned(byte_path: str, piece_path: str, as_text: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = per_worker(f"aligner:{byte_path}:{piece_path}", lambda: Aligner(byte_path, piece_path))
        for batch in batches:
            for part in _chunks(batch, 2):
                texts = [t or b"" for t in part.column(2).cast(pa.binary()).to_pylist()]
                numbers = aligner.numbers(texts)
                groups = aligner.groups
                told = [b";".join(map(groups.texts.__getitem__, n)) for n in numbers]
                if not as_text:
                    told = [sha256(t).hexdigest().encode() if n else b"" for t, n in zip(told, numbers)]
                each = np.fromiter(chain.from_iterable(numbers), np.int64)
                doc = np.repeat(np.arange(len(texts)), [len(n) for n in numbers])
                facts = groups.facts[each]
                totals = np.zeros((len(texts), 4), np.int64)
                for k in range(4):
                    totals[:, k] = np.bincount(doc, facts[:, k], len(texts))
                pairs = _document_pairs(groups, doc, each)
                of = (pairs[:, 0] >> np.uint64(32)).astype(np.int64)
                keys, links = pairs[:, 0].astype("<u4"), pairs[:, 1].astype("<u4")
                stops = 4 * np.append(0, np.cumsum(np.bincount(of, minlength=len(texts))))
                arrays = [part.column(0), part.column(1)]
                arrays += [pa.array(totals[:, k]) for k in range(4)]
                arrays.append(pa.array(told, pa.binary()).cast(pa.string()))
                for values in (keys, links):
                    data = [pa.py_buffer(stops.astype(np.int32)), pa.py_buffer(values.tobytes())]
                    arrays.append(pa.Array.from_buffers(pa.binary(), len(texts), [None, *data]))
                yield pa.RecordBatch.from_arrays(arrays, names=COLUMNS)

    return run


def _document_pairs(groups: Groups, doc: np.ndarray, each: np.ndarray) -> np.ndarray:
    """(document and pair as one number, links), ascending."""
    met = summed(doc << 32 | each, np.ones(len(each), np.int64)).astype(np.int64)
    doc, form, times = met[:, 0] >> 32, met[:, 0] & 0xFFFFFFFF, met[:, 1]
    first, count = groups.facts[form, 6], groups.facts[form, 7]
    row = np.repeat(np.arange(len(form)), count)
    at = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + first[row]
    found = groups.pairs[at].astype(np.int64)
    return summed(doc[row] << 32 | found[:, 0], times[row] * found[:, 1])


COLUMNS = ["row", "id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "links"]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs with the number of documents that hold them, in bounded parts."""

    def counts(held: list) -> np.ndarray:
        keys, values = (np.concatenate(x) for x in zip(*held))
        return summed(keys, values)

    def handed(found: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(found[:, k].astype(np.int64)) for k in (0, 1)], names=["pair", "n"])

    held, size = [], 0
    for batch in batches:
        for pairs in batch.column(0):
            keys = np.frombuffer(pairs.as_buffer(), "<u4").astype(np.int64)
            held.append((keys, np.ones(len(keys), np.int64)))
            size += len(keys)
            if size > 2 * COUNTED:
                found = counts(held)
                if len(found) > COUNTED:
                    yield handed(found)
                    found = found[:0]
                held = [(found[:, 0].astype(np.int64), found[:, 1].astype(np.int64))]
                size = len(found)
    if size:
        yield handed(counts(held))


def _scored(common) -> Callable:
    """Sums over the links of common pairs, and the other links as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best = common.value
        for whole in batches:
            for batch in _chunks(whole, 7):
                keys = np.concatenate([np.frombuffer(x.as_buffer(), "<u4") for x in batch.column(7)])
                links = np.concatenate([np.frombuffer(x.as_buffer(), "<u4") for x in batch.column(8)]).astype(np.int64)
                sizes = np.array(pa.compute.binary_length(batch.column(7)), np.int64) // 4
                doc = np.repeat(np.arange(len(batch)), sizes)
                at = np.minimum(np.searchsorted(pairs, keys), max(len(pairs) - 1, 0))
                known = pairs[at] == keys if len(pairs) else np.zeros(len(keys), bool)
                there = at[known]
                sums = np.zeros((len(batch), 2), np.int64)
                np.add.at(sums[:, 0], doc[known], links[known] * best[there])
                np.add.at(sums[:, 1], doc[known], links[known] * counts[there])
                rest = pa.StructArray.from_arrays(
                    [pa.array(keys[~known].astype(np.int64)), pa.array(links[~known])], names=["pair", "links"]
                )
                stops = np.append(0, np.cumsum(np.bincount(doc[~known], minlength=len(batch)))).astype(np.int32)
                arrays = [batch.column(k) for k in range(7)]
                arrays += [pa.array(sums[:, 0]), pa.array(sums[:, 1])]
                arrays.append(pa.ListArray.from_arrays(pa.array(stops), rest))
                yield pa.RecordBatch.from_arrays(arrays, names=[*COLUMNS[:7], "n_best", "count_sum", "rest"])

    return run


def align_tokens(
    docs: DataFrame,
    byte_tokenizer: str,
    piece_tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    common: int = COMMON,
    as_text: bool = True,
) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of every row.

    ``groups`` are the aligned groups, ``a1,a2|b1;a3|b2,b3`` by ids, or the hex SHA-256 of
    that without ``as_text``. Links are all pairs of an A and a B token of one group. The
    count of a pair of ids is the number of documents in which it is linked; ``count_sum``
    adds it up over the links, ``n_best`` is the number of links whose count is the
    highest of their A id, ties included. ``common`` only decides how counts travel.

    Texts that are null, empty or not what the tokens' bytes spell have no tokens: zeros
    and an empty text, and they count for no pair. Null and repeated ids are rows like
    others. Texts are read whole; other columns aren't read. An empty table gives an
    empty one.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    counts = "n_a long, n_b long, n_groups long, n_links long, groups string"
    texts = docs.select(F.monotonically_increasing_id().alias("row"), id_col, text_col)
    run = _aligned(byte_tokenizer, piece_tokenizer, as_text)
    schema = f"row long, id {kind}, {counts}, pairs binary, links binary"
    aligned = materialize(texts.mapInArrow(run, schema), "aligned")

    found = aligned.select("pairs").mapInArrow(_counted, "pair long, n long")
    found = materialize(found.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    pieces = _pieces(piece_tokenizer)
    a = F.expr(f"pair div {pieces}").alias("a")
    # One row per id of A, a vocabulary.
    most = found.groupBy(a).agg(F.max("n").alias("most"))
    best = (F.col("n") == F.col("most")).alias("best")
    table = materialize(found.withColumn("a", a).join(F.broadcast(most), "a").select("pair", "n", best), "pair-best")

    spark = docs.sparkSession
    top = table.orderBy(F.desc("n"), "pair").limit(common).toArrow()
    order = np.argsort(np.array(top["pair"]))
    arrays = (np.array(top[c])[order] for c in ("pair", "n", "best"))
    shared = spark.sparkContext.broadcast(tuple(x.astype(t) for x, t in zip(arrays, ("<u4", "<i8", "<i8"))))
    schema = f"row long, id {kind}, {counts}, n_best long, count_sum long, rest array<struct<pair: long, links: long>>"
    scored = materialize(aligned.mapInArrow(_scored(shared), schema), "scored")

    rest = scored.select("row", F.explode("rest").alias("rest")).select("row", "rest.*").join(table, "pair")
    rest = rest.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("more_best"),
        F.sum(F.col("links") * F.col("n")).alias("more_sum"),
    )
    joined = scored.join(rest, "row", "left")
    return joined.select(
        "id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
        "groups",
    )


def _pieces(piece_tokenizer: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=piece_tokenizer).get_piece_size()
