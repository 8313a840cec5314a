"""Format-preserving pseudonyms for personal data in texts.

Every value that passes the checks of its kind is replaced by another valid value
of the same kind and layout, by a permutation that depends on a key alone: equal
values get equal pseudonyms in all documents, whatever separators or letter case
they are written with, unlike values never collide, and who has the key can go back.

The permutation of ``0 .. n-1`` is a Feistel network on the next even number of bits
with cycle walking, around a key-dependent rotation, so that no value is ever its
own pseudonym.

=========  ==========================================================  ==================
kind       accepted if                                                 kept
=========  ==========================================================  ==================
card       12 to 19 digits, Luhn check digit right                     first digit, check
iban       country letters, mod-97 check right                         country, check
ssn        area, group and serial in use                               validity
phone      country code or national layout, 7 to 15 digits             country code
ip         four numbers up to 255                                      validity
date       a day of 1800 to 2199 in a numeric layout                   validity
email      a local part and a dotted domain                            domain
secret     access key ids; what is assigned to a password or token     character classes
=========  ==========================================================  ==================

Numbers that fail their check are left alone, and so is all other text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from datetime import date

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintagemart.llm.worker import slices

ROUNDS = 8
# Letters and digits that are permuted as one number.
WHOLE = 512
# Pseudonyms remembered per task before the memory starts anew.
REMEMBERED = 100_000
FIRST_DAY = date(1800, 1, 1).toordinal()
DAYS = date(2199, 12, 31).toordinal() - FIRST_DAY + 1

# A line without any of these holds nothing to replace.
_SIGNS = re.compile(r"[0-9@=:]")
_FOUND = re.compile(
    r"""
      (?P<access>(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9]))
    | (?i:password|passwd|pwd|passphrase|secret|token|api[_-]?key)["']?\s*
      (?:=\s*["']?|:(?!//)\s*(?:["']|(?=[^\s"']*?(?:[0-9]|[a-z][A-Z]|[A-Za-z][^\w\s"'.,;:!?][A-Za-z]))))
      (?P<secret>[^\s"']{4,})
    | (?P<email>(?<![\w.%+-])[\w%+-]+(?:\.[\w%+-]+)*@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,})
    | (?P<iban>(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))
    | (?P<ip>(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\w|\.[0-9]))
    | (?P<date>(?<![\w./-])(?:[0-9]{4}(?P<m1>[-/.])[0-9]{1,2}(?P=m1)[0-9]{1,2}
                             |[0-9]{1,2}(?P<m2>[-/.])[0-9]{1,2}(?P=m2)[0-9]{4})(?=T[0-9]{2}:|(?![\w/-]|\.[0-9])))
    | (?P<ssn>(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-]))
    | (?P<card>(?<![\w+-])(?:[0-9]{12,19}|[0-9]{4}(?P<m3>[ -])[0-9]{4}(?P=m3)[0-9]{4}(?P=m3)[0-9]{1,7}
                            |[0-9]{4}(?P<m4>[ -])[0-9]{6}(?P=m4)[0-9]{5})(?![\w-]|\.[0-9]))
    | (?P<phone>(?<![\w.+])\+[0-9]{1,3}[ .-]?\([0-9]{2,4}\)[ ]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![\w-]|\.[0-9])
               |(?<![\w.+])\+[0-9](?:[ .-]?[0-9]){6,14}(?![\w-]|\.[0-9])
               |(?<![\w.+-])(?:\([2-9][0-9]{2}\)[ ]?|[2-9][0-9]{2}[.-])[2-9][0-9]{2}[.-][0-9]{4}(?![\w-]|\.[0-9]))
    """,
    re.VERBOSE,
)


class Permutation:
    """Keyed permutations of ``0 .. n-1`` without fixed points."""

    def __init__(self, key: bytes) -> None:
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, tweak: bytes, number: int, half: int, bits: int) -> int:
        size = (bits + 7) // 8
        seed = b"%b|%b|%d|%d|%x" % (self.key, tweak, bits, number, half)
        return int.from_bytes(hashlib.shake_256(seed).digest(size), "big") & ((1 << bits) - 1)

    def _network(self, x: int, n: int, tweak: bytes, back: bool) -> int:
        bits = max(1, (n - 1).bit_length() + 1 >> 1)
        mask = (1 << bits) - 1
        while True:
            left, right = x >> bits, x & mask
            if back:
                for number in reversed(range(ROUNDS)):
                    left, right = right ^ self._round(tweak, number, left, bits), left
            else:
                for number in range(ROUNDS):
                    left, right = right, left ^ self._round(tweak, number, right, bits)
            x = left << bits | right
            if x < n:
                return x

    def _turn(self, n: int, tweak: bytes) -> int:
        return 1 + self._round(tweak, ROUNDS, n, n.bit_length() + 64) % (n - 1)

    def forward(self, x: int, n: int, tweak: bytes) -> int:
        if n < 2:
            return x
        inner = self._network(x, n, tweak, back=False)
        return self._network((inner + self._turn(n, tweak)) % n, n, tweak, back=True)

    def backward(self, x: int, n: int, tweak: bytes) -> int:
        if n < 2:
            return x
        inner = self._network(x, n, tweak, back=False)
        return self._network((inner - self._turn(n, tweak)) % n, n, tweak, back=True)


Step = Callable[[int, int, bytes], int]


def luhn_digit(digits: str) -> str:
    """The check digit that completes ``digits``."""
    doubled = (int(d) * 2 if i % 2 == 0 else int(d) for i, d in enumerate(reversed(digits)))
    return str(-sum(d - 9 if d > 9 else d for d in doubled) % 10)


def iban_check(country: str, account: str) -> str:
    number = "".join(str(int(c, 36)) for c in account + country + "00")
    return f"{98 - int(number) % 97:02d}"


def _by_classes(text: str, step: Step, tweak: bytes) -> str:
    """Permute the letters and digits of a text among texts of the same pattern.

    Up to ``WHOLE`` letters and digits are one number. Longer texts are permuted in
    blocks of so many, first from the front and then from the back, each block under a
    tweak that holds its finished neighbour, so that every block depends on all others.
    """
    places = [at for at, c in enumerate(text) if c.isascii() and c.isalnum()]
    if len(places) <= WHOLE:
        return _permuted(text, places, step, tweak)
    blocks = [places[i : i + WHOLE] for i in range(0, len(places), WHOLE)]
    tweak += b":%d" % len(places)
    one, two = range(len(blocks)), range(len(blocks) - 1, -1, -1)
    for order, name in ((two, b"back"), (one, b"front")) if _is_back(step) else ((one, b"front"), (two, b"back")):
        text = _chained(text, blocks, order, step, tweak + b":" + name)
    return text


def _chained(text: str, blocks: list[list[int]], order: range, step: Step, tweak: bytes) -> str:
    """Permute the blocks in order, each under the result of the one before it; undone
    from the last to the first, since that result is what an undone text begins with."""
    told = [text[b[0] : b[-1] + 1] for b in blocks]
    back = _is_back(step)
    for at in reversed(order) if back else order:
        k = order.index(at)
        before = told[order[k - 1]] if k else ""
        own = tweak + b":%d:" % k + hashlib.blake2b(before.encode("utf-8", "surrogatepass"), digest_size=16).digest()
        places = [p - blocks[at][0] for p in blocks[at]]
        told[at] = _permuted(told[at], places, step, own)
    out, done = [], 0
    for block, part in zip(blocks, told):
        out += [text[done : block[0]], part]
        done = block[-1] + 1
    return "".join([*out, text[done:]])


def _is_back(step: Step) -> bool:
    return step.__name__ == "backward"


def _permuted(text: str, at: list[int], step: Step, tweak: bytes) -> str:
    """The letters and digits at these places as one number, permuted."""
    places = [(i, *(("0", 10) if text[i].isdigit() else ("a", 26) if text[i].islower() else ("A", 26))) for i in at]
    value, total = 0, 1
    for i, zero, radix in places:
        value = value * radix + ord(text[i]) - ord(zero)
        total *= radix
    pattern = "".join(zero for _, zero, _ in places)
    value = step(value, total, tweak + b":" + pattern.encode())
    out = list(text)
    for i, zero, radix in reversed(places):
        value, digit = divmod(value, radix)
        out[i] = chr(ord(zero) + digit)
    return "".join(out)


def _refill(text: str, digits: str) -> str:
    """The digits of ``text`` replaced in turn."""
    new = iter(digits)
    return "".join(next(new) if c.isdigit() else c for c in text)


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def _fixed_width(number: int, width: int) -> str:
    return str(number).zfill(width)


def _card(text: str, step: Step) -> str | None:
    digits = _digits(text)
    if luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    middle = digits[1:-1]
    tweak = b"card:%b:%d" % (digits[:1].encode(), len(digits))
    body = digits[0] + _fixed_width(step(int(middle), 10 ** len(middle), tweak), len(middle))
    return _refill(text, body + luhn_digit(body))


def _iban(text: str, step: Step) -> str | None:
    plain = text.replace(" ", "")
    country, check, account = plain[:2], plain[2:4], plain[4:]
    if not 11 <= len(account) <= 30 or iban_check(country, account) != check:
        return None
    account = _by_classes(account, step, b"iban:" + country.encode())
    new = iter(country + iban_check(country, account) + account)
    return "".join(c if c == " " else next(new) for c in text)


def _ip(text: str, step: Step) -> str | None:
    numbers = [int(n) for n in text.split(".")]
    if max(numbers) > 255 or any(len(n) > 1 and n[0] == "0" for n in text.split(".")):
        return None
    value = int.from_bytes(bytes(numbers), "big")
    return ".".join(str(b) for b in step(value, 1 << 32, b"ip").to_bytes(4, "big"))


def _date(text: str, step: Step) -> str | None:
    mark = next(c for c in text if not c.isdigit())
    parts = text.split(mark)
    year_first = len(parts[0]) == 4
    year = int(parts[0] if year_first else parts[2])
    one, two = (int(p) for p in (parts[1:] if year_first else parts[:2]))
    for month_first in (True,) if year_first else (False, True):
        month, day = (one, two) if month_first else (two, one)
        try:
            ordinal = date(year, month, day).toordinal() - FIRST_DAY
        except ValueError:
            continue
        if not 0 <= ordinal < DAYS:
            return None
        while True:
            ordinal = step(ordinal, DAYS, b"date")
            new = date.fromordinal(ordinal + FIRST_DAY)
            # A month-first date must not read as a day-first one afterwards.
            if year_first or not month_first or new.day > 12:
                break
        width = 2 if all(len(p) != 1 for p in parts) else 1
        low = [new.month, new.day] if month_first else [new.day, new.month]
        shown = [_fixed_width(n, width) for n in low]
        full = _fixed_width(new.year, 4)
        return mark.join([full, *shown] if year_first else [*shown, full])
    return None


def _ssn(text: str, step: Step) -> str | None:
    area, group, serial = (int(p) for p in text.split("-"))
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    area -= 1 if area < 666 else 2
    value = step((area * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999, b"ssn")
    value, serial = divmod(value, 9999)
    area, group = divmod(value, 99)
    area += 1 if area + 1 < 666 else 2
    return f"{area:03d}-{group + 1:02d}-{serial + 1:04d}"


def _phone(text: str, step: Step) -> str | None:
    """The last ten digits are permuted, or all after the country code; the first
    one never becomes a zero, which would be a trunk prefix."""
    digits = _digits(text)
    if not 7 <= len(digits) <= 15:
        return None
    code = re.match(r"\+([0-9]{1,3})(?=[ .(-])", text)
    kept = len(code[1]) if code else len(digits) - 10 if text[0] == "+" and len(digits) > 10 else 0
    own = digits[kept:]
    if len(own) < 4:
        return None
    zeros = len(own) - len(own.lstrip("0"))
    first, rest = own[zeros : zeros + 1], own[zeros + 1 :]
    if not rest:
        return None
    size = 10 ** len(rest)
    value = step((int(first) - 1) * size + int(rest), 9 * size, b"phone:%d" % (len(rest) + 1))
    new = str(value // size + 1) + _fixed_width(value % size, len(rest))
    return _refill(text, digits[: kept + zeros] + new)


def _email(text: str, step: Step) -> str | None:
    local, _, domain = text.rpartition("@")
    low = _by_classes(local.lower(), step, b"email:" + domain.lower().encode())
    return "".join(n.upper() if o.isupper() else n for o, n in zip(local, low)) + "@" + domain


def _secret(text: str, step: Step) -> str | None:
    return _by_classes(text, step, b"secret")


def _access(text: str, step: Step) -> str | None:
    return text[:4] + _by_classes(text[4:], step, b"access")


_RULES = {
    "access": _access,
    "secret": _secret,
    "email": _email,
    "iban": _iban,
    "ip": _ip,
    "date": _date,
    "ssn": _ssn,
    "card": _card,
    "phone": _phone,
}


class Pseudonymizer:
    """Replaces values in whole texts; ``back`` undoes it with the same key."""

    def __init__(self, key: bytes, back: bool = False) -> None:
        permutation = Permutation(key)
        self.step: Step = permutation.backward if back else permutation.forward
        self.known: dict[tuple[str, str], str | None] = {}
        self.replaced = 0

    def value(self, kind: str, text: str) -> str | None:
        """The pseudonym of one value; None if it isn't a valid one of its kind."""
        if len(text) > WHOLE:
            return _RULES[kind](text, self.step)
        if (kind, text) not in self.known:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[kind, text] = _RULES[kind](text, self.step)
        return self.known[kind, text]

    def _line(self, line: str) -> str:
        out, done, at = [], 0, 0
        while match := _FOUND.search(line, at):
            kind = next(k for k in _RULES if match[k] is not None)
            start, at = match.span(kind)
            text = match[kind]
            new = self.value(kind, text)
            while new is None and kind == "iban" and " " in text:
                # Words in capitals after the number may look like a part of it.
                text = text.rpartition(" ")[0]
                new = self.value(kind, text)
            if new is not None:
                out += [line[done:start], new]
                done = at = start + len(text)
                self.replaced += new != text
        return "".join([*out, line[done:]]) if done else line

    def text(self, text: str | None) -> tuple[str | None, int]:
        """The text with pseudonyms, and how many there are."""
        if text is None or not _SIGNS.search(text):
            return text, 0
        before = self.replaced
        lines = [self._line(x) if _SIGNS.search(x) else x for x in text.split("\n")]
        return "\n".join(lines), self.replaced - before


def _batches(key: bytes, at: int, back: bool, count: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule = Pseudonymizer(key, back)
        for batch in slices(batches):
            found = [rule.text(t) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array([t for t, _ in found], pa.string())
            names = list(batch.schema.names)
            if count:
                columns.append(pa.array([n for _, n in found], pa.int64()))
                names.append(COUNT)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


COUNT = "n_pseudonyms"


def pseudonymize(
    docs: DataFrame, key: bytes, text_col: str = "text", back: bool = False, count: bool = False
) -> DataFrame:
    """``docs`` with pseudonyms in ``text_col``; rows are only mapped.

    All columns and rows stay as they are, whatever they are called and however
    often they repeat; null and empty texts stay null and empty; equal texts get
    equal results. ``count`` adds the column ``n_pseudonyms``, which must not exist
    yet; ``back`` restores the originals from pseudonyms made with the same key. An
    empty table gives an empty one.
    """
    if not key:
        raise ValueError("a key is needed")
    if count and COUNT in docs.columns:
        raise ValueError(f"there is a column {COUNT} already")
    at = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, *([T.StructField(COUNT, T.LongType())] if count else [])])
    renamed = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    plain = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema.fields)])
    if count:
        plain = plain.add(COUNT, T.LongType())
    done = renamed.withColumn(f"c{at}", F.col(f"c{at}").cast("string")).mapInArrow(
        _batches(key, at, back, count), plain
    )
    return done.toDF(*schema.names)
