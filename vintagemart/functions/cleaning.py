"""Cleaning of dirty text and numbers.

ANSI mode makes a plain cast of junk raise, so every conversion that is meant
to yield null on junk is a ``try_cast``.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# The category codes of the lending and user schemas.
CREDIT_MIX_SCORE = {"Bad": 0, "Standard": 1, "Good": 2}
YES_NO_FLAG = {"Yes": 1, "No": 0}
GENDER_CODE = {"M": 0, "F": 1, "Other": 2}
EDUCATION_YEARS = {"High School": 12, "Bachelor": 16, "Master": 18, "PhD": 21}

# Upper bounds (exclusive) of the age bands.
AGE_BANDS = {"Youth": 25, "Adult": 45, "Middle-aged": 65}
LAST_AGE_BAND = "Senior"

WHITESPACE = " \t\n\r\f\v"
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def digits_to_int(text: Column) -> Column:
    """Keep the digits and read them as int: ``"39_"`` -> 39, ``"-500"`` -> 500."""
    return F.regexp_replace(text, "[^0-9]", "").try_cast("int")


def signed_age(text: Column, lowest: int = 0, highest: int = 120) -> Column:
    """Strict reading of an age: the sign counts and impossible ages are null."""
    age = F.regexp_replace(text, r"[^0-9\-]", "").try_cast("int")
    return F.when(age.between(lowest, highest), age)


def age_band(age: Column, null_band: str | None = LAST_AGE_BAND) -> Column:
    """Age bands; a null age falls into ``null_band`` (None keeps it null)."""
    band = F.when(age.isNull(), F.lit(null_band))
    for name, upper in AGE_BANDS.items():
        band = band.when(age < upper, name)
    return band.otherwise(LAST_AGE_BAND)


def clean_number(text: Column, dtype: str = "float") -> Column:
    """Strip everything but digits, point and minus; what is left or null."""
    return F.trim(F.regexp_replace(text, r"[^0-9.\-]", "")).try_cast(dtype)


def encode(column: Column, codes: Mapping[str, Any]) -> Column:
    """Dictionary encoding; values outside the dictionary become null."""
    branches = iter(codes.items())
    key, code = next(branches)
    out = F.when(column == key, F.lit(code))
    for key, code in branches:
        out = out.when(column == key, F.lit(code))
    return out


def duration_months(text: Column) -> Column:
    """``"31 Years and 0 Months"`` -> 372; null unless both parts are there."""
    years = F.regexp_extract(text, r"(\d+)\s+Years", 1).try_cast("int")
    months = F.regexp_extract(text, r"(\d+)\s+Months", 1).try_cast("int")
    return years * 12 + months


def keep_matching(text: Column, pattern: str = "^[A-Za-z_]+$", other: str = "Unknown") -> Column:
    """Whitelist by pattern; anything else, null included, becomes ``other``."""
    return F.when(text.rlike(pattern), text).otherwise(F.lit(other))


def count_list_items(text: Column, strict: bool = False) -> Column:
    """Number of entries in ``"A, B, and C"``; null counts 0.

    By default ``", and "`` separates twice, so the example counts 4;
    ``strict`` takes it as one separator and counts 3.
    """
    conjunction = r"(\s*,)?\s+and\s+" if strict else r"\s+and\s+"
    items = F.split(F.regexp_replace(text, conjunction, ","), r"\s*,\s*")
    return F.when(text.isNotNull(), F.size(items)).otherwise(F.lit(0))


def clean_label(text: Column) -> Column:
    """Lower case without surrounding white space."""
    return F.btrim(F.lower(text), F.lit(WHITESPACE))


def equals_flag(column: Column, value: Any) -> Column:
    """1 if equal else 0; null is not equal."""
    return F.coalesce((column == F.lit(value)).cast("int"), F.lit(0))


def clip(column: Column, lower: float | None = None, upper: float | None = None) -> Column:
    """Bound a value from below and above; null stays null."""
    out = column
    if upper is not None:
        out = F.when(out > F.lit(upper), F.lit(upper)).otherwise(out)
    if lower is not None:
        out = F.when(out < F.lit(lower), F.lit(lower)).otherwise(out)
    return out


def number_in_text(text: Column) -> Column:
    """The number a text consists of, or null; suffixes that a cast would accept
    (``"5d"``) are no part of a number."""
    plain = F.btrim(text, F.lit(WHITESPACE))
    return F.when(plain.rlike(NUMBER), plain.try_cast("double"))


def divide_or_zero(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; 0 for a zero divisor or a missing operand."""
    return F.coalesce(
        F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0)
    )
