"""Text, number, date and ratio expressions (Column -> Column)."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from faultline.config import MISSING_DATE, NULL_TEXTS, TRUE_TEXTS

# The characters Unicode counts as white space in text stripping.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

_WHOLE = r"^[+-]?[0-9]+$"
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def strip(text: Column) -> Column:
    """Remove white space at both ends, tabs, line ends and no-break spaces included."""
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    """True for text of white space only; null stays null.

    The first character settles almost every text, so long ones are rarely searched.
    """
    starts_blank = F.lit(WHITESPACE).contains(F.substring(text, 1, 1))
    return starts_blank & ~text.rlike(f"[^{WHITESPACE}]")


def is_present(text: Column) -> Column:
    return text.isNotNull() & ~is_blank(text)


def to_number(text: Column) -> Column:
    """Plain or exponent notation as double, anything else null."""
    trimmed = strip(text.cast("string"))
    return F.when(trimmed.rlike(_NUMBER), trimmed.try_cast("double"))


def to_whole(text: Column) -> Column:
    """Number truncated to bigint; null if not numeric or out of range.

    Whole-number text is read directly, so large ids keep every digit; other text is kept
    away from that cast, because a failed one is slow.
    """
    trimmed = strip(text.cast("string"))
    whole = F.when(trimmed.rlike(_WHOLE), trimmed.try_cast("bigint"))
    return F.coalesce(whole, to_number(text).try_cast("bigint"))


def to_date_any(text: Column, formats: Iterable[str]) -> Column:
    """First format that parses wins; null if none does, or for the missing-date mark.

    A format is only tried on texts with its separators: a failed parse is slow.
    """
    trimmed = strip(text.cast("string"))

    def attempt(fmt: str) -> Column:
        if fmt == "iso":
            return trimmed.try_cast("date")
        separators = sorted({char for char in fmt if not char.isalpha()})
        likely = reduce(and_, [trimmed.contains(char) for char in separators], F.lit(True))
        return F.when(likely, F.try_to_date(trimmed, fmt))

    tries = [attempt(fmt) for fmt in formats]
    return F.nullif(F.coalesce(*tries), F.lit(MISSING_DATE).cast("date"))


def to_instant(text: Column) -> Column:
    """ISO text as an instant; text without an offset is read in the session zone (UTC)."""
    return strip(text.cast("string")).try_cast("timestamp")


def to_flag(text: Column) -> Column:
    """True only for the known words; everything else, null included, is false."""
    return F.coalesce(F.lower(strip(text.cast("string"))).isin(*TRUE_TEXTS), F.lit(False))


def fill_text(text: Column, placeholder: str) -> Column:
    """Stripped text, with the placeholder for null and for the null-like words."""
    trimmed = strip(text.cast("string"))
    return F.when(trimmed.isNull() | trimmed.isin(*NULL_TEXTS), F.lit(placeholder)).otherwise(
        trimmed
    )


def ratio(part: Column, whole: Column) -> Column:
    """part / whole in double; null for an empty whole."""
    return part * F.lit(1.0) / F.nullif(whole, F.lit(0))


def percent(part: Column, whole: Column) -> Column:
    """Percentage rounded half away from zero to two places; null for an empty whole."""
    return F.round(part * F.lit(100.0) / F.nullif(whole, F.lit(0)), 2)


def report_percent(part: Column, whole: Column) -> Column:
    """Percentage rounded half to even to one place; 0 for an empty whole."""
    share = F.bround(part / F.nullif(whole, F.lit(0)) * F.lit(100.0), 1)
    return F.coalesce(share, F.lit(0.0))


def record_key(prefix: str, identifier: Column) -> Column:
    """Prefix joined to the identifier; a missing identifier leaves the bare prefix."""
    return F.concat(F.lit(prefix), F.coalesce(identifier.cast("string"), F.lit("")))
