"""Numbers written as text: decimal commas, trace tokens, rounding casts."""

from __future__ import annotations

from collections.abc import Mapping
from types import MappingProxyType

from pyspark.sql import Column, functions as F

_NO_TOKENS: Mapping[str, str] = MappingProxyType({})


# Text that does not end in a digit but may still be a number: padded, with a
# trailing point, or spelled out. Everything else is not worth a cast, since a
# failing cast costs ten times as much as a successful one.
_ODD_NUMBER = r"(?i)^\s*[+-]?(?:inf|infinity|nan|[0-9.,][0-9.,_e+-]*)\s*$"


def _number_or_null(text: Column, plain: Column) -> Column:
    """``plain`` as a double where ``text``, the form it was made from, may be one.

    Leaves out what only Java reads as a number: ``1.0d``, ``2f`` and ``0x1p3``.
    """
    ends_in_digit = F.substring(text, -1, 1).between("0", "9")
    hexadecimal = F.contains(text, F.lit("x")) | F.contains(text, F.lit("X"))
    return F.when((ends_in_digit & ~hexadecimal) | text.rlike(_ODD_NUMBER), plain.try_cast("double"))


def _decimal_point(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit("."))


def locale_decimal(value: Column, tokens: Mapping[str, str] = _NO_TOKENS) -> Column:
    """``"12,5"`` -> 12.5; ``tokens`` are replaced first, unreadable text is NULL.

    Digits may be separated as in ``1_000``, which Spark's cast refuses.
    """
    text = value.cast("string")
    for token, number in tokens.items():
        text = F.replace(text, F.lit(token), F.lit(number))
    plain = F.when(
        F.contains(text, F.lit("_")),
        F.regexp_replace(_decimal_point(text), r"(?<=[0-9])_(?=[0-9])", ""),
    ).otherwise(_decimal_point(text))
    return _number_or_null(text, plain)


def collector_number(value: Column) -> Column:
    """Number or NULL as the collector stores it.

    Differs from :func:`locale_decimal` in that tokens are never read as numbers,
    digit separators are refused, and neither NaN nor an overflow survives; an
    infinity that is spelled out does.
    """
    text = value.cast("string")
    number = _number_or_null(text, _decimal_point(text))
    return F.when(F.abs(number) < float("inf"), number).when(
        text.rlike("(?i)^[+-]?inf(?:inity)?$"), number
    )


def int_from_double(value: Column) -> Column:
    """Nearest integer, ties to even."""
    return F.rint(value.cast("double")).cast("int")


def int_from_text(value: Column) -> Column:
    """Nearest integer of a number written as text, ties away from zero."""
    return F.round(value.cast("double")).cast("int")


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole``; 0 when there is nothing to compare with."""
    return F.when(whole != 0, F.lit(100) * part / whole).otherwise(F.lit(0.0))


def percent_text(pct: Column) -> Column:
    """One decimal; what lies halfway by its exact binary value goes to the even digit."""
    return F.call_function("format_number", pct, F.lit("0.0"))
