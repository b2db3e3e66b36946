"""Tolerant numbers.  ANSI casts throw on dirty text, so only try_cast is used."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearthline.functions.text import as_text, clean_string

MONEY = "decimal(18,2)"
RATE = "decimal(10,6)"


def safe_decimal(c: Column, kind: str = MONEY) -> Column:
    """Decimal from a number, text or ``{value=...}`` wrapper; NULL if unreadable."""
    return clean_string(c).try_cast(kind)


def safe_int(c: Column) -> Column:
    """Integer that also reads ``360.0``, cutting off the fraction."""
    return clean_string(c).try_cast("decimal(38,10)").try_cast("int")


def safe_double(c: Column) -> Column:
    return clean_string(c).try_cast("double")


# What sums and ratios are worked out in: six places, and 10^22 values of the largest size before a sum is full.
EXACT = "decimal(28,6)"


def bare_number(c: Column) -> Column:
    """The text without dollar signs, commas and white space."""
    return F.translate(as_text(c), "$, \t\n\x0b\f\r", "")


def number_text(value: Column) -> Column:
    """As ``money_text``, from a ``bare_number``."""
    readable = value.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d{1,3})?$")
    number = value.cast("double")
    return F.when(F.when(readable, F.abs(number) < 1e22), number)


def money_text(c: Column) -> Column:
    """``$1,234.50`` as a double; NULL for blanks, unreadable text and numbers of 10^22 or more.

    Numbers are told by pattern, so that placeholders do not cost a failed cast.
    """
    return number_text(bare_number(c))


def year_digits(c: Column) -> Column:
    """A number without its fraction, else the first run of four digits, else empty."""
    return F.regexp_extract(F.trim(as_text(c)), r"^[+-]?\d{1,9}(?=(\.\d*)?$)|\d{4}", 0)


def year_in_text(c: Column) -> Column:
    """A number without its fraction, else the first run of four digits (``c. 1965``).

    Matched by pattern rather than by a cast that fails: a failed cast raises and
    catches an exception per row.
    """
    return F.nullif(year_digits(c), F.lit("")).cast("int")


def exact_avg(c: Column) -> Column:
    """Mean as a double that does not depend on the order rows were summed in.

    Values are taken to six places.  One that a decimal of 28 digits can't hold counts
    neither in the sum nor in the number of values.
    """
    value = c.try_cast(EXACT)
    return F.sum(value).cast("double") / F.count(value)


def decimal_avg(c: Column, scale: int = 2) -> Column:
    """Mean of a decimal column, rounded half up to its own scale."""
    total = F.sum(c.cast(f"decimal(18,{scale})"))
    return F.round(total / F.count(c), scale).cast(f"decimal(18,{scale})")


def percent_of(part: Column, whole: Column) -> Column:
    """100 * part / whole to two places; NULL when the whole is zero to six places."""
    exact, base = part.try_cast(EXACT), F.nullif(whole.try_cast(EXACT), F.lit(0).cast(EXACT))
    return F.round(F.try_divide(exact * 100, base), 2)
