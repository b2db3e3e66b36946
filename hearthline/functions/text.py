"""Text cleaning and key normalisation."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Legal phrases removed from lender names, in this order.
LENDER_SUFFIXES = (
    "ITS SUCCESSORS AND/OR ASSIGNS",
    "AND/OR ASSIGNS",
    "ITS SUCCESSORS",
    "ISAOA",
    "ATIMA",
)
# The characters that tokens and postal codes keep.
TOKEN, DIGITS = "A-Z0-9", "0-9"


def as_text(c: Column) -> Column:
    """The value as a string, with NULL read as the empty string."""
    return F.coalesce(c.cast("string"), F.lit(""))


def upper_text(c: Column) -> Column:
    return F.upper(F.trim(as_text(c)))


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def has_text(c: Column) -> Column:
    """True or false, never NULL: is there anything besides blanks?"""
    return F.trim(as_text(c)) != ""


def unwrap_value(c: Column) -> Column:
    """``{value=12.50}`` becomes ``12.50``; anything else is left alone."""
    return F.regexp_replace(c.cast("string"), r"^\{value=(.*)\}$", "$1")


def clean_string(c: Column) -> Column:
    return blank_to_null(unwrap_value(c))


def known(c: Column) -> Column:
    """The text, or NULL where it is empty."""
    return F.nullif(c, F.lit(""))


def only(c: Column, kept: str) -> Column:
    """Without the characters that a class such as ``A-Z0-9`` leaves out.

    ASCII texts are translated, which takes less than half a pattern's time.  The text is
    used four times, so a wide plan works it out in a step before.
    """
    others = "".join(chr(i) for i in range(128) if not re.fullmatch(f"[{kept}]", chr(i)))
    plain = F.octet_length(c) == F.length(c)
    return F.when(plain, F.translate(c, others, "")).otherwise(F.regexp_replace(c, f"[^{kept}]+", ""))


def token_text(c: Column, legacy_case: bool = False) -> Column:
    """What ``token`` strips."""
    return as_text(c) if legacy_case else F.upper(as_text(c))


def token(c: Column, legacy_case: bool = False) -> Column:
    """As ``norm_token``, but empty when nothing is left."""
    return only(token_text(c, legacy_case), TOKEN)


def norm_token(c: Column, legacy_case: bool = False) -> Column:
    """Keep digits and capitals only; NULL when nothing is left.

    Small letters are raised first.  ``legacy_case=True`` strips before raising,
    so small letters vanish, for data keyed under that older rule.
    """
    return known(token(c, legacy_case))


def words(c: Column) -> Column:
    """Capitals and digits in words one space apart."""
    # No mark is left in the text, so marks can stand for its spaces while runs of them close up.
    marked = F.replace(F.trim(only(c, "A-Z0-9 ")), F.lit(" "), F.lit("<>"))
    return F.replace(F.replace(marked, F.lit("><"), F.lit("")), F.lit("<>"), F.lit(" "))


def lender_text(c: Column) -> Column:
    """A lender's name in capitals without legal phrases."""
    return reduce(lambda name, phrase: F.replace(name, F.lit(phrase), F.lit(" ")), LENDER_SUFFIXES, upper_text(c))


def lender_words(c: Column) -> Column:
    """As ``norm_lender``, but empty when nothing is left."""
    return words(lender_text(c))


def norm_lender(c: Column) -> Column:
    """Lender name in capitals without legal phrases or punctuation."""
    return known(lender_words(c))


def address_words(c: Column) -> Column:
    """As ``norm_address``, but empty when nothing is left."""
    return words(upper_text(c))


def norm_address(c: Column) -> Column:
    return known(address_words(c))


def digits(c: Column) -> Column:
    return only(as_text(c), DIGITS)


def five_digits(digits: Column) -> Column:
    return F.when(F.length(digits) >= 5, F.left(digits, F.lit(5)))


def zip5(c: Column) -> Column:
    """First five digits, or NULL when there are fewer."""
    return five_digits(digits(c))


def joined_name(*parts: Column) -> Column:
    """Non-blank parts joined by one space; empty string when all are blank."""
    return F.concat_ws(" ", *[blank_to_null(p) for p in parts])


def mask_ssn(c: Column) -> Column:
    return F.concat(F.lit("***-**-"), F.right(c.cast("string"), F.lit(4)))


def first_listed(c: Column) -> Column:
    """First entry of a list written as text: ``["abc","d"]`` gives ``abc``."""
    return F.nullif(F.regexp_extract(c, r'^\s*\[\s*"?([^"\],\]]+)', 1), F.lit(""))
