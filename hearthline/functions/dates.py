"""Dates: tolerant parsing, keys, month parts, spreadsheet serials."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearthline.functions.text import as_text

# The day spellings read (yyyy-MM-dd, M/d/yyyy, M/d/yy) and the time that may follow.
DAY = r"\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/(\d{4}|\d{2})"
TIME_OF_DAY = r"([Tt]|\s+)\d{1,2}:\d{2}(:\d{2})?(\.\d+)?"
# Date headers that do not contain the word "date".
DATE_HEADERS = ("ptd", "setup date", "paid to date")
LAST_SERIAL = 295846
# First day both calendars agree on; older values cannot be stored safely.
FIRST_SAFE_DAY = "1582-10-15"


def flex_date(c: Column) -> Column:
    """Date from mixed spreadsheet spellings; NULL for anything else, never an error.

    The whole text must be a day with an optional time, so remarks such as
    ``pending`` or ``n/a`` anywhere in the cell give NULL.  One pattern tells the
    spellings; the day is then cut out and respelled as yyyy-M-d without patterns
    and cast once; failed date parsers cost far more.
    """
    return read_day(F.trim(as_text(c)))


def read_day(value: Column) -> Column:
    """As ``flex_date``, from a trimmed text, which is used eight times."""
    year = F.substring_index(value, "/", -1)
    # The third character of a long year is a digit; after a short one comes a time or nothing.
    long_year = F.when(F.substring(year, 3, 1).between("0", "9"), F.substring(year, 1, 4)).otherwise(
        F.concat(F.lit("20"), F.substring(year, 1, 2))
    )
    month_day = F.substring_index(value, "/", 2)
    slashed = F.concat_ws("-", long_year, F.substring_index(month_day, "/", 1), F.substring_index(month_day, "/", -1))
    day = F.when(F.substring(value, 5, 1) == "-", F.substring(value, 1, 10)).otherwise(slashed)
    return F.when(value.rlike(f"^({DAY})({TIME_OF_DAY})?$"), day.try_cast("date"))


def date_key(c: Column) -> Column:
    """yyyyMMdd as an integer, computed without going through text."""
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def month_start(c: Column) -> Column:
    return F.trunc(c, "month")


def month_sort(c: Column) -> Column:
    return F.year(c) * 100 + F.month(c)


def month_label(c: Column) -> Column:
    return F.date_format(c, "MMM yyyy")


def year_month(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def safe_day(c: Column) -> Column:
    """NULL out days before the calendar cutover."""
    return F.when(c >= F.lit(FIRST_SAFE_DAY).cast("date"), c)


def is_date_header(c: Column) -> Column:
    header = F.lower(F.trim(as_text(c)))
    return header.contains("date") | header.isin(*DATE_HEADERS)


def serial_to_date(n: Column) -> Column:
    """Spreadsheet day number as MM/dd/yyyy; NULL outside 1..295846.

    The 1900 system counts a 29 February 1900 that never was, so numbers below
    60 start one day later.
    """
    day = F.floor(n).cast("int")
    epoch = F.when(n < 60, F.lit("1899-12-31")).otherwise(F.lit("1899-12-30")).cast("date")
    return F.when(n.between(1, LAST_SERIAL), F.date_format(F.date_add(epoch, day), "MM/dd/yyyy"))
