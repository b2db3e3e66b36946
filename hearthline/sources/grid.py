"""Spreadsheet grids to tables.

A grid is a table of sheet rows::

    source_uri string, sheet string, row_idx int, cells array<struct<t string, v string>>

with cell types s (text), n (number), d (ISO date or time), b (bool), e (error)
and z (empty).  Any number of sheets is processed at once; nothing but one
header row of one chosen sheet is ever brought to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.functions import dates
from hearthline.functions.names import header_names, snake_case, unique_names

SHEET = ("source_uri", "sheet")
# Fixed values of the header rule.
HEADER_SEARCH_ROWS = 30
MIN_HEADER_CELLS = 3


def cell_text(cell: Column) -> Column:
    """A cell as trimmed text: dates MM/dd/yyyy, booleans 1/0, errors and gaps blank."""
    kind, value = cell.getField("t"), F.coalesce(cell.getField("v"), F.lit(""))
    day = F.date_format(F.left(value, F.lit(10)).try_cast("date"), "MM/dd/yyyy")
    return (
        F.when(kind.isin("e", "z") | kind.isNull(), F.lit(""))
        .when(kind == "d", F.coalesce(day, F.trim(value)))
        .when(kind == "b", F.when(F.lower(value).isin("true", "1"), "1").otherwise("0"))
        .otherwise(F.trim(value))
    )


def is_numeric_text(c: Column) -> Column:
    """Digits with at most one point and leading minus, after dropping ``, $ %``."""
    bare = F.translate(F.trim(c), ",$%", "")
    return bare.rlike(r"^-?([0-9]+\.?[0-9]*|\.[0-9]+)$")


def detect_header(grid: DataFrame, search_rows: int = HEADER_SEARCH_ROWS) -> DataFrame:
    """(source_uri, sheet, widest, header_idx, texts) per sheet: its header's place and cell texts.

    The header is the first of 30 rows that is half full (three cells at least)
    and at least 70% text; the sheet's first row when there is none.  One aggregate with
    map-side combine: per sheet only the widest row, the first row and 30 early rows are kept.
    """
    texts = F.transform("cells", cell_text)
    rows = grid.select(*SHEET, "row_idx", F.size("cells").alias("width"), texts.alias("texts"))
    filled = F.filter("texts", lambda t: t != "")
    wordy = F.filter(filled, lambda t: ~is_numeric_text(t))
    early = F.struct("row_idx", "texts", F.size(filled).alias("filled"), F.size(wordy).alias("wordy"))
    per_sheet = rows.groupBy(*SHEET).agg(
        F.max("width").alias("widest"),
        F.collect_list(F.when(F.col("row_idx") < search_rows, early)).alias("early"),
        F.min_by(early, "row_idx").alias("top"),
    )
    enough = F.greatest(F.lit(MIN_HEADER_CELLS), F.floor(F.col("widest") / 2))
    fitting = F.filter("early", lambda r: (r["filled"] >= enough) & (r["wordy"] * 10 >= r["filled"] * 7))
    # The smallest struct has the smallest row number, its first field.
    chosen = F.coalesce(F.array_min(fitting), F.col("top"))
    found = per_sheet.select(*SHEET, "widest", chosen.alias("chosen"))
    return found.select(*SHEET, "widest", F.col("chosen.row_idx").alias("header_idx"), F.col("chosen.texts").alias("texts"))


def header_rows(grid: DataFrame) -> DataFrame:
    """(source_uri, sheet, header_idx, width, headers): one row per sheet.

    The width ends at the last header cell with text; a header without any text
    keeps its full width.
    """
    used = F.array_max(F.transform("texts", lambda t, i: F.when(t != "", i + 1)))
    width = F.coalesce(used, F.size("texts"))
    return detect_header(grid).select(
        *SHEET, "header_idx", width.alias("width"), F.slice("texts", F.lit(1), width).alias("headers")
    )


def sheet_rows(grid: DataFrame, serial_dates: bool = True) -> DataFrame:
    """(source_uri, sheet, row_idx, headers, values): data rows cut and padded to the header.

    Blank rows are dropped.  With ``serial_dates``, numbers below a date header
    are read as spreadsheet day numbers.  The grid is read twice: for the headers, one row
    per sheet, and for the rows that they are joined to.
    """
    heads = header_rows(grid).withColumnsRenamed({c: f"_{c}" for c in SHEET})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in SHEET]
    rows = grid.join(heads, [*same, F.col("row_idx") > F.col("header_idx")])

    def text_at(header: Column, i: Column) -> Column:
        cell = F.get(F.col("cells"), i)
        plain = F.coalesce(cell_text(cell), F.lit(""))
        if not serial_dates:
            return plain
        day = dates.serial_to_date(F.when(cell["t"] == "n", F.trim(cell["v"])).try_cast("double"))
        return F.when(dates.is_date_header(header), F.coalesce(day, plain)).otherwise(plain)

    values = F.transform("headers", text_at)
    rows = rows.select(*SHEET, "row_idx", "headers", values.alias("values"))
    return rows.filter(F.exists("values", lambda v: F.trim(v) != ""))


def sheet_cells(rows: DataFrame) -> DataFrame:
    """Long form of ``sheet_rows``: one row per cell with its 0-based column and header."""
    exploded = rows.select(*SHEET, "row_idx", "headers", F.posexplode("values").alias("col_idx", "value"))
    header = F.nullif(F.get("headers", F.col("col_idx")), F.lit(""))
    name = F.coalesce(header, F.concat(F.lit("col_"), F.col("col_idx")))
    return exploded.select(*SHEET, "row_idx", "col_idx", name.alias("header"), "value")


def sheet_table(grid: DataFrame, source_uri: str, sheet: str, serial_dates: bool = True) -> DataFrame:
    """One sheet as a table of string columns named by its header row.

    Reads one header row to the driver, which fixes the column names.
    """
    one = grid.filter((F.col("source_uri") == source_uri) & (F.col("sheet") == sheet))
    found = header_rows(one).select("headers").take(1)
    if not found:
        raise ValueError(f"no rows for sheet {sheet!r} of {source_uri!r}")
    return named_values(sheet_rows(one, serial_dates), found[0]["headers"])


def named_values(rows: DataFrame, headers: Sequence[str]) -> DataFrame:
    """The values of ``sheet_rows`` as columns named by a header row."""
    return rows.select(*[F.get("values", F.lit(i)).alias(n) for i, n in enumerate(header_names(headers))])


def non_blank_counts(df: DataFrame) -> DataFrame:
    """One row: for every column, how many values hold text.  A single pass."""
    return df.agg(
        *[F.count_if(F.trim(F.col(f"`{c}`").cast("string")) != "").alias(c) for c in df.columns]
    )


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns without any text.  Runs one aggregate to learn which."""
    counts = non_blank_counts(df).first()
    kept = [c for c, n in zip(df.columns, counts, strict=True) if n]
    return df.select(*[F.col(f"`{c}`") for c in kept])


def snake_columns(df: DataFrame) -> DataFrame:
    """Snake-case, unique column names."""
    return df.toDF(*unique_names(snake_case(c) for c in df.columns))
