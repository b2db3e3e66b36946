"""Aggregates that stay exact and cheap when rows repeat a grain key.

Shapes used throughout: reduce to the grain first (map-side combine keeps a hot
key to one row per task), then add up; never expand rows per distinct count, and
never join two fan-out sides before averaging.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.functions.numbers import percent_of


def at_grain(df: DataFrame, groups: Sequence[str], grain: str, flags: Mapping[str, Column]) -> DataFrame:
    """One row per (groups, grain): row count ``rows`` and, per flag, whether any row set it.

    The NULL grain keeps its rows for row counts but has all flags 0, so loan
    counts built on the flags leave it out.
    """
    known = F.col(grain).isNotNull()
    marks = [F.max((known & F.coalesce(f, F.lit(False))).cast("int")).alias(name) for name, f in flags.items()]
    return df.groupBy(*groups, grain).agg(F.count(F.lit(1)).alias("rows"), *marks)


def distinct_counts(df: DataFrame, groups: Sequence[str], grain: str, flags: Mapping[str, Column]) -> DataFrame:
    """Per group: for each flag, the number of distinct grain keys with it, and ``rows``."""
    reduced = at_grain(df, groups, grain, flags)
    sums = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ["rows", *flags]]
    return reduced.groupBy(*groups).agg(*sums) if groups else reduced.agg(*sums)


def month_roles(
    df: DataFrame, grain: str, worked: str, closed: str, closed_flag: str, value: str | None = None
) -> DataFrame:
    """Per month and grain key: what the key did there, as ``worked``, ``closed``, ``submissions``.

    A row counts in its ``worked`` month and, when flagged, in its ``closed``
    month.  This replaces a join on ``worked = month OR closed = month``: rows
    are unpivoted into (month, role) and added up once, combined in their task before
    the one shuffle.  With ``value``, its largest amount per role is carried along as
    ``worked_top`` and ``closed_top``.  The flags stay 0 for the NULL key.
    """
    names = ("month_start", "worked", "closed", "submissions", *(("worked_top", "closed_top") if value else ()))
    known, zero = F.col(grain).isNotNull().cast("int"), F.lit(0)

    def entry(month: str, did: tuple[Column, Column], rows: int, tops: tuple[Column, Column]) -> Column:
        parts = (F.col(month).cast("date"), *did, F.lit(rows).cast("bigint"), *(tops if value else ()))
        return F.struct(*[part.alias(name) for part, name in zip(parts, names, strict=True)])

    none = F.lit(None).cast("double")
    top = F.col(value).cast("double") if value else none
    as_worked = F.when(F.col(worked).isNotNull(), entry(worked, (known, zero), 1, (top, none)))
    as_closed = F.when(F.col(closed).isNotNull() & (F.col(closed_flag) == 1), entry(closed, (zero, known), 0, (none, top)))
    rows = df.select(grain, F.inline(F.array(as_worked, as_closed))).filter("month_start is not null")
    tops = [F.max(c).alias(c) for c in names[4:]]
    return rows.groupBy("month_start", grain).agg(
        F.max("worked").alias("worked"), F.max("closed").alias("closed"), F.sum("submissions").alias("submissions"), *tops
    )


def share_of_total(df: DataFrame, count: str, within: Sequence[str], total: str, percent: str) -> DataFrame:
    """Add the group total and the row's percentage of it.

    Meant for aggregated rows, of which a group has a handful.
    """
    whole = F.sum(count).over(Window.partitionBy(*within))
    with_total = df.withColumn(total, whole)
    return with_total.withColumn(percent, percent_of(F.col(count), F.col(total)).cast("decimal(5,2)"))


def pivot_sums(df: DataFrame, index: Sequence[str], column: str, value: str, names: Mapping[str, str], total: str) -> DataFrame:
    """Sum of ``value`` per listed value of ``column``, and over all values."""
    parts = [
        F.sum(F.when(F.col(column) == key, F.col(value)).otherwise(0)).alias(name) for key, name in names.items()
    ]
    return df.groupBy(*index).agg(*parts, F.sum(value).alias(total))


def apply_slicers(df: DataFrame, slicers: Mapping[str, object] | None) -> DataFrame:
    """Dashboard filters: a column mapped to one value or to a list of accepted values."""
    for column, accepted in (slicers or {}).items():
        values = list(accepted) if isinstance(accepted, (list, tuple, set)) else [accepted]
        df = df.filter(F.col(column).isin(values))
    return df
