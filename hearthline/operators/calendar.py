"""Day calendars and the month axis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.functions import dates


def days(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day, both ends included, in ``date_key``."""
    bounds = spark.range(1).select(F.lit(first).cast("date").alias("lo"), F.lit(last).cast("date").alias("hi"))
    return days_between(bounds, F.col("lo"), F.col("hi"))


def days_between(df: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """Every day from the smallest ``lo`` to the largest ``hi`` found in ``df``."""
    span = df.agg(F.min(lo).cast("date").alias("lo"), F.max(hi).cast("date").alias("hi"))
    return span.select(F.explode(F.expr("sequence(lo, hi, interval 1 day)")).alias("date_key"))


def staging_calendar(calendar: DataFrame) -> DataFrame:
    """Attributes with weeks starting on Sunday = 1 and a boolean weekend."""
    day = F.col("date_key")
    weekday = F.dayofweek(day)
    return calendar.select(
        day,
        dates.date_key(day).alias("date_id"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        weekday.alias("day_of_week"),
        F.weekofyear(day).alias("week_of_year"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM").alias("month_name"),
        dates.year_month(day).alias("year_month"),
        weekday.isin(1, 7).alias("is_weekend"),
    )


def curated_calendar(calendar: DataFrame) -> DataFrame:
    """Attributes with weeks starting on Monday = 1 and a 0/1 weekend."""
    day = F.col("date_key")
    weekday = F.weekday(day) + 1
    quarter = F.concat(F.lit("Q"), F.quarter(day))
    return calendar.select(
        day.alias("date"),
        F.year(day).alias("year"),
        F.month(day).alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "MMM").alias("month_short"),
        dates.year_month(day).alias("year_month"),
        dates.month_sort(day).alias("year_month_sort"),
        quarter.alias("quarter"),
        F.concat_ws("-", F.year(day), quarter).alias("year_quarter"),
        F.dayofmonth(day).alias("day"),
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        dates.month_start(day).alias("month_start"),
        F.last_day(day).alias("month_end"),
        (weekday >= 6).cast("int").alias("is_weekend"),
    )


def month_spine(df: DataFrame, *month_columns: str, blank_row: bool = False) -> DataFrame:
    """Distinct months found in any of the columns, with labels and sort keys.

    All columns are unpivoted in one pass, so the input is read once.
    ``blank_row`` adds the row a month slicer shows for missing months.
    """
    stacked = df.select(F.explode(F.array(*[F.col(c).cast("date") for c in month_columns])).alias("month_start"))
    month = F.col("month_start")
    spine = stacked.filter(month.isNotNull()).distinct().select(
        month,
        dates.month_label(month).alias("month_label"),
        F.year(month).alias("year"),
        F.month(month).alias("month_num"),
        dates.month_sort(month).alias("year_month_sort"),
    )
    if not blank_row:
        return spine
    nothing = F.lit(None)
    blank = df.sparkSession.range(1).select(
        nothing.cast("date").alias("month_start"),
        F.lit("Blank").alias("month_label"),
        nothing.cast("int").alias("year"),
        nothing.cast("int").alias("month_num"),
        F.lit(0).alias("year_month_sort"),
    )
    return spine.unionByName(blank)
