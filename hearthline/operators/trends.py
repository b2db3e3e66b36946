"""Month-over-month, year-over-year and correlation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.functions.numbers import percent_of


def growth(monthly: DataFrame, month: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Add the value one and twelve months earlier and the change in percent.

    Months are compared by distance, not by row, so gaps give NULL instead of a
    wrong month.  Input rows are already one per (by, month).
    """
    index = F.year(month) * 12 + F.month(month)
    order = Window.partitionBy(*by).orderBy(index) if by else Window.orderBy(index)
    def earlier(months: int) -> Column:
        return F.sum(value).over(order.rangeBetween(-months, -months))

    out = monthly.withColumns({"previous_month": earlier(1), "previous_year": earlier(12)})
    change = {
        "mom_pct": percent_of(F.col(value) - F.col("previous_month"), F.col("previous_month")),
        "yoy_pct": percent_of(F.col(value) - F.col("previous_year"), F.col("previous_year")),
    }
    return out.withColumns({n: c.cast("decimal(18,2)") for n, c in change.items()})


def correlations(df: DataFrame, outcome: str, drivers: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation of the outcome with each driver, in one pass."""
    found = [F.corr(outcome, d).alias(f"corr_{d}") for d in drivers]
    return df.groupBy(*by).agg(*found) if by else df.agg(*found)
