"""Versions over time.

Looking at the previous or next row of a key needs an order, and one key may
hold a large share of all rows, even of one day.  So rows are range partitioned by
(key, order): a hot key lies in many partitions, and what crosses the border of two
is one row per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.session import settle

PART = "_part"


def in_ranges(df: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """The rows dealt to ranges of ``order``, each with the number of its range, and written."""
    return settle(df.repartitionByRange(*order).withColumn(PART, F.spark_partition_id()), label)


def beside(ranged: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, name: str, step: int = -1) -> DataFrame:
    """Add ``name``: struct(v) of ``value`` in the previous (-1) or next (+1) row of the key.

    NULL at the end of a key; a NULL key is a key like any other.  ``ranged`` comes from
    ``in_ranges`` over (keys, order), which must be total.  One shuffle of the rows; what is
    broadcast is one row per range.
    """
    entry = F.struct(F.struct(*keys).alias("k"), value.alias("v"))
    reach, edge = (F.lag, F.max_by) if step < 0 else (F.lead, F.min_by)
    edges = ranged.groupBy(F.col(PART).alias("_of")).agg(edge(entry, F.struct(*keys, *order)).alias("_edge"))
    carried = edges.select("_of", reach("_edge").over(Window.orderBy("_of")).alias("_carried"))
    near = ranged.withColumn("_near", reach(entry).over(Window.partitionBy(PART).orderBy(*keys, *order)))
    joined = near.join(F.broadcast(carried), F.col(PART) == F.col("_of"))
    found = F.coalesce("_near", "_carried")
    same = found["k"].eqNullSafe(F.struct(*keys))
    return joined.withColumn(name, F.when(same, F.struct(found["v"].alias("v")))).drop("_near", "_of", "_carried")


def scd2(df: DataFrame, keys: Sequence[str], at: str, tracked: Sequence[str], tiebreak: Sequence[str], since: str | None = None) -> DataFrame:
    """Type-2 versions: (keys, tracked, valid_from, valid_to, is_current).

    A version starts where a tracked value differs from the row before, at the time ``at``,
    or at that of the column ``since``.  All rows are shuffled twice, the starts of versions
    once more.
    """
    state = F.struct(*tracked)
    order = [at, *tiebreak]
    start = since or at
    rows = in_ranges(df.select(*dict.fromkeys([*keys, at, *tiebreak, *tracked, start])), [*keys, *order], "ranges")
    seen = beside(rows, keys, order, state, "_before", -1)
    changed = settle(seen.filter(F.col("_before").isNull() | ~F.col("_before.v").eqNullSafe(state)).drop("_before"), "starts")
    ended = beside(changed, keys, order, F.col(start), "_after", +1)
    return ended.select(
        *keys,
        *tracked,
        F.col(start).alias("valid_from"),
        F.col("_after.v").alias("valid_to"),
        F.col("_after").isNull().alias("is_current"),
    )


def daily_snapshot(df: DataFrame, snapshot_date: Column, columns: Sequence[str]) -> DataFrame:
    """The columns as they stand on a day; publish with ``daily_partition`` to keep one per day."""
    return df.select(snapshot_date.cast("date").alias("snapshot_date"), *columns)
