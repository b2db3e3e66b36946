"""Latest-wins selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def latest_per_key(
    df: DataFrame,
    key: str | Sequence[str],
    newest: str | None = None,
    tiebreak: Sequence[Column] | None = None,
) -> DataFrame:
    """One row per key: the newest, or any fixed one when no time column exists.

    Rows of equal time are ordered by ``tiebreak`` (default: a hash over the
    whole row), so the answer never depends on how the input was split.

    Spark limits each map task to its best row per key before the shuffle
    (``WindowGroupLimit``), so a key holding most of the input costs one row per
    map task, not one task for all of its rows.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = []
    if newest and newest in df.columns:
        order.append(F.col(newest).desc_nulls_last())
    order += list(tiebreak) if tiebreak is not None else [row_hash(df).desc()]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def row_hash(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """A 64-bit hash of the row; maps by their sorted entries, without variants, which have no order."""
    chosen = [f for f in df.schema.fields if f.name in (columns or df.columns) and not isinstance(f.dataType, T.VariantType)]

    def hashable(f: T.StructField) -> Column:
        value = F.col(f"`{f.name}`")
        return F.array_sort(F.map_entries(value)) if isinstance(f.dataType, T.MapType) else value

    return F.xxhash64(*map(hashable, chosen))


def dedupe_report(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """One row: rows in, distinct keys, rows a latest-wins pass removes."""
    keys = [key] if isinstance(key, str) else list(key)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_read"),
        F.count(F.lit(1)).alias("rows_kept"),
        (F.coalesce(F.sum("n"), F.lit(0)) - F.count(F.lit(1))).alias("rows_removed"),
    )
