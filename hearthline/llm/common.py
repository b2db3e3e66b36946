"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence
from functools import cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.session import settle

# Bytes of text that one pass of array code works on.  Its arrays take about thirty times
# that, and two workers share what an executor has beside its heap.
SLICE_BYTES = 2 << 20


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def others(df: DataFrame, *taken: str) -> list[str]:
    """The columns of the input that an operator passes on: all whose names it doesn't use itself."""
    lowered = {t.lower() for t in taken}
    return [c for c in df.columns if c.lower() not in lowered]


def sliced(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in slices of about ``limit`` bytes of a text column; a longer text is a slice of its own."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        waiting.append(batch)
        if sum(b.column(column).nbytes for b in waiting) >= limit:
            yield from cut_up(waiting, column, limit)
            waiting = []
    yield from cut_up(waiting, column, limit)


def cut_up(batches: list[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    for batch in pa.Table.from_batches(batches).combine_chunks().to_batches() if batches else ():
        ends = pc.binary_length(batch.column(column).cast(pa.large_binary())).fill_null(0).to_numpy(zero_copy_only=False).cumsum()
        even = -(-int(ends[-1]) // max(1, -(-int(ends[-1]) // limit))) if len(ends) else 0
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(ends.searchsorted(before + even, "right")))
            yield batch.slice(at, stop - at)
            at = stop


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The input under the names c0, c1, ..., and these names by the input's, so that an operator's own columns clash with none."""
    plain = [f"c{i}" for i in range(len(df.columns))]
    return df.toDF(*plain), dict(zip(df.columns, plain, strict=True))


def restored(found: DataFrame, df: DataFrame, names: dict[str, str], *results: str) -> DataFrame:
    """What an operator found for a numbered input, under the input's names; those named like a result give way to it."""
    return found.select(*[F.col(names[c]).alias(c) for c in others(df, *results)], *results)


Batches = Iterator[pa.RecordBatch]


@cache
def _trim() -> Callable[[int], int] | None:
    """The C library's call that gives free memory back to the machine, where it has one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def returned(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """The same work, after which a task's memory goes back to the machine.

    Workers outlive their tasks, and what array code has used would stay theirs while others
    on the machine, the executor's heap first, need it.
    """

    def run_and_return(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if (trim := _trim()) is not None:
                trim(0)

    return run_and_return


def mapped(df: DataFrame, run: Callable[[Batches], Batches], kept: Sequence[str], added: str) -> DataFrame:
    """``mapInArrow`` for columns of any name: ``kept`` columns of the input, then those of the DDL string ``added``.

    Columns are numbered on the way, as names with dots can't be passed otherwise.
    """
    given = df.columns
    fields = [*(df.schema[c] for c in kept), *T.StructType.fromDDL(added).fields]
    shape = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(fields)])

    def numbered(batches: Batches) -> Batches:
        for out in run(b.rename_columns(given) for b in batches):
            yield out.rename_columns(shape.names)

    return df.toDF(*(f"c{i}" for i in range(len(given)))).mapInArrow(numbered, shape).toDF(*(f.name for f in fields))


def placed(df: DataFrame, within: Sequence[str], order: Sequence[Column], label: str, place: str = "place") -> DataFrame:
    """The rows with their gapless number from 0 among those of equal ``within`` columns.

    Rows are range partitioned by (within, order), so a group of any size is shared by
    many tasks; what is broadcast is one row per partition and group that meet: at most
    the partitions plus the groups, and callers have a bounded number of groups, none of
    them null.  ``order`` decides up to equal rows.  Written in between, as the numbers
    must not depend on how often a task runs.
    """
    spread = df.repartitionByRange(*[col(c) for c in within], *order).sortWithinPartitions(*[col(c) for c in within], *order)
    stored = settle(spread.withColumn("_at", F.monotonically_increasing_id()), label)
    part = F.shiftright("_at", 33)
    runs = stored.groupBy(*[col(c).alias(f"_w{i}") for i, c in enumerate(within)], part.alias("_part")).agg(
        F.min("_at").alias("_low"), F.count("*").alias("_n")
    )
    before = Window.partitionBy(*[f"_w{i}" for i in range(len(within))]).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = runs.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    same = F.shiftright("_at", 33) == F.col("_part")
    for i, c in enumerate(within):
        same = same & (col(c) == F.col(f"_w{i}"))
    return (
        stored.join(F.broadcast(bases), same)
        .withColumn(place, F.col("_at") - F.col("_low") + F.col("_base"))
        .select(*[col(c) for c in df.columns], place)
    )
