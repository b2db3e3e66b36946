"""Rows that failed their tests, kept until a fix lets them through.

A letter is a row with the names of the tests it failed, the number of attempts, and a
name of its own.  Reprocessing applies a fix to the open letters and tests them again:
rows that pass are recovered, once for each key, the others stay open with their new
reasons.  All of it becomes visible with one commit.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.operators.dedupe import row_hash
from hearthline.operators.quality import split_bad_records
from hearthline.session import settle
from hearthline.sinks.commits import CommitLog, Taken

LETTER = [T.StructField("reasons", T.ArrayType(T.StringType())), T.StructField("attempt", T.IntegerType()), T.StructField("letter", T.StringType())]
REPEATED = "repeated key"


class DeadLetters:
    """The letters of a table of rows with this schema and key."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str]) -> None:
        self.log = CommitLog(spark, path)
        self.row, self.key = schema, list(key)
        self.stored = T.StructType([*schema.fields, *LETTER])

    def open(self) -> DataFrame:
        """Letters that no fix has let through: the row, reasons, attempt, letter."""
        return self.log.rows(self.log.read()[1].get("open", []), self.stored)

    def recovered(self) -> DataFrame:
        """Rows that a fix has let through, one for each key."""
        return self.log.rows(self.log.read()[1].get("recovered", []), self.row)

    def add(self, bad: DataFrame, batch_id: str) -> int:
        """Store the rows that ``split_bad_records`` found bad, once for each ``batch_id``; returns how many."""
        if batch_id in self.log.read()[1].get("batches", []):
            return 0
        folder = self.log.new_folder("open")
        named = F.concat(F.lit(f"{batch_id}:"), F.monotonically_increasing_id())
        bad.select(*self.row.names, "reasons", F.lit(1).alias("attempt"), named.alias("letter")).write.parquet(f"{self.log.path}/{folder}")

        def added(state: dict) -> dict | None:
            if batch_id in state.get("batches", []):
                return None
            return {**state, "batches": [*state.get("batches", []), batch_id], "open": [*state.get("open", []), folder]}

        self.log.change(added)
        return self.log.rows([folder], self.stored).count()

    def reprocess(self, fix: Callable[[DataFrame], DataFrame], *tests: tuple[str, Column]) -> dict:
        """Apply ``fix`` to the open letters and test them again; returns how many were recovered, changed, and are open.

        ``fix`` gets the letters and returns them with changed columns.  A letter whose row
        and reasons stay as they were counts no attempt, so a second run of the same fix
        changes nothing.  Of rows of one key, the letter with the smallest name is recovered,
        unless the key was before; the others stay open as repeated.
        """
        while True:
            number, state = self.log.read()
            try:
                return self._reprocess(fix, tests, number, state)
            except Taken:
                continue

    def _reprocess(self, fix: Callable[[DataFrame], DataFrame], tests: Sequence[tuple[str, Column]], number: int, state: dict) -> dict:
        letters = self.log.rows(state.get("open", []), self.stored)
        before = letters.withColumns({"_row": row_hash(letters, self.row.names), "_why": F.array_sort("reasons")})
        fixed = fix(before).drop("reasons")
        good, bad = split_bad_records(fixed, *tests)
        judged = settle(good.withColumn("reasons", F.array().cast("array<string>")).unionByName(bad), "judged")
        # One letter of each key is let through, if none was before.
        passed = judged.where(F.size("reasons") == 0)
        first = passed.groupBy(*self.key).agg(F.min("letter").alias("_first"))
        known = self.log.rows(state.get("recovered", []), self.row).select(*[F.col(k).alias(f"_known_{k}") for k in self.key]).distinct()
        first = first.join(known, [F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in self.key], "left_anti")
        chosen = settle(first.select(F.col("_first")), "chosen")
        marked = judged.join(chosen, F.col("letter") == F.col("_first"), "left")
        reasons = F.when(F.size("reasons") > 0, F.col("reasons")).when(F.col("_first").isNull(), F.array(F.lit(REPEATED)))
        marked = marked.withColumn("reasons", reasons)
        changed = (row_hash(marked, self.row.names) != F.col("_row")) | ~F.array_sort("reasons").eqNullSafe(F.col("_why"))
        out = settle(marked.withColumn("_changed", F.coalesce(changed, F.lit(True))), "reprocessed")
        recovered, dead = out.where("reasons is null"), out.where("reasons is not null")
        n_good, n_changed, n_dead = out.agg(
            F.count_if(F.col("reasons").isNull()), F.count_if(F.col("reasons").isNotNull() & F.col("_changed")), F.count_if(F.col("reasons").isNotNull())
        ).first()
        if n_good or n_changed:
            folder = {kind: self.log.new_folder(kind) for kind in ("open", "recovered")}
            tried = F.col("attempt") + F.col("_changed").cast("int")
            dead.withColumn("attempt", tried).select(*self.stored.names).write.parquet(f"{self.log.path}/{folder['open']}")
            recovered.select(*self.row.names).write.parquet(f"{self.log.path}/{folder['recovered']}")
            self.log.commit(number, {**state, "open": [folder["open"]], "recovered": [*state.get("recovered", []), folder["recovered"]]})
        return {"recovered": n_good, "changed": n_changed, "open": n_dead}
