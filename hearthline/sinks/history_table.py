"""Type-2 versions kept in a table that batches are merged into.

``closed`` folders hold versions that have ended; they are added and never rewritten.
Current versions lie in hash buckets of their key, one live folder per bucket.  A batch
meets only the current versions of the buckets its keys fall into: these are rewritten,
all other files keep their names.  A merge becomes visible with one commit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.operators.history import scd2
from hearthline.session import settle
from hearthline.sinks.commits import CommitLog, Taken

SEEN, FROM, BUCKET = "_seen", "_from", "_bucket"


class HistoryTable:
    """Versions of ``keys`` by the ``tracked`` columns, from rows ordered by (at, tiebreak).

    ``buckets`` is chosen with the table and kept by its log: a bucket is what a single
    changed key costs to rewrite.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], at: str, tracked: Sequence[str],
        tiebreak: Sequence[str], buckets: int = 64,
    ) -> None:
        self.log = CommitLog(spark, path)
        self.keys, self.at, self.tracked, self.tiebreak = list(keys), at, list(tracked), list(tiebreak)
        self.buckets = self.log.read()[1].get("buckets", buckets)
        kinds = {f.name: f.dataType for f in schema.fields}
        order = T.StructType([T.StructField(c, kinds[c]) for c in (at, *self.tiebreak)])
        states = [T.StructField(c, kinds[c]) for c in (*self.keys, *self.tracked)]
        self.row = T.StructType([T.StructField(c, kinds[c]) for c in dict.fromkeys([*self.keys, at, *self.tiebreak, *self.tracked])])
        self.closed = T.StructType([*states, T.StructField("valid_from", kinds[at]), T.StructField("valid_to", kinds[at])])
        self.current = T.StructType([*states, T.StructField("valid_from", kinds[at]), T.StructField(SEEN, order)])

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _order(self) -> Column:
        return F.struct(self.at, *self.tiebreak)

    def _current(self, state: Mapping, buckets: Sequence[int]) -> DataFrame:
        live = state.get("current", {})
        return self.log.rows([f"{live[str(b)]}/{BUCKET}={b}" for b in buckets if str(b) in live], self.current)

    def read(self) -> DataFrame:
        """All versions: keys, tracked, valid_from, valid_to, is_current."""
        _, state = self.log.read()
        closed = self.log.rows(state.get("closed", []), self.closed).withColumn("is_current", F.lit(False))
        current = self._current(state, sorted(map(int, state.get("current", {})))).drop(SEEN)
        end = F.lit(None).cast(self.closed["valid_to"].dataType)
        return closed.unionByName(current.withColumns({"valid_to": end, "is_current": F.lit(True)})).select(closed.columns)

    def read_late(self) -> DataFrame:
        """Rows that came after a later row of their key; they are kept apart and change no version."""
        return self.log.rows(self.log.read()[1].get("late", []), self.row)

    def merge(self, batch: DataFrame, batch_id: str) -> dict:
        """Merge a batch, once for each ``batch_id``; returns its status and counts.

        A row that isn't after its key's last one is late.  NULL keys are a key like any
        other.  If another batch is committed meanwhile, this one is merged again.
        """
        rows = settle(batch.select(*self.row.names).withColumn(BUCKET, self._bucket()), "batch")
        while True:
            number, state = self.log.read()
            if batch_id in state.get("batches", []):
                return {"status": "known", "buckets": 0, "late": 0, "closed": 0}
            try:
                return self._merge(rows, batch_id, number, state)
            except Taken:
                continue

    def _merge(self, rows: DataFrame, batch_id: str, number: int, state: dict) -> dict:
        touched = sorted(r[0] for r in rows.select(BUCKET).distinct().collect())
        current = self._current(state, touched)
        same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in self.keys]
        known = current.select(*[F.col(k).alias(f"_of_{k}") for k in self.keys], SEEN)
        judged = rows.join(known, same, "left").withColumn("_late", F.coalesce(self._order() <= F.col(SEEN), F.lit(False)))
        judged = settle(judged.select(*self.row.names, "_late"), "judged")
        fresh = judged.where("not _late").select(*self.row.names, F.col(self.at).alias(FROM))
        # A current version goes on from the last row of its key, and began when it began.
        order = [F.col(f"{SEEN}.{c}").alias(c) for c in (self.at, *self.tiebreak)]
        going_on = current.select(*self.keys, *order, *self.tracked, F.col("valid_from").alias(FROM))
        both = settle(going_on.unionByName(fresh), "open")
        versions = settle(scd2(both, self.keys, self.at, self.tracked, self.tiebreak, since=FROM), "versions")
        last = both.groupBy(*[F.col(k).alias(f"_of_{k}") for k in self.keys]).agg(F.max(self._order()).alias(SEEN))

        folder = {kind: self.log.new_folder(kind) for kind in ("closed", "current", "late")}
        ended = versions.where("not is_current").select(*self.closed.names)
        ended.write.parquet(f"{self.log.path}/{folder['closed']}")
        opened = versions.where("is_current").join(last, same).select(*self.current.names, self._bucket().alias(BUCKET))
        opened.repartition(F.col(BUCKET)).write.partitionBy(BUCKET).parquet(f"{self.log.path}/{folder['current']}")
        late = judged.where("_late").select(*self.row.names)
        n_late, n_closed = late.count(), ended.count()
        made = {
            "buckets": self.buckets, "batches": [*state.get("batches", []), batch_id],
            "closed": [*state.get("closed", []), *([folder["closed"]] if n_closed else [])],
            "current": {**state.get("current", {}), **{str(b): folder["current"] for b in touched}},
            "late": [*state.get("late", []), *([folder["late"]] if n_late else [])],
        }
        if n_late:
            late.write.parquet(f"{self.log.path}/{folder['late']}")
        self.log.commit(number, made)
        return {"status": "merged", "buckets": len(touched), "late": n_late, "closed": n_closed}
