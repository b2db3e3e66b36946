"""A file stream kept as latest rows per key.

Every batch adds its own latest rows, dealt to hash buckets of their key; nothing that is
stored is rewritten, so the cost of a batch follows the batch and not the table.  Readers
take the latest row per key.  Compaction rewrites the buckets that have gathered many rows
since they were compacted last, while batches go on: a commit names what is live, and a
batch that was added meanwhile stays beside the compacted rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hearthline.operators.dedupe import latest_per_key
from hearthline.sinks.commits import CommitLog

BUCKET, BATCH = "_bucket", "_batch"
BUCKETS = 16


class LatestLog:
    """Rows below ``path`` in folders ``_bucket=.../_batch=...``, and which of these are live.

    The number of buckets is chosen with the first batch.  The state lists the folders of
    each bucket with their rows: batches since its last compaction, and the compacted one.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, newest: str, buckets: int = BUCKETS) -> None:
        self.spark, self.key, self.newest = spark, key, newest
        self.log = CommitLog(spark, path)
        self.buckets = self.log.read()[1].get("buckets", buckets)

    def _write(self, rows: DataFrame, folder: str) -> dict[str, int]:
        """Write rows under a folder name of their own; returns how many are in each bucket."""
        bucket = F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(self.buckets)).cast("int")
        marked = rows.withColumns({BUCKET: bucket, BATCH: F.lit(folder)})
        marked.write.mode("append").partitionBy(BUCKET, BATCH).parquet(self.log.path)
        folders = [f for b in range(self.buckets) if self.log.exists(f := f"{BUCKET}={b}/{BATCH}={folder}")]
        if not folders:
            return {}
        shape = T.StructType([*rows.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        back = self.spark.read.schema(shape).option("basePath", self.log.path).parquet(*[f"{self.log.path}/{f}" for f in folders])
        held = back.groupBy(BUCKET).agg(F.count("*").alias("n"))
        return {str(r[BUCKET]): r["n"] for r in held.collect()}

    def upsert(self, batch: DataFrame, folder: str | None = None, stream: str | None = None, number: int | None = None) -> None:
        """Add a batch.  One of a stream is added once for each number; any batch added again changes nothing for readers."""
        _, state = self.log.read()
        if stream is not None and state.get("streams", {}).get(stream, -1) >= number:
            return
        folder = folder or self.log.new_folder("batch").partition("/")[2]
        rows = latest_per_key(batch, self.key, self.newest)
        held = self._write(rows, folder)

        def added(state: dict) -> dict | None:
            streams = state.get("streams", {})
            if stream is not None and streams.get(stream, -1) >= number:
                return None
            live = state.get("live", {})
            for b, n in held.items():
                live[b] = [*live.get(b, []), [folder, n, False]]
            marks = streams if stream is None else {**streams, stream: number}
            return {"buckets": self.buckets, "schema": rows.schema.jsonValue(), "live": live, "streams": marks}

        self.log.change(added)

    def _rows(self, state: dict, buckets: list[str] | None = None) -> DataFrame | None:
        if "schema" not in state:
            return None
        live = state["live"]
        folders = [f"{BUCKET}={b}/{BATCH}={f}" for b in (live if buckets is None else buckets) for f, _, _ in live[b]]
        return self.log.rows(folders, T.StructType.fromJson(state["schema"]))

    def read(self) -> DataFrame | None:
        """The latest row of each key; None before the first batch."""
        rows = self._rows(self.log.read()[1])
        return None if rows is None else latest_per_key(rows, self.key, self.newest)

    def compact(self, over: int = 0) -> list[int]:
        """Rewrite the buckets with more than ``over`` rows added since their last compaction; returns them.

        Batches may be added meanwhile; a bucket that another compaction has rewritten since
        is left to that one.
        """
        _, state = self.log.read()
        live = state.get("live", {})
        due = sorted((b for b, held in live.items() if sum(n for _, n, whole in held if not whole) > over), key=int)
        if not due:
            return []
        folder = self.log.new_folder("whole").partition("/")[2]
        held = self._write(latest_per_key(self._rows(state, due), self.key, self.newest), folder)
        done: list[str] = []

        def replaced(now: dict) -> dict:
            done.clear()
            for b in due:
                n = len(live[b])
                if now["live"][b][:n] == live[b]:
                    now["live"][b] = [[folder, held.get(b, 0), True], *now["live"][b][n:]]
                    done.append(b)
            return now

        self.log.change(replaced)
        return [int(b) for b in done]

    def vacuum(self) -> int:
        """Delete folders that no longer are live, for when no reader of an earlier state is under way; returns how many.

        Folders of the batches and compactions that run now must not be deleted, so none may run.
        """
        live = {f"{BUCKET}={b}/{BATCH}={f}" for b, held in self.log.read()[1].get("live", {}).items() for f, _, _ in held}
        return self.log.drop_others(live)


def upsert(batch: DataFrame, path: str, key: str, newest: str) -> None:
    """Add a batch.  Adding the same batch again changes nothing for readers."""
    LatestLog(batch.sparkSession, path, key, newest).upsert(batch)


def stream_latest(
    spark: SparkSession, source: str, schema: T.StructType, path: str, checkpoint: str, key: str, newest: str
) -> StreamingQuery:
    """Take in all files that are new since the last run, then stop."""
    landed = spark.readStream.schema(schema).parquet(source)

    def merge(batch: DataFrame, number: int) -> None:
        LatestLog(batch.sparkSession, path, key, newest).upsert(batch, stream=checkpoint, number=number)

    writer = landed.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def read_latest(spark: SparkSession, path: str, key: str, newest: str) -> DataFrame:
    found = LatestLog(spark, path, key, newest).read()
    if found is None:
        raise ValueError(f"no batch was added to {path}")
    return found


def compact(spark: SparkSession, path: str, key: str, newest: str, over: int = 0) -> None:
    """Rewrite the buckets with more than ``over`` new rows and delete what they replace, for when nobody reads."""
    log = LatestLog(spark, path, key, newest)
    log.compact(over)
    log.vacuum()
