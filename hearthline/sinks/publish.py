"""Snapshots, dated partitions, catalog tables and refreshes.

Every function here runs the write it is named after.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hearthline.sinks import pointers

ROWS_PER_PARTITION = 10_000


def target_partitions(rows: int, per_partition: int = ROWS_PER_PARTITION, most: int | None = None) -> int:
    """Output partitions for a known row count; ``most`` limits them where a small cluster asks for that."""
    wanted = max(1, rows // per_partition)
    return wanted if most is None else min(most, wanted)


def write_sized(df: DataFrame, path: str, rows: int, per_partition: int = ROWS_PER_PARTITION) -> None:
    """Write in as many partitions as a known number of rows asks for."""
    df.repartition(target_partitions(rows, per_partition)).write.mode("overwrite").parquet(path)


def balanced(df: DataFrame, *by: str) -> DataFrame:
    """Ask for evenly sized output files; a partition that is too large is split.

    The size is ``spark.sql.adaptive.advisoryPartitionSizeInBytes``, so small
    tables end up in one file and large ones in as many as they need.
    """
    return df.hint("rebalance", *by) if by else df.hint("rebalance")


def lineage_columns(df: DataFrame, stamps: Mapping[str, str | Column]) -> DataFrame:
    """Add constant run columns such as ``_etl_loaded_at``, ``dt`` or ``_source_sheet``."""
    return df.withColumns({n: v if isinstance(v, Column) else F.lit(v) for n, v in stamps.items()})


def extraction_stamps(run_ts: str, source: str, collection: str) -> dict[str, str]:
    """Landing stamps; ``run_ts`` is ``yyyy-MM-dd HH:mm:ss`` in UTC."""
    return {
        "_etl_extracted_at": run_ts,
        "_etl_extraction_date": run_ts[:10],
        "_etl_source": source,
        "_etl_collection": collection,
    }


def write_raw(df: DataFrame, path: str, mode: str = "full") -> None:
    """``full`` replaces the folder, ``incremental`` adds to it."""
    how = {"full": "overwrite", "incremental": "append"}[mode]
    balanced(df).write.mode(how).option("compression", "snappy").parquet(path)


def write_staging(df: DataFrame, path: str) -> None:
    balanced(df).write.mode("overwrite").parquet(path)


def write_verified(df: DataFrame, path: str, mode: str = "full") -> dict[str, object]:
    """Write and compare the rows that went in with the rows found afterwards.

    The first number is observed during the write, the second comes from the footers of
    the files that the write has added, so the input is computed once and older files
    aren't opened.
    """
    spark = df.sparkSession
    before = _files(spark, path) if mode == "incremental" else set()
    seen = Observation()
    write_raw(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, mode)
    expected = seen.get["rows"]
    added = sorted(_files(spark, path) - before)
    written = spark.read.parquet(*added).count() if added else 0
    return {"records": expected, "written": written, "missing": expected - written,
            "status": "success" if expected == written else "mismatch"}


def _files(spark: SparkSession, path: str) -> set[str]:
    """The data files directly in a folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    found = system.listStatus(target) if system.exists(target) else []
    return {f.getPath().toString() for f in found if f.isFile() and not f.getPath().getName().startswith(("_", "."))}


def skip_if_empty(df: DataFrame, write: Callable[[DataFrame], Mapping[str, object]], fail: bool = False) -> dict:
    """Write only when there are rows; otherwise report ``skipped`` or raise."""
    if df.isEmpty():
        if fail:
            raise ValueError("the input has no rows")
        return {"records": 0, "status": "skipped"}
    return dict(write(df))


def publish(df: DataFrame, path: str, mode: str, dt: str) -> None:
    """``snapshot`` replaces the table and keeps ``dt`` as a column; ``daily_partition``
    replaces only that day's partition and keeps history."""
    stamped = df.withColumn("dt", F.lit(dt))
    if mode == "snapshot":
        balanced(stamped).write.mode("overwrite").option("compression", "snappy").parquet(path)
    elif mode == "daily_partition":
        writer = balanced(stamped).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("dt").option("compression", "snappy").parquet(path)
    else:
        raise ValueError(f"mode must be snapshot or daily_partition, not {mode!r}")


def write_partitioned_report(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """A report in folders by the given columns; a rerun replaces the folders it produces.

    Rows are gathered by those columns first, so a folder gets few files, and a
    folder with most of the rows is split into several.
    """
    writer = balanced(df, *columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*columns).parquet(path)


def write_compact(df: DataFrame, path: str) -> None:
    """As few files as the rows fill: one for a small table."""
    balanced(df).write.mode("overwrite").parquet(path)


def register_table(
    spark: SparkSession, database: str, table: str, location: str, partitioned: bool = False
) -> str:
    """A name in the catalog for a written folder, with the folder's schema.

    Another folder or schema is registered as a table of its own, and the name is pointed
    at it in one step, so readers never find it missing.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {pointers.quoted(database)}")
    name = f"{database}.{table}"
    known = pointers.target_of(spark, name)
    if known is None or not _stands_for(spark, known, location):
        known = pointers.new_version(spark, name)
        spark.catalog.createTable(known, path=location, source="parquet")
        if partitioned:
            spark.catalog.recoverPartitions(known)
        pointers.point(spark, name, known)
    else:
        spark.catalog.refreshTable(known)
        if partitioned:
            spark.catalog.recoverPartitions(known)
    return pointers.quoted(name)


def _stands_for(spark: SparkSession, table: str, location: str) -> bool:
    """Whether a table lies in the folder and has its present schema."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    held = spark.sql(f"DESCRIBE EXTENDED {pointers.quoted(table)}").where("col_name = 'Location'").first()["data_type"]
    same = path(path(held).toUri().getPath()).equals(path(path(location).toUri().getPath()))
    return same and spark.table(table).schema == spark.read.parquet(location).schema


def add_new_partitions(spark: SparkSession, table: str) -> None:
    """Make partitions written since the last registration visible to pruning."""
    spark.catalog.recoverPartitions(pointers.target_of(spark, table) or table)


def define_view(df: DataFrame, name: str) -> DataFrame:
    """An always fresh view in this session, usable by name in SQL."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def define_stored_view(spark: SparkSession, name: str, query: str) -> DataFrame:
    """An always fresh view in the catalog, which other sessions see too; its tables must be in the catalog."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
    return spark.table(name)


def refresh_snapshot_tables(
    spark: SparkSession,
    queries: Mapping[str, Callable[[], DataFrame]],
    refreshed_at: str,
    only: Sequence[str] | None = None,
) -> list[dict]:
    """Recompute report tables, stamped ``_refreshed_at``; one status row per table.

    Each is computed beside the one that readers find, and takes its name in one step; the
    one before stays for ``pointers.rollback``.  A failing table is reported and the others
    go on.
    """
    unknown = set(only or ()) - set(queries)
    if unknown:
        raise ValueError(f"unknown tables: {sorted(unknown)}")
    report = []
    for name, build in queries.items():
        if only and name not in only:
            continue
        try:
            stamp = F.lit(refreshed_at).cast("timestamp")
            version = pointers.new_version(spark, name)
            build().withColumn("_refreshed_at", stamp).write.format("parquet").saveAsTable(version)
            pointers.point(spark, name, version)
            report.append({"table": name, "status": "success", "rows": spark.table(name).count()})
        except Exception as problem:  # noqa: BLE001 - the report carries it
            report.append({"table": name, "status": "error", "message": str(problem)})
    return report


def write_with_layout(df: DataFrame, table: str, distribute: str, sort: Sequence[str], buckets: int) -> None:
    """A table bucketed and sorted by key: joins on that key with a table of as many buckets need no shuffle.

    Rows are gathered by key before, and a task that would get too many of a hot key's is
    split, so a bucket may be several files.
    """
    balanced(df, distribute).write.mode("overwrite").bucketBy(buckets, distribute).sortBy(*sort).format("parquet").saveAsTable(table)


def run_log(spark: SparkSession, report: Sequence[Mapping[str, object]], run_ts: str) -> DataFrame:
    """Run summary rows as a table: source, status, records, written, message, run_ts."""
    rows = [
        (r.get("source") or r.get("table"), r.get("status"), r.get("records", r.get("rows")), r.get("written"), r.get("message"))
        for r in report
    ]
    schema = "source string, status string, records long, written long, message string"
    return spark.createDataFrame(rows, schema).withColumn("run_ts", F.lit(run_ts))


def run_totals(log: DataFrame) -> DataFrame:
    """Sources per status and their record totals."""
    return log.groupBy("status").agg(
        F.count(F.lit(1)).alias("sources"), F.coalesce(F.sum("records"), F.lit(0)).alias("records")
    )
