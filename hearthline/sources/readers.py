"""Scans, incremental slices and the list of sources."""

from __future__ import annotations

import json
import re
import warnings
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from itertools import product

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.schema import Field, empty_raw
from hearthline.sinks.commits import CommitLog


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Parquet whose files may have different columns.

    Where ``remember_schema`` has stored the merged schema, only the footers of files that
    are newer are read for it, else those of all files.
    """
    log = _schema_log(spark, path)
    if not log.read()[0]:
        return spark.read.option("mergeSchema", "true").parquet(path)
    state = remember_schema(spark, path)
    return spark.read.schema(T.StructType.fromJson(state["schema"])).parquet(path)


def _schema_log(spark: SparkSession, path: str) -> CommitLog:
    # Beside the folder, as a full write replaces the folder.
    folder, _, name = path.rstrip("/").rpartition("/")
    return CommitLog(spark, f"{folder}/_schemas/{name}")


def remember_schema(spark: SparkSession, path: str, run_ts: str | None = None, replaced: bool = False) -> dict:
    """Keep the merged schema of a folder's files, and when which columns came; returns the state.

    The state holds the schema, the newest modification time that it covers, the files of
    that time, and one history entry per change.  Columns are only added: one that newer
    files lack stays, and a column whose type changes is an error, as in a merging read.
    """
    log = _schema_log(spark, path)

    def merged(state: dict) -> dict | None:
        mark, known = (None, set()) if replaced else (state.get("mark"), set(state.get("at_mark", [])))
        files = list_files(spark, path).filter(F.col("path").endswith(".parquet")).select("path", "modificationTime")
        fresh = files if mark is None else files.filter(F.unix_millis("modificationTime") >= mark)
        newest = fresh.agg(F.max(F.unix_millis("modificationTime"))).first()[0]
        if newest is None:
            return None
        at_mark = [r["path"] for r in fresh.filter(F.unix_millis("modificationTime") == newest).collect()]
        if mark is None:
            found = spark.read.option("mergeSchema", "true").parquet(path).schema
        else:
            paths = [r["path"] for r in fresh.collect() if r["path"] not in known]
            if not paths:
                return None
            found = spark.read.option("mergeSchema", "true").option("basePath", path).parquet(*paths).schema
        stored = T.StructType.fromJson(state["schema"]) if state else T.StructType()
        before = T.StructType() if replaced else stored
        kinds = {f.name: f.dataType for f in before.fields}
        changed = [f.name for f in found.fields if f.name in kinds and kinds[f.name] != f.dataType]
        if changed:
            raise ValueError(f"columns of {path} have changed their type: {changed}")
        added = [f for f in found.fields if f.name not in kinds]
        fresh_fields = [f for f in added if f not in stored.fields]
        entry = {"run_ts": run_ts, "added": {f.name: f.dataType.simpleString() for f in fresh_fields}}
        return {
            "schema": T.StructType([*before.fields, *added]).jsonValue(), "mark": newest, "at_mark": at_mark,
            "history": [*state.get("history", []), *([entry] if fresh_fields else [])],
        }

    return log.change(merged)


def schema_history(spark: SparkSession, path: str) -> DataFrame:
    """When which columns of a folder were first seen: run_ts, column, type."""
    entries = _schema_log(spark, path).read()[1].get("history", [])
    rows = [(e["run_ts"], name, kind) for e in entries for name, kind in e["added"].items()]
    return spark.createDataFrame(rows, "run_ts string, column string, type string")


def days(first: date, last: date, step: int = 1) -> list[str]:
    """The days from ``first`` to ``last`` as yyyy-MM-dd, every ``step`` days."""
    return [(first + timedelta(days=n)).isoformat() for n in range(0, (last - first).days + 1, step)]


def read_projected(
    spark: SparkSession, base: str, template: str, values: Mapping[str, Iterable[object]], schema: T.StructType | None = None
) -> DataFrame:
    """The partitions with the asked values, by paths worked out from a template; the folder itself isn't listed.

    ``template`` is like ``dt=${dt}`` or ``year=${year}/month=${month}``, and ``values`` has
    the asked values of each name in it.  Folders that aren't there hold no rows.  Columns
    of the template are columns of the result.  Without any folder, ``schema`` (that of the
    files) is needed.
    """
    names = re.findall(r"\$\{(\w+)\}", template)
    if set(names) != set(values):
        raise ValueError(f"the template names {names}, values are given for {sorted(values)}")
    root = base.rstrip("/")
    asked = [
        f"{root}/{re.sub(r'\$\{(\w+)\}', lambda m: str(chosen[m[1]]), template)}"
        for combination in product(*(list(values[n]) for n in names)) for chosen in [dict(zip(names, combination, strict=True))]
    ]
    log = CommitLog(spark, root)
    with ThreadPoolExecutor(16) as pool:
        there = list(pool.map(lambda p: log.exists(p.removeprefix(f"{root}/")), asked))
    paths = [p for p, found in zip(asked, there, strict=True) if found]
    if not paths and schema is None:
        raise ValueError(f"no partition of {root} has the asked values")
    if not paths:
        return spark.createDataFrame([], T.StructType([*schema.fields, *(T.StructField(n, T.StringType()) for n in names)]))
    reader = spark.read.option("basePath", root)
    return (reader if schema is None else reader.schema(schema)).parquet(*paths)


def read_optional(spark: SparkSession, path: str, spec: Sequence[Field] | None = None) -> DataFrame | None:
    """As ``read_raw``; a missing input is warned about and gives an empty table with the raw columns of ``spec``.

    Without a spec it gives None, and the caller leaves the table out.  An input that is
    there but can't be read is an error.
    """
    try:
        return read_raw(spark, path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        warnings.warn(f"no input at {path}", stacklevel=2)
        return empty_raw(spark, spec) if spec is not None else None


def incremental_slice(df: DataFrame, cursor: str | None, days_back: int, as_of: datetime) -> DataFrame:
    """Rows changed in the last ``days_back`` days; everything when there is no cursor.

    The bound is a literal of the column's own type, so it reaches the scan.
    """
    if cursor is None:
        return df
    if cursor not in df.columns:
        raise ValueError(f"no cursor column {cursor!r}; columns are {df.columns}")
    since = as_of - timedelta(days=days_back)
    kind = df.schema[cursor].dataType
    if isinstance(kind, T.StringType):
        return df.filter(F.col(cursor) >= F.lit(since.isoformat()))
    if isinstance(kind, T.TimestampNTZType):
        return df.filter(F.col(cursor) >= F.lit(since.isoformat(sep=" ")).cast("timestamp_ntz"))
    return df.filter(F.col(cursor) >= F.lit(since))


@dataclass(frozen=True)
class Source:
    """One document collection: where it comes from, its change column, its folder."""

    collection: str
    cursor: str | None

    @property
    def name(self) -> str:
        return self.collection.lower()

    def output(self, base: str) -> str:
        return f"{base.rstrip('/')}/{self.name}"


# The collections landed and the column that marks a change.
SOURCES = (
    Source("loans", "updatedAt"),
    Source("correspondents", "updatedAt"),
    Source("users", "updatedAt"),
    Source("loanConditions", "createdAt"),
    Source("loanConditionEvents", "at"),
    Source("loanExceptions", "requestedAt"),
    Source("loanDocuments", "uploadedAt"),
    Source("investors", "updatedAt"),
    Source("holidays", None),
)


def run_each(
    sources: Iterable[Source], job: Callable[[Source], Mapping[str, object]], at_once: int = 1, spark: SparkSession | None = None
) -> list[dict]:
    """Run one job per source, ``at_once`` of them at a time; a failing source is reported and the rest go on.

    The report is in the order of the sources, whichever ends first.  With ``spark``, each
    job's Spark jobs run in a scheduler pool named after its source, so that under fair
    scheduling a large source doesn't hold up small ones.
    """

    def outcome(source: Source) -> dict:
        try:
            if spark is not None:
                spark.sparkContext.setLocalProperty("spark.scheduler.pool", source.name)
            return {"source": source.name, "status": "success", **job(source)}
        except Exception as problem:  # noqa: BLE001 - the report carries it
            return {"source": source.name, "status": "error", "message": str(problem)}
        finally:
            if spark is not None:
                spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    if at_once <= 1:
        return [outcome(source) for source in sources]
    with ThreadPoolExecutor(at_once) as pool:
        # Wrapped one by one: each job gets local properties of its own.
        jobs = [pool.submit(outcome if spark is None else inheritable_thread_target(spark)(outcome), s) for s in sources]
        return [job.result() for job in jobs]


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """path, modificationTime and length of every file below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", "modificationTime", "length")


def latest_per_stem(
    files: DataFrame,
    stems: Sequence[str],
    extensions: Sequence[str] = (".xlsx", ".xls"),
    ignore: Sequence[str] = (),
    anywhere: bool = False,
) -> DataFrame:
    """Newest file per stem: (stem, path, modificationTime).

    A file belongs to a stem when its base name starts with it (``anywhere``:
    contains it), whatever the case.  Paths holding an ``ignore`` part are left
    out.  Files of equal time are told apart by path.
    """
    base = F.lower(F.element_at(F.split("path", "/"), -1))
    wanted = F.lit(False)
    for ending in extensions:
        wanted = wanted | base.endswith(ending)
    for part in ignore:
        wanted = wanted & ~F.col("path").contains(part)
    tests = {s: base.contains(s.lower()) if anywhere else base.startswith(s.lower()) for s in stems}
    matched = F.filter(
        F.array(*[F.when(test, F.lit(stem)) for stem, test in tests.items()]), lambda s: s.isNotNull()
    )
    hits = files.filter(wanted).select("path", "modificationTime", F.explode(matched).alias("stem"))
    newest = F.max(F.struct("modificationTime", "path"))
    return hits.groupBy("stem").agg(newest.alias("f")).select("stem", "f.path", "f.modificationTime")


def table_map(
    available: Iterable[str], wanted: Mapping[str, str] | str, missing: str = "skip"
) -> dict[str, str]:
    """{sheet or folder: table} for the ones present.

    ``wanted`` may be JSON text.  ``missing`` says whether an absent one is left
    out (``skip``) or an error (``fail``).
    """
    mapping = json.loads(wanted) if isinstance(wanted, str) else dict(wanted)
    if not isinstance(mapping, dict) or not mapping:
        raise ValueError("a table map is a non-empty object of name to table")
    have = set(available)
    absent = [name for name in mapping if name not in have]
    if absent and missing == "fail":
        raise ValueError(f"not found: {absent}")
    return {name: table for name, table in mapping.items() if name in have}


def inline_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small fixed reference table."""
    return spark.createDataFrame(list(rows), schema)
