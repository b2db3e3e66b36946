"""Whole runs: collections landed in the raw zone, and sheets published as curated tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.functions import names
from hearthline.session import settle
from hearthline.sinks import publish
from hearthline.sources import grid as grids
from hearthline.sources.landing import land
from hearthline.sources.readers import SOURCES, Source, incremental_slice, remember_schema, run_each, table_map


def extract_run(
    spark: SparkSession,
    read: Callable[[Source], DataFrame],
    base: str,
    run_ts: str,
    days_back: int | None = None,
    sources: Iterable[Source] = SOURCES,
    at_once: int = 3,
) -> DataFrame:
    """Land every collection below ``base``; the run log has one row per collection.

    With ``days_back`` and a change column, only rows changed lately are taken and added to
    what is there; else the folder is replaced.  Rows are written with the run's stamps and
    counted again, and the columns of each folder's files are remembered for its readers.  An
    empty collection is skipped, a failing one reported, and the rest goes on; ``at_once``
    collections are landed at a time.
    """

    def job(source: Source) -> Mapping[str, object]:
        rows, mode = read(source), "full"
        if days_back is not None and source.cursor is not None:
            rows = incremental_slice(rows, source.cursor, days_back, datetime.fromisoformat(run_ts))
            mode = "incremental"
        stamped = publish.lineage_columns(land(rows), publish.extraction_stamps(run_ts, "documents", source.collection))
        outcome = publish.skip_if_empty(stamped, lambda df: publish.write_verified(df, source.output(base), mode))
        if outcome.get("written"):
            remember_schema(spark, source.output(base), run_ts, replaced=mode == "full")
        return outcome

    return publish.run_log(spark, run_each(sources, job, at_once, spark), run_ts)


def curate_sheets(
    grid: DataFrame,
    wanted: Mapping[str, str] | str,
    base: str,
    dt: str,
    run_ts: str,
    missing: str = "skip",
    mode: str = "daily_partition",
    database: str | None = None,
) -> DataFrame:
    """Publish the wanted sheets as tables of text columns below ``base``; returns the run log.

    ``wanted`` maps a sheet to its table; an absent sheet is skipped or, with ``missing``
    "fail", an error.  A sheet of the same name may be in many workbooks, each with columns
    and an order of its own: values are put under the names of their own workbook's header,
    and a column that a workbook lacks is NULL in its rows.  Headers become snake-case column
    names, repeated ones numbered; columns without any text are left out.  Rows carry their
    workbook (``_source_file``), sheet and run time.  Headers and rows come from one pass
    each over the grid; the distinct headers of the wanted sheets are brought to the driver,
    not those of each workbook.  With ``database`` the tables are registered too.
    """
    spark = grid.sparkSession
    available = [r["sheet"] for r in grid.select("sheet").distinct().filter("sheet is not null").collect()]
    tables = table_map(available, wanted, missing)
    rows = settle(grids.sheet_rows(grid.filter(F.col("sheet").isin(list(tables)))), "sheets")
    headers: dict[str, list[list[str]]] = {}
    for r in rows.select("sheet", "headers").distinct().orderBy("sheet", "headers").collect():
        headers.setdefault(r["sheet"], []).append(r["headers"])
    report = []
    for sheet, table in tables.items():
        if sheet not in headers:
            report.append({"table": table, "status": "skipped", "records": 0})
            continue
        own = rows.filter(F.col("sheet") == sheet)
        named = _named_by_workbook(own, headers[sheet])
        stamped = publish.lineage_columns(named, {"_source_sheet": sheet, "_etl_loaded_at": run_ts})
        path = f"{base.rstrip('/')}/{table}"
        publish.publish(stamped, path, mode, dt)
        if database:
            publish.register_table(spark, database, table, path, partitioned=mode == "daily_partition")
        written = spark.read.parquet(path).filter(F.col("dt").cast("string") == dt).count()
        report.append({"table": table, "status": "success", "records": own.count(), "written": written})
    return publish.run_log(spark, report, run_ts)


SOURCE_FILE = "_source_file"


def _named_by_workbook(rows: DataFrame, headers: Sequence[Sequence[str]]) -> DataFrame:
    """The values of ``sheet_rows`` as snake-case columns, each row by its own header, with the workbook it is from.

    One projection: where a column stands differs by header, and a header that has none of
    a name gives NULL.  Columns without text in any row are left out.
    """
    places: dict[str, list[tuple[int, int]]] = {}
    for n, header in enumerate(headers):
        for i, name in enumerate(names.unique_names(names.snake_case(h) for h in names.header_names(header))):
            places.setdefault(name, []).append((n, i))
    which = F.array_position(F.array(*[F.array(*map(F.lit, h)).cast("array<string>") for h in headers]), F.col("headers")) - 1
    numbered = rows.select("source_uri", "values", which.alias("_header"))

    def value(found: Sequence[tuple[int, int]]) -> Column:
        by_place: dict[int, list[int]] = {}
        for n, i in found:
            by_place.setdefault(i, []).append(n)
        out = F.lit(None).cast("string")
        for i, held in by_place.items():
            out = F.when(F.col("_header").isin(held), F.get("values", F.lit(i))).otherwise(out)
        return out

    taken = [c for c in places if c != SOURCE_FILE]
    wide = numbered.select(*[value(places[c]).alias(c) for c in taken], F.col("source_uri").alias(SOURCE_FILE))
    counts = grids.non_blank_counts(wide).first()
    return wide.select(*[F.col(f"`{c}`") for c in wide.columns if counts[c] or c == SOURCE_FILE])
