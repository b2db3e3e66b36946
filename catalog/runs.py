"""Queries of whole runs: written below the shared folder, read back and added up."""

from __future__ import annotations

import uuid
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.inputs import raw, table
from catalog.queries import MONEY, _calendar, dropped_after, parts_grid, query
from hearthline.functions import names
from hearthline.operators import trends
from hearthline.plans import reports, runs, star
from hearthline.schema import Field
from hearthline.session import scratch_path, settle
from hearthline.sinks import publish
from hearthline.sources import grid as grids
from hearthline.sources import landing, readers
from hearthline.streaming.upsert import compact, read_latest, stream_latest

RUN = "2024-01-20 00:00:00"


def _collections(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    orders = table(spark, sf, "orders").withColumnRenamed("o_orderkey", "_id")
    events = table(spark, sf, "events").withColumnRenamed("event_id", "_id").withColumnRenamed("ts", "updatedAt")
    return {"orders": orders, "events": events, "nothing": orders.where("_id < 0")}


SOURCES = (
    readers.Source("orders", None),
    readers.Source("events", "updatedAt"),
    readers.Source("nothing", None),
    readers.Source("unknown", None),
)


def _extract(spark: SparkSession, sf: str, base: str) -> DataFrame:
    found = _collections(spark, sf)
    return runs.extract_run(spark, lambda s: found[s.collection], base, RUN, 7, SOURCES)


@query
def extract_run(spark, sf):
    """The log of a run over a full, an incremental, an empty and a missing collection."""
    log = _extract(spark, sf, scratch_path(spark, "raw"))
    return log.select("source", "status", "records", "written", F.col("message").isNotNull().alias("failed"), "run_ts")


@query
def extract_totals(spark, sf):
    return publish.run_totals(_extract(spark, sf, scratch_path(spark, "raw")))


@query
def extract_read_back(spark, sf):
    """Two runs: the full collection is replaced, the incremental one added to; files are read with merged columns."""
    base = scratch_path(spark, "raw")
    for _ in range(2):
        _extract(spark, sf, base)
    back = readers.read_raw(spark, f"{base}/events")
    return back.groupBy("_etl_collection", "_etl_extraction_date", "event_type").agg(F.count(F.lit(1)).alias("rows")).unionByName(
        readers.read_raw(spark, f"{base}/orders")
        .groupBy("_etl_collection", "_etl_extraction_date", F.col("o_orderstatus").alias("event_type"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@query
def merged_files(spark, sf):
    """Files of one folder with different columns (A1), and a folder that isn't there (A2)."""
    base = scratch_path(spark, "mixed")
    customers = table(spark, sf, "customer")
    customers.select("c_custkey", "c_name").write.parquet(f"{base}/batch=1")
    customers.select("c_custkey", F.col("c_nationkey").alias("nation")).write.parquet(f"{base}/batch=2")
    spec = [Field("c_custkey", "int"), Field("nation", "int"), Field("c_name")]
    absent = readers.read_optional(spark, f"{base}-absent", spec)
    both = readers.read_raw(spark, base).unionByName(absent, allowMissingColumns=True)
    return both.groupBy(F.col("batch").cast("int").alias("batch")).agg(
        F.count(F.lit(1)).alias("rows"), F.count("c_name").alias("names"), F.count("nation").alias("nations")
    )


@query
def newest_files(spark, sf):
    """The newest file of each stem, files made of orders."""
    orders = table(spark, sf, "orders")
    stem = F.element_at(F.array(*map(F.lit, ("External", "INTERNAL", "other"))), (F.col("o_custkey") % 3 + 1).cast("int"))
    ending = F.when(F.col("o_orderkey") % 5 == 0, ".csv").when(F.col("o_orderkey") % 2 == 0, ".xlsx").otherwise(".XLS")
    folder = F.when(F.col("o_orderkey") % 7 == 0, "/in/archive/").otherwise("/in/")
    files = orders.select(
        F.concat(folder, stem, F.lit("_"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0"), ending).alias("path"),
        F.col("o_orderdate").cast("date").alias("modificationTime"),
    )
    return readers.latest_per_stem(files, ["external", "internal", "nothing"], ignore=["/archive/"])


@query
def duplicate_names(spark, sf):
    """Columns whose names differ only in case (C3), and repeated header names."""
    orders = table(spark, sf, "orders")
    clashing = orders.select(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("Status"))
    renamed = landing.rename_duplicate_columns(clashing)
    counted = renamed.groupBy(*renamed.columns).agg(F.count(F.lit(1)).alias("orders"))
    return counted.toDF(*names.header_names(["status", "status", "orders"]))


def repeated_headers(spark: SparkSession, sf: str) -> DataFrame:
    """The parts grid with a header name twice, and each sheet's rows moved down by five rows."""
    grid = parts_grid(spark, sf)
    is_header = (F.col("row_idx") == 2) & (F.element_at("cells", 1)["v"] == "Part #")
    header = F.transform("cells", lambda c: F.when(c["v"] == "Setup Date", F.struct(F.lit("s").alias("t"), F.lit("Size").alias("v"))).otherwise(c))
    return grid.withColumn("cells", F.when(is_header, header).otherwise(F.col("cells"))).withColumn("row_idx", F.col("row_idx") + 5)


@query
def curate_sheets(spark, sf):
    """Two sheets as curated tables, registered and read back by name; a third one isn't there."""
    base, database = scratch_path(spark, "curated"), f"curated_{uuid.uuid4().hex[:8]}"
    wanted = '{"Brand#11": "first", "Brand#22": "second", "Brand#99": "absent"}'
    log = runs.curate_sheets(repeated_headers(spark, sf), wanted, base, "2024-01-20", RUN, database=database)
    done = [r["source"] for r in log.filter("status = 'success'").collect()]
    out = None
    for name in done:
        rows = spark.table(f"{database}.{name}")
        back = rows.groupBy(F.col("_source_sheet").alias("sheet"), F.col("dt").cast("string").alias("dt")).agg(
            F.count(F.lit(1)).alias("parts"), F.sum(F.col("size").cast("long")).alias("sizes"), F.max("size_1").alias("numbers"),
        )
        out = back if out is None else out.unionByName(back)
    if out is None:
        out = spark.sql("select '' as sheet, '' as dt, 0L as parts, 0L as sizes, '' as numbers where false")
    return dropped_after(out, database, "curated-back")


@query
def sheet_without_header(spark, sf):
    """Sheets of numbers only that begin at row 40: their first row serves as header, all others are data."""
    parts = table(spark, sf, "part")
    cells = F.array(*[F.struct(F.lit("n").alias("t"), F.col(c).cast("string").alias("v")) for c in ("p_partkey", "p_size")])
    grid = parts.select(
        F.lit("n.xlsx").alias("source_uri"), F.when(F.col("p_brand") != "Brand#11", F.col("p_brand")).alias("sheet"),
        (F.col("p_partkey") + 40).cast("int").alias("row_idx"), cells.alias("cells"),
    )
    rows = grids.sheet_rows(grid)
    return rows.groupBy("sheet").agg(
        F.count(F.lit(1)).alias("rows"), F.min("row_idx").alias("first_row"), F.first("headers")[0].alias("header"),
        F.sum(F.element_at("values", 2).cast("long")).alias("sizes"),
    )


@query
def sinks_read_back(spark, sf):
    """Every sink written with all orders, read back, and added up."""
    base, database = scratch_path(spark, "sinks"), f"sinks_{uuid.uuid4().hex[:8]}"
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast(MONEY).alias("price"))
    spark.sql(f"CREATE DATABASE {database}")
    publish.write_raw(orders, f"{base}/raw")
    publish.write_raw(orders, f"{base}/raw", "incremental")
    publish.write_staging(orders, f"{base}/staging")
    publish.write_sized(orders, f"{base}/sized", orders.count())
    publish.write_compact(orders, f"{base}/compact")
    publish.write_partitioned_report(orders, f"{base}/report", ["o_orderstatus"])
    publish.publish(orders, f"{base}/daily", "daily_partition", "2024-01-01")
    publish.register_table(spark, database, "daily", f"{base}/daily", partitioned=True)
    publish.publish(orders, f"{base}/daily", "daily_partition", "2024-01-02")
    publish.add_new_partitions(spark, f"{database}.daily")
    publish.write_with_layout(orders, f"{database}.laid_out", "o_custkey", ["o_orderkey"], 4)
    publish.refresh_snapshot_tables(spark, {f"{database}.snapshot": lambda: orders}, RUN)
    publish.define_stored_view(spark, f"{database}.stored", f"select * from {database}.laid_out")
    publish.define_view(spark.table(f"{database}.snapshot"), f"{database}_view")
    targets = {
        **{name: spark.read.parquet(f"{base}/{name}") for name in ("raw", "staging", "sized", "compact", "report")},
        **{name: spark.table(f"{database}.{name}") for name in ("daily", "laid_out", "snapshot", "stored")},
        "view": spark.table(f"{database}_view"),
    }
    out = None
    for name, rows in targets.items():
        added = rows.agg(F.lit(name).alias("target"), F.count(F.lit(1)).alias("rows"), F.sum("price").alias("total"))
        out = added if out is None else out.unionByName(added)
    out = dropped_after(out, database, "sinks-back")
    spark.catalog.dropTempView(f"{database}_view")
    return out


@query
def stream_latest_events(spark, sf):
    """Events as a stream of two file batches, kept as the latest per user, before and after compaction."""
    base = scratch_path(spark, "stream")
    events = table(spark, sf, "events")
    for odd in (0, 1):
        events.where(F.col("event_id") % 2 == odd).write.mode("append").parquet(f"{base}/in")
        stream_latest(spark, f"{base}/in", events.schema, f"{base}/log", f"{base}/checkpoint", "user_id", "ts").awaitTermination()
    before = settle(read_latest(spark, f"{base}/log", "user_id", "ts").select("user_id", "ts"), "before")
    compact(spark, f"{base}/log", "user_id", "ts")
    after = spark.read.parquet(f"{base}/log").select("user_id", "ts")
    return before.withColumn("compacted", F.lit(False)).unionByName(after.withColumn("compacted", F.lit(True)))


# ------------------------------------------------- the star from repeated inputs


def _versions(df: DataFrame, column: str) -> DataFrame:
    """Every row twice: an older version with another value in a column, and itself."""
    older = df.withColumns({column: F.lit("old"), "_etl_extracted_at": F.lit("2023-01-01 00:00:00")})
    return df.withColumn("_etl_extracted_at", F.lit("2024-01-02 03:04:05")).unionByName(older)


def _star(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    inputs = {
        "loans": _versions(raw(spark, sf, "loans"), "status"),
        "correspondents": _versions(raw(spark, sf, "correspondents"), "name"),
        "users": _versions(raw(spark, sf, "users"), "email"),
        "investors": _versions(raw(spark, sf, "investors"), "name"),
    }
    return star.build_star(spark, inputs, RUN)


@query
def star_of_versions(spark, sf):
    """Rows of each table of the star, built from inputs that hold two versions of every document."""
    tables = _star(spark, sf)
    out = None
    for name in ("dimensions/dim_correspondent", "dimensions/dim_user", "dimensions/dim_loan", "facts/fact_loan_status", "facts/fact_loan_metrics"):
        counted = tables[name].groupBy("_etl_loaded_at").agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows"))
        out = counted if out is None else out.unionByName(counted)
    return out


@query
def status_of_versions(spark, sf):
    return _star(spark, sf)["facts/fact_loan_status"].groupBy("current_status").agg(F.count(F.lit(1)).alias("loans"))


@query
def metrics_of_repeated_loans(spark, sf):
    """Loans that occur twice count once; their amounts add up."""
    base = star.loan_wide(raw(spark, sf, "loans"))
    return reports.monthly_metrics(base.unionByName(base), _calendar(spark, sf)).select(
        "year_month", "product_type", "workflow_type", "loan_count", "total_dpa_volume"
    )


@query
def growth_of_amounts(spark, sf):
    """Monthly amounts with six places, and none in any March."""
    orders = table(spark, sf, "orders")
    month = F.trunc(F.col("o_orderdate").cast("date"), "month")
    amount = F.when(F.month(month) == 3, 0).otherwise(F.col("o_totalprice").cast(MONEY) * F.lit(Decimal("0.0001")))
    monthly = orders.groupBy(month.alias("month_start")).agg(F.sum(amount.cast("decimal(18,6)")).alias("amount"))
    return trends.growth(monthly, "month_start", "amount").select("month_start", "amount", "mom_pct", "yoy_pct")
