"""Queries over tables that are kept and changed: merged, pointed at, projected, reprocessed, compacted."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalog.inputs import raw, table
from catalog.queries import MONEY, _loans, dropped_after, query
from hearthline.functions.text import as_text
from hearthline.operators import quality
from hearthline.operators.lookup import backfill_nulls
from hearthline.plans import reports, runs, star
from hearthline.schema import Record, safe_col
from hearthline.session import scratch_path, settle
from hearthline.sinks import pointers, publish
from hearthline.sinks.dead_letters import DeadLetters
from hearthline.sinks.history_table import HistoryTable
from hearthline.sources import readers
from hearthline.streaming.upsert import LatestLog

RUN = "2024-01-20 00:00:00"
BUCKETS = 4


@query
def scd2_in_batches(spark, sf):
    """Type-2 versions of all events, merged into a kept table in three batches by time; one batch is sent twice."""
    events = table(spark, sf, "events")
    history = HistoryTable(spark, scratch_path(spark, "history"), events.schema, ["user_id"], "ts", ["event_type"], ["event_id"], buckets=8)
    third = F.ntile(3).over(Window.orderBy("day"))
    days = events.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n")).select("day", third.alias("part"))
    bounds = days.groupBy("part").agg(F.min("day").alias("first"), F.max("day").alias("last")).orderBy("part").collect()
    for r in [*bounds, *bounds[1:2]]:
        history.merge(events.where(F.to_date("ts").between(r["first"], r["last"])), f"part {r['part']}")
    return history.read()


@query
def projected_days(spark, sf):
    """Orders of three days out of a folder of many, by paths that the days give."""
    base = scratch_path(spark, "daily")
    orders = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").cast(MONEY).alias("price"))
    month = orders.where("day between '1995-03-01' and '1995-03-30'").withColumn("dt", F.col("day").cast("string"))
    publish.write_partitioned_report(month, base, ["dt"])
    asked = readers.days(date(1995, 3, 10), date(1995, 3, 12))
    found = readers.read_projected(spark, base, "dt=${dt}", {"dt": asked}, orders.schema)
    return found.groupBy(F.col("dt").cast("date").alias("dt")).agg(F.count(F.lit(1)).alias("orders"), F.sum("price").alias("total"))


@query
def swapped_tables(spark, sf):
    """A report table refreshed with other columns, refreshed again, and rolled back; and a registered folder that gives way to another."""
    database = f"swapped_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {database}")
    orders = table(spark, sf, "orders")
    name, out = f"{database}.by_status", None
    by_status = orders.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("orders"))
    with_total = orders.groupBy(F.col("o_orderstatus").alias("status"), F.lit(1).alias("run")).agg(F.count(F.lit(1)).alias("orders"))
    steps = {"first": lambda: by_status, "other columns": lambda: with_total, "failed": lambda: 1 / 0}
    for step, build in steps.items():
        publish.refresh_snapshot_tables(spark, {name: build}, RUN)
        out = _counted(spark.table(name), step, out)
    pointers.rollback(spark, name)
    out = _counted(spark.table(name), "rolled back", out)
    base = scratch_path(spark, "registered")
    for step, rows in {"folder": by_status, "other folder": by_status.withColumn("more", F.lit("x"))}.items():
        publish.write_staging(rows, f"{base}/{len(step)}")
        publish.register_table(spark, database, "folder", f"{base}/{len(step)}")
        out = _counted(spark.table(f"{database}.folder"), step, out)
    return dropped_after(out, database, "swapped")


def _counted(rows: DataFrame, step: str, before: DataFrame | None) -> DataFrame:
    """Rows, orders and number of columns of a table as it is now."""
    now = settle(rows, "step")
    counted = now.agg(
        F.lit(step).alias("step"), F.lit(len(now.columns)).alias("columns"), F.count(F.lit(1)).alias("rows"), F.sum("orders").alias("orders")
    )
    return counted if before is None else before.unionByName(counted)


@query
def dead_letters_reprocessed(spark, sf):
    """Loans that fail their tests are stored, fixed twice by the same rule, and merged back once."""
    loans = _loans(spark, sf).select("_id", "blueWaterId", "productType", "dpaAmount")
    record = Record.of(loans)
    tests = [
        ("bad bluewater id", F.col("blueWaterId").isNotNull() & safe_col(record, "blueWaterId", "int").isNull()),
        ("no product", F.col("productType").isNull()),
        ("no amount", safe_col(record, "dpaAmount", "money").isNull()),
    ]
    good, bad = quality.split_bad_records(loans, *tests)
    letters = DeadLetters(spark, scratch_path(spark, "letters"), loans.schema, ["_id"])
    for _ in range(2):
        letters.add(bad, "run 1")

    def fix(rows: DataFrame) -> DataFrame:
        """Unknown numbers are none; a loan without product is an EEP one if it is bad in nothing else."""
        only_product = F.col("reasons") == F.array(F.lit("no product"))
        number = F.when(F.col("blueWaterId") != "n/a", F.col("blueWaterId"))
        return rows.withColumns({"blueWaterId": number, "productType": F.when(only_product, F.lit("EEP")).otherwise(F.col("productType"))})

    for _ in range(2):
        letters.reprocess(fix, *tests)
    open_ = letters.open().select("_id", F.lit("open").alias("state"), F.array_join("reasons", "; ").alias("reasons"), "attempt")
    none = [F.lit("").alias("reasons"), F.lit(0).alias("attempt")]
    parts = [good.select("_id", F.lit("good").alias("state"), *none), letters.recovered().select("_id", F.lit("recovered").alias("state"), *none), open_]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return every.groupBy("state", "reasons", "attempt").agg(F.count(F.lit(1)).alias("loans"), F.count_distinct("_id").alias("ids"))


@query
def closings_from_buckets(spark, sf):
    """Monthly closings over three star tables that are stored by loan in equal buckets, and joined as they lie."""
    database = f"star_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {database}")
    return dropped_after(reports.monthly_closings(bucketed_base(spark, sf, database), "EEP"), database, "closings")


def bucketed_base(spark: SparkSession, sf: str, database: str) -> DataFrame:
    loans = _loans(spark, sf)
    made = {"dim_loan": star.dim_loan(loans), "fact_loan_status": star.fact_loan_status(loans), "fact_loan_metrics": star.fact_loan_metrics(loans)}
    for name, rows in made.items():
        publish.write_with_layout(rows, f"{database}.{name}", "loan_id", ["loan_id"], BUCKETS)
    # As at scale, where none of the three is small enough to be broadcast.
    loan, status, metrics = (spark.table(f"{database}.{name}").hint("merge") for name in made)
    return reports.loan_base(loan, status, metrics)


@query
def buckets_compacted(spark, sf):
    """Two rounds of event batches, the fuller buckets compacted after each; the latest event of each user."""
    events = table(spark, sf, "events")
    log = LatestLog(spark, scratch_path(spark, "log"), "user_id", "ts", buckets=8)
    n = events.count()
    for step in (0, 1):
        for part in (0, 1):
            log.upsert(events.where(F.col("event_id") % 4 == 2 * step + part))
        log.compact(over=n // 200)
    return log.read().select("user_id", "ts")


@query
def stored_schema(spark, sf):
    """Two runs that land customers with other columns, read with the schema kept by the run; and which run brought which column (A1)."""
    path = f"{scratch_path(spark, 'landed')}/customers"
    customers = table(spark, sf, "customer")
    for run, columns in (("2024-01-01 00:00:00", ["c_custkey", "c_name"]), ("2024-01-02 00:00:00", ["c_custkey", "c_nationkey"])):
        publish.write_verified(customers.select(*columns), path, "incremental")
        readers.remember_schema(spark, path, run)
    counts = readers.read_raw(spark, path).agg(*[F.count(c).alias(c) for c in ("c_custkey", "c_name", "c_nationkey")])
    per_column = counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("present")) for c in counts.columns])))
    return per_column.join(readers.schema_history(spark, path), "column")


@query
def ordered_closings(spark, sf):
    """The closings by buyer with their place in the order of the report: newest month first, then buyer."""
    found = reports.monthly_closings_by_buyer(star.loan_wide(_loans(spark, sf)), "two_way")
    # A number in the order of arrival shows how the report sorts; its rows are a few per month.
    placed = reports.newest_first(found, "buyer").withColumn("arrival", F.monotonically_increasing_id())
    place = F.row_number().over(Window.orderBy("arrival"))
    return placed.select(place.alias("place"), "year_month", "buyer", "closing_count")


@query
def newest_listed_files(spark, sf):
    """Files of order statuses written to a folder, listed, and the newest of each stem read."""
    base = scratch_path(spark, "inbox")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    spec = {"EXTERNAL_1": "O", "external_2": "F", "Internal_1": "P", "archive/internal_9": "O", "other": "F"}
    for name, status in spec.items():
        orders.where(F.col("o_orderstatus") == status).write.parquet(f"{base}/{name}.xlsx")
    files = readers.list_files(spark, base).where(F.col("path").endswith(".parquet"))
    # A written file is a folder of parts here; its name is the folder's, its time that of its last part.
    folder = F.regexp_extract("path", r"^(.*\.xlsx)/[^/]*$", 1)
    sheets = files.groupBy(folder.alias("path")).agg(F.max("modificationTime").alias("modificationTime"))
    newest = readers.latest_per_stem(sheets, ["external", "internal", "nothing"], ignore=["/archive/"])
    out = None
    for r in newest.collect():
        rows = spark.read.parquet(r["path"]).groupBy("o_orderstatus").agg(F.lit(r["stem"]).alias("stem"), F.count(F.lit(1)).alias("orders"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query
def curate_workbooks(spark, sf):
    """Two workbooks with one sheet name, other column orders and one column that only one has; rows keep their workbook."""
    base = scratch_path(spark, "workbooks")
    parts = table(spark, sf, "part").where("p_brand in ('Brand#11', 'Brand#22')")
    text = {c: F.struct(F.lit("s").alias("t"), F.col(c).cast("string").alias("v")) for c in ("p_name", "p_size", "p_type", "p_brand")}
    orders = {"a.xlsx": ["p_name", "p_size", "p_type"], "b.xlsx": ["p_type", "p_name", "p_brand", "p_size"]}
    titles = {"p_name": "Part Name", "p_size": "Size", "p_type": "Kind", "p_brand": "Brand"}
    grid = None
    for (uri, columns), brand in zip(orders.items(), ("Brand#11", "Brand#22"), strict=True):
        own = parts.where(F.col("p_brand") == brand)
        body = own.select((F.col("p_partkey") + 1).cast("int").alias("row_idx"), F.array(*[text[c] for c in columns]).alias("cells"))
        heading = F.array(*[F.struct(F.lit("s").alias("t"), F.lit(titles[c]).alias("v")) for c in columns])
        head = own.limit(1).select(F.lit(0).alias("row_idx"), heading.alias("cells"))
        both = head.unionByName(body).select(F.lit(uri).alias("source_uri"), F.lit("Parts").alias("sheet"), "row_idx", "cells")
        grid = both if grid is None else grid.unionByName(both)
    runs.curate_sheets(grid, {"Parts": "parts"}, base, "2024-01-20", RUN)
    if not grid.take(1):
        return spark.sql("select '' as _source_file, '' as part_name, '' as size, '' as kind, '' as brand where false")
    back = spark.read.parquet(f"{base}/parts")
    brand = F.col("brand") if "brand" in back.columns else F.lit(None).cast("string")
    return back.select("_source_file", "part_name", "size", "kind", brand.alias("brand"))


@query
def star_partners_all_columns(spark, sf):
    """Partners as far as loans tell, all columns."""
    return star.correspondents_in_loans(_loans(spark, sf))


@query
def backfill_reduced(spark, sf):
    """Gaps of a few orders, filled from a patch that holds every order three times."""
    orders = table(spark, sf, "orders")
    holed = orders.select("o_orderkey", F.when(F.col("o_orderkey") % 50 != 0, as_text(F.col("o_orderpriority"))).alias("priority"))
    version = F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("version")
    patch = orders.select("o_orderkey", version, "o_orderstatus").withColumn("priority", F.concat_ws(":", "o_orderstatus", "version"))
    return backfill_nulls(holed, patch, "o_orderkey", ["priority"], newest="version")
