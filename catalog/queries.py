"""Every operator as a query over the given tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.inputs import raw, raw_sheets, table
from hearthline.functions import dates, domains, numbers, text
from hearthline.operators import calendar, dedupe, history, privacy, quality, rollup, trends
from hearthline.operators.lookup import backfill_nulls
from hearthline.operators.nested import explode_children, explode_texts
from hearthline.plans import procurement, reports, scorecard, star, tracking
from hearthline.schema import Record, drop_ancient_dates, first_of_list_fk, resolve_fk, safe_col
from hearthline.session import scratch_path, settle
from hearthline.sinks import publish
from hearthline.sources import grid as grids
from hearthline.sources import landing
from hearthline.sources.readers import incremental_slice

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = date(1999, 6, 15)
EVENTS_AS_OF = datetime(2024, 1, 20)
MONEY = "decimal(18,2)"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def dropped_after(df: DataFrame, database: str, label: str) -> DataFrame:
    """The result, computed and written, after which the query's database goes."""
    out = settle(df, label)
    df.sparkSession.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    return out


# ---------------------------------------------------------------- star schema


def _loans(spark: SparkSession, sf: str) -> DataFrame:
    return raw(spark, sf, "loans")


def _base(spark: SparkSession, sf: str) -> DataFrame:
    """Loans with status and metrics, straight from the raw rows."""
    return star.loan_wide(_loans(spark, sf))


def _joined(spark: SparkSession, sf: str) -> DataFrame:
    """The same from the three star tables."""
    loans = _loans(spark, sf)
    return reports.loan_base(star.dim_loan(loans), star.fact_loan_status(loans), star.fact_loan_metrics(loans))


def _partners(spark: SparkSession, sf: str) -> DataFrame:
    return star.dim_correspondent(raw(spark, sf, "correspondents"))


def _contracts(spark: SparkSession, sf: str) -> DataFrame:
    rows = raw(spark, sf, "correspondents")
    return rows.select(F.col("_id").alias("correspondent_id"), F.col("contractDate").alias("contract_date"))


def _contract_base(spark: SparkSession, sf: str) -> DataFrame:
    return reports.with_contract_date(_base(spark, sf), _contracts(spark, sf))


def _calendar(spark: SparkSession, sf: str) -> DataFrame:
    """Days from the first to the last order."""
    day = F.col("o_orderdate").cast("date")
    return calendar.staging_calendar(calendar.days_between(table(spark, sf, "orders"), day, day))


@query
def star_dim_loan(spark, sf):
    return star.dim_loan(_loans(spark, sf), star.dim_investor(raw(spark, sf, "investors")))


@query
def star_loan_status(spark, sf):
    return star.fact_loan_status(_loans(spark, sf))


@query
def star_loan_metrics(spark, sf):
    return star.fact_loan_metrics(_loans(spark, sf))


@query
def star_borrowers(spark, sf):
    return star.dim_borrower(_loans(spark, sf))


@query
def star_processing_entries(spark, sf):
    return star.dim_eep_processing_entry(_loans(spark, sf))


@query
def star_correspondents(spark, sf):
    return _partners(spark, sf)


@query
def star_partners_from_loans(spark, sf):
    return star.correspondents_in_loans(_loans(spark, sf)).select("correspondent_id", "correspondent_name")


@query
def star_users(spark, sf):
    return star.dim_user(raw(spark, sf, "users"))


@query
def star_conditions(spark, sf):
    return star.dim_loancondition(raw(spark, sf, "conditions"))


@query
def star_condition_documents(spark, sf):
    return star.dim_loancondition_documenttype(raw(spark, sf, "conditions"))


@query
def star_condition_events(spark, sf):
    return star.dim_loanconditionevent(raw(spark, sf, "condition_events"))


@query
def star_exceptions(spark, sf):
    return star.dim_loanexception(raw(spark, sf, "exceptions"))


@query
def star_holidays(spark, sf):
    return star.dim_holiday(raw(spark, sf, "holidays"))


@query
def star_documents(spark, sf):
    return star.dim_loandocument(raw(spark, sf, "loandocuments"))


@query
def star_product_volume(spark, sf):
    """The fixed product table joined to what loans hold."""
    volume = reports.volume_by_product(star.fact_loan_metrics(_loans(spark, sf)))
    products = star.dim_product(spark)
    return products.join(volume, products.product_code == volume.product_type, "left").select(
        "product_id", "product_code", "product_category", "loan_count", "total_volume"
    )


# -------------------------------------------------------------------- reports


@query
def monthly_closings(spark, sf):
    return reports.monthly_closings(_joined(spark, sf), "EEP")


@query
def monthly_closings_one_year(spark, sf):
    return reports.monthly_closings(_base(spark, sf), "EEP", year=1998)


@query
def monthly_closings_by_buyer(spark, sf):
    return reports.monthly_closings_by_buyer(_base(spark, sf), "two_way")


@query
def monthly_closings_by_buyer_raw(spark, sf):
    return reports.monthly_closings_by_buyer(_base(spark, sf), "raw")


@query
def monthly_closings_by_buyer_three_way(spark, sf):
    return reports.monthly_closings_by_buyer(_contract_base(spark, sf), "three_way")


@query
def buyer_pivot(spark, sf):
    return reports.buyer_pivot(reports.monthly_closings_by_buyer(_contract_base(spark, sf), "three_way"))


@query
def buyer_yearly(spark, sf):
    return reports.buyer_yearly(reports.monthly_closings_by_buyer(_contract_base(spark, sf), "three_way"))


@query
def buyer_share(spark, sf):
    return reports.buyer_share(_contract_base(spark, sf))


@query
def buyer_share_detail(spark, sf):
    return reports.buyer_share_detail(_contract_base(spark, sf))


def _registrations(spark: SparkSession, sf: str) -> DataFrame:
    loans = _loans(spark, sf)
    return reports.registrations_by_product(star.dim_loan(loans), star.fact_loan_status(loans))


@query
def registrations_by_product(spark, sf):
    return _registrations(spark, sf)


@query
def registrations_pivot(spark, sf):
    return reports.registration_pivot(_registrations(spark, sf))


@query
def registrations_share(spark, sf):
    return reports.registration_share(_registrations(spark, sf))


@query
def loan_details(spark, sf):
    return reports.loan_details(_base(spark, sf), _partners(spark, sf), star.dim_borrower(_loans(spark, sf)))


@query
def product_loan_details(spark, sf):
    return reports.product_loan_details(_base(spark, sf), _partners(spark, sf), star.dim_borrower(_loans(spark, sf)))


@query
def current_overview(spark, sf):
    return reports.current_overview(_base(spark, sf), AS_OF)


@query
def ytd_by_product(spark, sf):
    return reports.ytd_by_product(_base(spark, sf), AS_OF)


@query
def correspondent_dashboard(spark, sf):
    return reports.correspondent_dashboard(_base(spark, sf), _partners(spark, sf), _calendar(spark, sf))


@query
def monthly_metrics(spark, sf):
    return reports.monthly_metrics(_base(spark, sf), _calendar(spark, sf))


@query
def amounts_by_month(spark, sf):
    return reports.amounts_by_month(star.fact_loan_metrics(_loans(spark, sf)), _calendar(spark, sf))


@query
def volume_by_product(spark, sf):
    return reports.volume_by_product(star.fact_loan_metrics(_loans(spark, sf)))


# ---------------------------------------------------------------- procurement


def _fact(spark: SparkSession, sf: str) -> DataFrame:
    rows, sheets = raw_sheets(spark, sf, {procurement.EXTERNAL: "external_sheet", procurement.INTERNAL: "internal_sheet"})
    return procurement.fact_procurement(procurement.conform_tagged(rows, "sheet", sheets))


def _view(spark: SparkSession, sf: str) -> DataFrame:
    return tracking.procurement_analysis(_fact(spark, sf), AS_OF)


@query
def conform_union(spark, sf):
    return procurement.conform_union(raw(spark, sf, "external_sheet"), raw(spark, sf, "internal_sheet"))


@query
def fact_procurement(spark, sf):
    return _fact(spark, sf)


@query
def lender_alias(spark, sf):
    """Lender groups from an alias table made of supplier names."""
    suppliers = table(spark, sf, "supplier")
    number = F.col("s_suppkey") % 20
    aliases = suppliers.select(
        F.concat(F.lit("ACME BANK "), number.cast("string"), F.lit(" NA")).alias("lender_name_norm"),
        F.concat(F.lit("Acme "), number.cast("string")).alias("lender_canonical"),
        F.lit("Acme Group").alias("lender_group"),
    ).filter(number % 2 == 0).distinct()
    mapped = procurement.with_lender_alias(_fact(spark, sf).drop("lender_canonical", "lender_group", "lender_alias_is_mapped"), aliases)
    return mapped.groupBy("lender_name_norm", "lender_canonical", "lender_group", "lender_alias_is_mapped").agg(
        F.count(F.lit(1)).alias("submissions")
    )


@query
def loan_master(spark, sf):
    return procurement.loan_master(_fact(spark, sf))


@query
def month_spine(spark, sf):
    return procurement.dim_month(_fact(spark, sf), blank_row=True)


@query
def procurement_analysis(spark, sf):
    return _view(spark, sf)


@query
def kpi_scorecard(spark, sf):
    return tracking.kpi_scorecard(_view(spark, sf))


SLICERS = {"source": "External", "state": ["S1", "S2"], "status": ["Pending", "Approved", "Blank"]}


@query
def kpi_filtered(spark, sf):
    return tracking.kpi_scorecard(_view(spark, sf), SLICERS)


@query
def month_trend(spark, sf):
    return tracking.month_trend(_view(spark, sf))


@query
def avg_coverage_by_month(spark, sf):
    return tracking.avg_coverage_by_month(_view(spark, sf))


@query
def avg_premium_by_month(spark, sf):
    return tracking.avg_premium_by_month(_view(spark, sf))


@query
def avg_premium_observed(spark, sf):
    return tracking.avg_premium_observed(_view(spark, sf))


@query
def flood_donut(spark, sf):
    return tracking.flood_donut(_view(spark, sf))


@query
def closed_by_source(spark, sf):
    return tracking.closed_by_source(_view(spark, sf))


@query
def filter_lists(spark, sf):
    return tracking.filter_lists(_view(spark, sf))


@query
def label_check(spark, sf):
    return tracking.label_check(_view(spark, sf))


@query
def current_month_default(spark, sf):
    """The default month taken from the newest order instead of the clock."""
    return tracking.current_month(table(spark, sf, "orders").agg(F.max("o_orderdate").cast("date").alias("day")), "day")


# -------------------------------------------------------------------- landing


@query
def latest_per_key(spark, sf):
    events = table(spark, sf, "events")
    return dedupe.latest_per_key(events, "user_id", "ts", tiebreak=[F.col("event_id").desc()])


@query
def dedupe_report(spark, sf):
    return dedupe.dedupe_report(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def incremental_events(spark, sf):
    return incremental_slice(table(spark, sf, "events"), "ts", 7, EVENTS_AS_OF)


@query
def json_map_fields(spark, sf):
    """props as a one-element list of maps, and its fields."""
    events = table(spark, sf, "events").withColumn("items", F.concat(F.lit("["), "props", F.lit("]")))
    rows, element = explode_children(events, "items", [F.col("event_id")])
    return rows.select("event_id", "position", safe_col(element, "k", "int").alias("k"), safe_col(element, "zz").alias("zz"))


@query
def conversation_positions(spark, sf):
    turns = table(spark, sf, "conversations")
    return turns.select("conv_id", "turn", "role", (F.col("turn") == 0).alias("is_primary"))


@query
def document_words(spark, sf):
    """Whole texts split into words, exploded with positions, and counted per word."""
    words = table(spark, sf, "documents").withColumn("words", F.split(F.lower("text"), " "))
    rows = explode_texts(words, "words", [F.col("doc_id")], "position", "word")
    return rows.filter("word <> ''").groupBy("word").agg(
        F.count(F.lit(1)).alias("uses"), F.max("position").cast("int").alias("last_position")
    )


@query
def backfill_prices(spark, sf):
    """Order prices with gaps, filled from the latest of each order's copies."""
    price = F.col("o_totalprice").cast(MONEY).cast("string")
    orders = table(spark, sf, "orders")
    versions = orders.withColumn("version", F.explode(F.array(F.lit(1), F.lit(2))))
    gap = F.when(F.col("o_orderkey") % 3 == 0, F.lit(None)).when(F.col("o_orderkey") % 3 == 1, F.lit("  ")).otherwise(price)
    holed = orders.select("o_orderkey", gap.alias("price"), F.when(F.col("o_custkey") % 2 == 0, price).alias("upb"))
    newest = F.col("version") == 2
    patch = versions.select(
        "o_orderkey", "version", F.when(newest, price).alias("price"), F.concat(F.when(newest, "P").otherwise("old"), price).alias("upb")
    )
    return backfill_nulls(holed, patch, "o_orderkey", ["price", "upb"], newest="version")


@query
def flatten_document(spark, sf):
    orders = table(spark, sf, "orders")
    price = F.col("o_totalprice").cast(MONEY)
    docs = orders.select(
        F.col("o_orderkey").alias("_id"),
        F.struct(F.col("o_custkey").alias("_id"), F.lit("x").alias("name")).alias("correspondent"),
        F.struct(F.col("o_orderstatus").alias("code"), price.alias("price")).alias("state"),
        F.array(
            F.struct(F.col("o_orderpriority").alias("kind"), price.alias("amount")),
            F.struct(F.lit(None).cast("string").alias("kind"), (price + 1).cast(MONEY).alias("amount")),
        ).alias("entries"),
        F.array("o_orderstatus", "o_orderpriority").alias("tags"),
        F.col("o_orderdate").cast("timestamp").alias("at"),
        (F.col("o_custkey") % 2 == 0).alias("flag"),
    )
    return landing.flatten_document(docs)


@query
def choice_struct(spark, sf):
    orders = table(spark, sf, "orders")
    key = F.col("o_orderkey")
    mixed = orders.select(
        "o_orderkey",
        F.struct(
            F.when(key % 3 == 0, F.col("o_custkey")).alias("long"),
            F.when(key % 3 == 1, F.col("o_orderstatus")).alias("string"),
            F.struct(F.when(key % 3 == 2, F.concat(F.lit("{value="), key.cast("string"), F.lit("}"))).alias("value")).alias("decimal128"),
            F.lit(True).alias("null"),
        ).alias("amount"),
        F.struct(F.col("o_orderstatus").alias("string"), F.lit("kept").alias("note")).alias("other"),
    )
    flat = landing.unwrap_columns(landing.flatten_choice_structs(mixed), ["amount"])
    return flat.select("o_orderkey", "amount", F.col("other.note").alias("note"))


@query
def canonical_columns(spark, sf):
    orders = table(spark, sf, "orders")
    key = F.col("o_orderkey")
    clashing = orders.select(
        key.alias("id"),
        F.when(key % 3 == 0, F.lit("")).when(key % 3 == 1, F.col("o_orderstatus")).alias("loanstatus"),
        F.when(key % 2 == 0, F.col("o_orderpriority")).alias("loanStatus"),
        F.lit("z").alias("LOANSTATUS"),
    )
    return landing.canonical_columns(clashing)


@query
def all_string(spark, sf):
    orders = table(spark, sf, "orders")
    return landing.to_all_string(
        orders.select(
            "o_orderkey",
            (F.col("o_custkey") > 10).alias("flag"),
            F.col("o_orderdate").cast("timestamp").alias("at"),
            F.array("o_orderstatus").alias("tags"),
            F.col("o_totalprice").cast(MONEY).alias("price"),
        )
    )


@query
def ancient_dates(spark, sf):
    key = F.col("o_orderkey")
    years = F.when(key % 4 == 0, -800).otherwise(0)
    day = F.col("o_orderdate").cast("date")
    shifted = F.make_date(F.year(day) + years, F.month(day), F.least(F.dayofmonth(day), F.lit(28)))
    return drop_ancient_dates(table(spark, sf, "orders").select("o_orderkey", shifted.alias("closing_date")))


# ------------------------------------------------------------ column functions


@query
def money_values(spark, sf):
    loans = _loans(spark, sf)
    record = Record.of(loans)
    return loans.select(
        F.col("_id").alias("id"),
        safe_col(record, "dpaAmount", "money").alias("dpa"),
        safe_col(record, "firstMortgageTerm", "int").alias("term"),
        safe_col(record, "blueWaterId", "int").alias("bluewater"),
        safe_col(record, "firstMortgageInterestRate", "rate").alias("rate"),
        safe_col(record, "secondMortgageMinNumber", "clean").alias("min_number"),
        safe_col(record, "absent", "money").alias("absent"),
    )


@query
def money_text(spark, sf):
    sheet = raw(spark, sf, "external_sheet")
    value = numbers.money_text(F.col("premium"))
    return sheet.groupBy("premium").agg(F.count(F.lit(1)).alias("n"), F.max(value).alias("value"))


@query
def word_domains(spark, sf):
    """Booleans, settled and delinquency words, grouped by spelling."""
    loans = _loans(spark, sf)
    word = F.col("isEmployeeLoan"), F.col("secondMortgageSettledStatus"), F.col("secondMortgageDelinquencyStatus")
    return loans.groupBy(
        domains.safe_bool(word[0]).alias("is_employee"),
        domains.settled_status(word[1]).alias("settled"),
        domains.delinquency_bucket(word[2]).alias("bucket"),
    ).agg(F.count(F.lit(1)).alias("loans"))


@query
def flex_dates(spark, sf):
    sheet = raw(spark, sf, "external_sheet")
    return sheet.groupBy(
        F.col("date_requested_by_lender").alias("written"),
        dates.flex_date(F.col("date_requested_by_lender")).alias("day"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query
def norm_keys(spark, sf):
    sheet = raw(spark, sf, "external_sheet")
    c = F.col
    return sheet.groupBy(
        text.norm_token(c("lender_loan")).alias("token"),
        text.norm_token(c("lender_loan"), legacy_case=True).alias("legacy_token"),
        text.norm_lender(c("lender")).alias("lender"),
        text.norm_address(c("borrower_address")).alias("address"),
        text.zip5(c("borrower_zip")).alias("zip"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query
def ssn_mask(spark, sf):
    key = F.col("c_custkey")
    digits = F.concat(F.lit("123-45-"), F.lpad(key.cast("string"), 4, "0"))
    return table(spark, sf, "customer").select("c_custkey", text.mask_ssn(F.when(key % 5 != 0, digits)).alias("masked"))


@query
def fk_resolution(spark, sf):
    customers = table(spark, sf, "customer")
    key = F.col("c_custkey").cast("string")
    docs = customers.select(
        "c_custkey",
        key.alias("ownerId"),
        F.struct(F.concat(F.lit("s"), key).alias("_id"), F.lit("n").alias("name")).alias("loan"),
        F.struct(F.concat(F.lit("t"), key).alias("id")).alias("user"),
        F.concat(F.lit("p"), key).alias("plain"),
        F.when(F.col("c_custkey") % 2 == 0, key).alias("executiveId"),
        F.when(F.col("c_custkey") % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("e"), key))).alias("executiveIds"),
    )
    record = Record.of(docs)
    return docs.select(
        "c_custkey",
        *[resolve_fk(record, n).alias(n) for n in ("owner", "loan", "user", "plain", "absent")],
        first_of_list_fk(record, "executiveId", "executiveIds").alias("executive"),
    )


@query
def status_and_flood(spark, sf):
    """Normalised statuses and flood evidence, counted over all submissions."""
    return _fact(spark, sf).groupBy(
        "source_type", "status_normalized", "status_normalized_v2", "status_mapped",
        "flood_required_code", "flood_required_inferred_code", "flood_required_inference_source",
    ).agg(F.count(F.lit(1)).alias("n"))


@query
def age_and_condition(spark, sf):
    return _fact(spark, sf).groupBy("year_built", "age_bucket", "property_condition").agg(F.count(F.lit(1)).alias("n"))


@query
def excel_serial(spark, sf):
    key = F.col("o_orderkey")
    serial = (key * 7 % 60000).cast("double") + F.when(key % 2 == 0, 0.75).otherwise(0.0)
    return table(spark, sf, "orders").select("o_orderkey", dates.serial_to_date(serial).alias("day"))


# ------------------------------------------------------------------- calendar


@query
def calendar_staging(spark, sf):
    """Orders per day on the staging calendar."""
    orders = table(spark, sf, "orders").groupBy(F.col("o_orderdate").cast("date").alias("day_")).agg(F.count(F.lit(1)).alias("orders"))
    days = _calendar(spark, sf)
    return days.join(orders, days.date_key == orders.day_, "left").drop("day_")


@query
def calendar_curated(spark, sf):
    """Shipments per day on the curated calendar."""
    lines = table(spark, sf, "lineitem")
    day = F.col("l_shipdate").cast("date")
    shipped = lines.groupBy(day.alias("day_")).agg(F.count(F.lit(1)).alias("lines"))
    days = calendar.curated_calendar(calendar.days_between(shipped, F.col("day_"), F.col("day_")))
    return days.join(shipped, days.date == shipped.day_, "left").drop("day_")


@query
def date_keys(spark, sf):
    orders = table(spark, sf, "orders")
    day = F.col("o_orderdate").cast("date")
    return orders.groupBy(dates.date_key(day).alias("date_id"), dates.month_start(day).alias("month_start")).agg(
        F.count(F.lit(1)).alias("orders")
    )


# ------------------------------------------------------------------ sheet grid


def _cell(kind: str, value: Column) -> Column:
    return F.struct(F.lit(kind).alias("t"), value.cast("string").alias("v"))


def parts_grid(spark: SparkSession, sf: str) -> DataFrame:
    """One sheet per part brand: a title, a blank row, a header, then all its parts.

    Rows are numbered by part key, which is unique within a sheet, so building
    the grid needs no ordering of whole sheets.
    """
    parts = table(spark, sf, "part")
    sheet = [F.lit("parts.xlsx").alias("source_uri"), F.col("p_brand").alias("sheet")]
    blank = _cell("z", F.lit(None))
    serial = F.col("p_partkey") * 3 + 30000
    data = parts.select(
        *sheet,
        (F.col("p_partkey") + 3).cast("int").alias("row_idx"),
        F.array(
            _cell("n", F.col("p_partkey")),
            _cell("s", F.concat(F.lit(" "), F.col("p_name"))),
            _cell("n", F.col("p_size")),
            _cell("n", serial),
            _cell("b", F.col("p_size") > 25),
            _cell("d", F.lit("2024-11-18 00:00:00")),
            F.when(F.col("p_size") % 2 == 0, _cell("s", F.col("p_type"))).otherwise(_cell("e", F.lit("#N/A"))),
            blank,
            blank,
        ).alias("cells"),
    )
    header = F.array(*[_cell("s", F.lit(h)) for h in ("Part #", "Part Name", "Size", "Setup Date", "Large", "Day", "Type")], blank, blank)
    title = F.array(_cell("s", F.lit("Parts on hand")), *[blank] * 8)
    tops = F.array(
        F.struct(F.lit(0).alias("row_idx"), title.alias("cells")),
        F.struct(F.lit(1).alias("row_idx"), F.array(*[blank] * 9).alias("cells")),
        F.struct(F.lit(2).alias("row_idx"), header.alias("cells")),
    )
    sheets = parts.select(*sheet).distinct()
    heads = sheets.select("source_uri", "sheet", F.inline(tops))
    return data.unionByName(heads)


@query
def grid_header(spark, sf):
    return grids.header_rows(parts_grid(spark, sf)).select(
        "source_uri", "sheet", "header_idx", "width", F.array_join("headers", "|").alias("headers")
    )


@query
def grid_rows(spark, sf):
    rows = grids.sheet_rows(parts_grid(spark, sf))
    return rows.select("source_uri", "sheet", "row_idx", F.array_join("values", "|").alias("values"))


@query
def grid_cells(spark, sf):
    cells = grids.sheet_cells(grids.sheet_rows(parts_grid(spark, sf)))
    return cells.groupBy("sheet", "header").agg(
        F.count(F.lit(1)).alias("cells"), F.count_if(F.col("value") != "").alias("filled"), F.max("value").alias("largest")
    )


@query
def non_blank_profile(spark, sf):
    return grids.non_blank_counts(raw(spark, sf, "external_sheet"))


@query
def drop_empty_columns(spark, sf):
    lines = table(spark, sf, "lineitem")
    padded = lines.select(
        F.col("l_orderkey").cast("string").alias("Order Key"),
        F.lit("  ").alias("Blank Column"),
        F.col("l_returnflag").alias("ReturnFlag"),
        F.lit(None).cast("string").alias("Missing"),
    )
    kept = grids.snake_columns(grids.drop_empty_columns(padded))
    return kept.groupBy(*kept.columns).agg(F.count(F.lit(1)).alias("n"))


# -------------------------------------------------------------------- quality


@query
def quality_checks(spark, sf):
    """Domain, pattern, range, required, unique and referential checks as one table."""
    orders, lines, customers = (table(spark, sf, t) for t in ("orders", "lineitem", "customer"))
    users = raw(spark, sf, "users")
    email = F.when(F.col("email").startswith("user1"), F.regexp_replace("email", "@", " at ")).otherwise(F.col("email"))
    loans, users = _base(spark, sf), users.withColumn("email", email)
    checks = [
        quality.check(orders, quality.domain("o_orderstatus", ["F", "O"])),
        quality.check(users, quality.pattern("email", quality.EMAIL)),
        quality.check(customers, quality.pattern("c_name", "^Customer#[0-9]+1$")),
        quality.check(loans, quality.in_range("credit_score", 600, 700), quality.required("loan_id", "product_type", "closing_date")),
        quality.unique(lines, "l_orderkey", "l_linenumber"),
        quality.unique(lines, "l_orderkey", where=F.col("l_returnflag") == "R"),
        quality.referential(lines, "l_suppkey", orders, "o_custkey"),
    ]
    out = checks[0]
    for more in checks[1:]:
        out = out.unionByName(more)
    return out


@query
def duplicate_keys(spark, sf):
    return quality.duplicate_keys(table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")


@query
def staleness(spark, sf):
    """The newest order day, kept as text, seen from a fixed day."""
    orders = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").cast("string").alias("_etl_extracted_at"))
    return quality.staleness(orders, "_etl_extracted_at", AS_OF, max_days=2)


@query
def dead_letter(spark, sf):
    """Loans that cannot be read, by reason."""
    loans = _loans(spark, sf)
    record = Record.of(loans)
    unreadable = loans["blueWaterId"].isNotNull() & safe_col(record, "blueWaterId", "int").isNull()
    _, bad = quality.split_bad_records(
        loans,
        ("bad bluewater id", unreadable),
        ("no product", loans["productType"].isNull()),
        ("no amount", safe_col(record, "dpaAmount", "money").isNull()),
    )
    return bad.groupBy(F.array_join("reasons", "; ").alias("reasons")).agg(F.count(F.lit(1)).alias("loans"))


# ----------------------------------------------- publishing, history and trends


@query
def snapshot_publish(spark, sf):
    """Orders published as a snapshot twice, read back and totalled."""
    path = scratch_path(spark, "snapshot")
    orders = table(spark, sf, "orders").withColumn("price", F.col("o_totalprice").cast(MONEY))
    for day in ("2024-01-01", "2024-01-02"):
        publish.publish(orders, path, "snapshot", day)
    back = spark.read.parquet(path)
    return back.groupBy(F.col("dt").cast("string").alias("dt"), "o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("price").alias("total")
    )


@query
def partition_publish(spark, sf):
    """Orders published for two days, the second day again; history is kept."""
    path = scratch_path(spark, "daily")
    orders = table(spark, sf, "orders").withColumn("price", F.col("o_totalprice").cast(MONEY))
    for day in ("2024-01-01", "2024-01-02", "2024-01-02"):
        publish.publish(orders, path, "daily_partition", day)
    back = spark.read.parquet(path)
    return back.groupBy(F.col("dt").cast("string").alias("dt"), "o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("price").alias("total")
    )


@query
def scd2(spark, sf):
    events = table(spark, sf, "events")
    return history.scd2(events, ["user_id"], "ts", ["event_type"], ["event_id"])


@query
def servicing_scorecard(spark, sf):
    loans = _loans(spark, sf)
    metrics = star.fact_loan_metrics(loans).select("loan_id", "credit_score", "backend_dti", "second_mortgage_upb")
    status = star.fact_loan_status(loans).select("loan_id", "current_status", "second_mortgage_delinquency_status")
    return scorecard.servicing_scorecard(
        status.join(metrics, "loan_id"),
        ["current_status"], "credit_score", "backend_dti", "second_mortgage_delinquency_status", "second_mortgage_upb",
    )


@query
def fico_bands(spark, sf):
    metrics = star.fact_loan_metrics(_loans(spark, sf))
    return scorecard.band_counts(metrics, domains.fico_band(F.col("credit_score")), "dpa_amount")


@query
def yoy_growth(spark, sf):
    base = _base(spark, sf)
    closed = base.filter("closing_date is not null and product_type is not null")
    monthly = closed.groupBy("product_type", dates.month_start(F.col("closing_date")).alias("month_start")).agg(
        F.count(F.lit(1)).alias("closings")
    )
    return trends.growth(monthly, "month_start", "closings", ["product_type"])


@query
def corr_driver(spark, sf):
    lines = table(spark, sf, "lineitem")
    found = trends.correlations(lines, "l_extendedprice", ["l_quantity", "l_discount"], ["l_returnflag"])
    return found.select("l_returnflag", *[F.round(c, 6).alias(c) for c in found.columns if c.startswith("corr_")])


@query
def days_to_clear(spark, sf):
    conditions = scorecard.fact_conditions(star.dim_loancondition(raw(spark, sf, "conditions")))
    return conditions.groupBy("condition_source", "status", "days_to_clear").agg(F.count(F.lit(1)).alias("conditions"))


@query
def condition_turnaround(spark, sf):
    conditions = star.dim_loancondition(raw(spark, sf, "conditions"))
    return scorecard.turnaround(conditions, ["condition_source"], "submitted_at", "cleared_at", 7, AS_OF)


@query
def loan_aging(spark, sf):
    base = _base(spark, sf)
    return scorecard.aging(base.filter("closing_date is null"), "created_at", AS_OF)


@query
def variance(spark, sf):
    loans = _loans(spark, sf)
    amounts = star.fact_loan_metrics(loans).select("loan_id", "dpa_amount", "second_mortgage_upb")
    return scorecard.variance(amounts, "second_mortgage_upb", "dpa_amount")


@query
def loan_snapshot(spark, sf):
    base = _base(spark, sf)
    return history.daily_snapshot(
        base, F.lit(AS_OF), ["loan_id", "product_type", "current_status", "registered_at", "dpa_amount", "second_mortgage_upb"]
    )


@query
def privacy_policy(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", F.col("c_nationkey").cast("string").alias("nation"))
    return privacy.apply_policy(customers, {"c_name": "hash", "c_mktsegment": "last4", "nation": "null"}, salt="s1")


@query
def slicer_counts(spark, sf):
    lines = table(spark, sf, "lineitem")
    kept = rollup.apply_slicers(lines, {"l_returnflag": ["A", "R"], "l_linestatus": "O"})
    return rollup.distinct_counts(kept, ["l_returnflag"], "l_orderkey", {"orders": F.lit(True), "large": F.col("l_quantity") > 30})


from catalog import runs as _runs  # noqa: E402, F401 - registers its queries

from catalog import kept as _kept  # noqa: E402, F401 - registers its queries
