"""Closings, registrations, drill-downs and dashboards over the star schema.

Frames are returned unordered; ``newest_first`` adds a presentation order.
Nothing reads the clock: "today" is the ``as_of`` argument.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.functions import dates, domains
from hearthline.functions.numbers import decimal_avg, exact_avg
from hearthline.functions.text import as_text
from hearthline.operators.lookup import lookup
from hearthline.operators.rollup import pivot_sums, share_of_total

BUYERS = {"USF": "usf", "MWF": "mwf"}
# Registration pivot columns.
PRODUCT_COLUMNS = {
    "DPA": "dpa_registrations",
    "EEP": "eep_registrations",
    "White Label": "whitelabel_registrations",
    "Solar Program": "solar_registrations",
}


def loan_base(loans: DataFrame, status: DataFrame, metrics: DataFrame) -> DataFrame:
    """Loans with their status and metrics columns: three 1:1 tables on loan_id.

    Columns present in more than one table are taken from loans, then status.
    Only columns a report uses survive pruning, and filters on loans are pushed
    below both joins.  Written tables bucketed by loan_id join without a shuffle;
    straight from raw loans, ``star.loan_wide`` gives the same rows without joins.
    """
    have = set(loans.columns)
    status = status.select("loan_id", *[c for c in status.columns if c not in have])
    have |= set(status.columns)
    metrics = metrics.select("loan_id", *[c for c in metrics.columns if c not in have])
    return loans.join(status, "loan_id", "left").join(metrics, "loan_id", "left")


def product_is(code: str) -> Column:
    return F.upper(as_text(F.col("product_type"))) == code.upper()


def in_year(column: str, year: int | None, month: int | None = None) -> Column:
    """A year or month as a date range, which the scan can use to skip data."""
    if year is None:
        return F.lit(True)
    first = date(year, month or 1, 1)
    if month is None or month == 12:
        last = date(year + 1, 1, 1)
    else:
        last = date(year, month + 1, 1)
    return (F.col(column) >= F.lit(first)) & (F.col(column) < F.lit(last))


def _closed(base: DataFrame, product: str, year: int | None, month: int | None) -> DataFrame:
    return base.filter(product_is(product) & F.col("closing_date").isNotNull() & in_year("closing_date", year, month))


def _closing_month() -> list[Column]:
    day = F.col("closing_date")
    return [
        F.year(day).alias("closing_year"),
        F.month(day).alias("closing_month"),
        dates.year_month(day).alias("year_month"),
    ]


def _closing_measures() -> list[Column]:
    amount = F.coalesce(F.col("dpa_amount"), F.lit(0).cast("decimal(18,2)"))
    return [
        F.count(F.lit(1)).alias("closing_count"),
        F.sum(amount).alias("total_dpa_amount"),
        decimal_avg(amount).alias("avg_dpa_amount"),
        F.count_distinct("correspondent_id").alias("correspondent_count"),
    ]


def newest_first(df: DataFrame, *then: str) -> DataFrame:
    year, month = [c for c in df.columns if c.endswith("_year") or c.endswith("_month")][:2]
    return df.orderBy(F.desc(year), F.desc(month), *then)


def monthly_closings(base: DataFrame, product: str = "EEP", year: int | None = None, month: int | None = None) -> DataFrame:
    return _closed(base, product, year, month).groupBy(*_closing_month()).agg(
        *_closing_measures(),
        F.min("closing_date").alias("first_closing"),
        F.max("closing_date").alias("last_closing"),
    )


def buyer(rule: str) -> Column:
    """The three buyer rules in use: ``raw``, ``two_way`` and ``three_way``."""
    ownership, number = F.col("first_mortgage_ownership_status"), F.col("usf_loan_number")
    if rule == "raw":
        return ownership
    if rule == "two_way":
        return domains.buyer_from_marks(ownership, number)
    if rule == "three_way":
        return domains.buyer_three_way(ownership, number, F.col("contract_date"))
    raise ValueError(f"unknown buyer rule {rule!r}")


def monthly_closings_by_buyer(
    base: DataFrame, rule: str = "raw", product: str = "DPA", year: int | None = None, month: int | None = None
) -> DataFrame:
    """Closings per month and buyer.  ``three_way`` needs ``contract_date`` (see with_contract_date)."""
    closed = _closed(base, product, year, month)
    return closed.groupBy(*_closing_month(), buyer(rule).alias("buyer")).agg(*_closing_measures())


def with_contract_date(base: DataFrame, correspondents: DataFrame, column: str = "contract_date") -> DataFrame:
    """The partner's contract date on each loan, which the three-way buyer rule reads."""
    dated = correspondents.select("correspondent_id", F.col(column).alias("contract_date"))
    return lookup(base, dated, "correspondent_id")


def buyer_pivot(by_buyer: DataFrame) -> DataFrame:
    names = {**{k: f"{v}_closings" for k, v in BUYERS.items()}, "Unknown": "unknown_closings"}
    return pivot_sums(by_buyer, ["year_month"], "buyer", "closing_count", names, "total_closings")


def buyer_yearly(by_buyer: DataFrame) -> DataFrame:
    names = {k: f"{v}_total" for k, v in BUYERS.items()}
    return pivot_sums(by_buyer, ["closing_year"], "buyer", "closing_count", names, "grand_total")


def buyer_share(base: DataFrame, rule: str = "three_way", product: str = "DPA", year: int | None = None, month: int | None = None) -> DataFrame:
    """Closings per month and buyer with the month total and the buyer's share of it."""
    counted = _closed(base, product, year, month).groupBy(*_closing_month(), buyer(rule).alias("buyer")).agg(
        F.count(F.lit(1)).alias("closing_count"),
        F.min("closing_date").cast("timestamp").alias("first_closing_date"),
        F.max("closing_date").cast("timestamp").alias("last_closing_date"),
    )
    counted = counted.withColumnRenamed("year_month", "closing_year_month")
    month_key = ["closing_year", "closing_month", "closing_year_month"]
    return share_of_total(counted, "closing_count", month_key, "total_closings_month", "buyer_percentage")


def buyer_share_detail(base: DataFrame, rule: str = "three_way", product: str = "DPA") -> DataFrame:
    """The loans behind ``buyer_share``, ready to be partitioned by year, month and buyer."""
    day = F.col("closing_date")
    return _closed(base, product, None, None).select(
        F.year(day).alias("year"), F.month(day).alias("month"), buyer(rule).alias("buyer"),
        "loan_id", "correspondent_id", "closing_date", "dpa_amount",
    )


def registrations_by_product(loans: DataFrame, status: DataFrame, year: int | None = None) -> DataFrame:
    at = F.col("registered_at")
    registered = status.filter(at.isNotNull() & in_year("registered_at", year)).select("loan_id", "registered_at")
    known = loans.select("loan_id", "product_type", "correspondent_id")
    return registered.join(known, "loan_id").groupBy(
        F.year(at).alias("registration_year"),
        F.month(at).alias("registration_month"),
        dates.year_month(at).alias("year_month"),
        F.coalesce("product_type", F.lit("Unknown")).alias("product_type"),
    ).agg(
        F.count(F.lit(1)).alias("registration_count"),
        F.count_distinct("correspondent_id").alias("correspondent_count"),
        F.min(at).alias("first_registration"),
        F.max(at).alias("last_registration"),
    )


def registration_pivot(by_product: DataFrame) -> DataFrame:
    return pivot_sums(
        by_product, ["year_month"], "product_type", "registration_count", PRODUCT_COLUMNS, "total_registrations"
    )


def registration_share(by_product: DataFrame) -> DataFrame:
    kept = by_product.select(
        "registration_year", "registration_month", "year_month", "product_type", "registration_count"
    )
    month_key = ["registration_year", "registration_month", "year_month"]
    return share_of_total(kept, "registration_count", month_key, "total_registrations_month", "product_percentage")


def primary_borrowers(borrowers: DataFrame) -> DataFrame:
    """Names of primary borrowers; the filter sits on the child side of later joins."""
    first, last = F.col("first_name"), F.col("last_name")
    return borrowers.filter("is_primary").select(
        "loan_id",
        first.alias("borrower_first_name"),
        last.alias("borrower_last_name"),
    )


def _with_people(base: DataFrame, correspondents: DataFrame, borrowers: DataFrame) -> DataFrame:
    partners = correspondents.select("correspondent_id", F.col("correspondent_name").alias("lender_correspondent"))
    loans = base.join(primary_borrowers(borrowers), "loan_id", "left")
    named = lookup(loans, partners, "correspondent_id")
    first, last = as_text(F.col("borrower_first_name")), as_text(F.col("borrower_last_name"))
    return named.withColumn("borrower_name", F.concat(first, F.lit(" "), last))


# Columns of the two drill-downs.
DETAIL_PARTS = {
    "ids": "loan_id ah_loan_number:loan_number lender_loan_number usf_loan_number",
    "people": "borrower_first_name borrower_last_name borrower_name",
    "amounts": "first_mortgage_total_amount:loan_amount first_mortgage_base_amount dpa_amount dpa_percent "
    "purchase_price appraised_value",
    "partner": "correspondent_id lender_correspondent loan_officer_name loan_officer_email",
    "property": "property_address property_city property_state property_zip property_county property_type",
}
MILESTONES = (
    "created_at:application_received_date registered_at:registration_date locked_at:lock_date "
    "clear_to_close_at:{review} approved_for_purchase_at:approval_date closing_date:closing_date "
    "closed_at:funding_date purchased_at:purchase_date securitized_at:recording_date"
)
STATES = "current_status:loan_status health_status first_mortgage_ownership_status:servicing_member"


def _named(spec: str, leave_out: Sequence[str] = (), cast: str | None = None) -> list[Column]:
    made = []
    for entry in spec.split():
        source, _, alias = entry.partition(":")
        if source not in leave_out:
            value = F.col(source).cast(cast) if cast else F.col(source)
            made.append(value.alias(alias or source))
    return made


def loan_details(base: DataFrame, correspondents: DataFrame, borrowers: DataFrame) -> DataFrame:
    """Every loan with partner, primary borrower, amounts and milestones."""
    rows = _with_people(base, correspondents, borrowers)
    return rows.select(
        *_closing_month(),
        buyer("raw").alias("buyer"),
        *_named(DETAIL_PARTS["ids"]),
        *_named(DETAIL_PARTS["people"]),
        "product_type",
        F.col("dpa_repayment_type").alias("dpa_program_type"),
        "workflow_type",
        "first_mortgage_type",
        *_named(DETAIL_PARTS["amounts"]),
        *_named(DETAIL_PARTS["partner"]),
        *_named(DETAIL_PARTS["property"]),
        *_named(MILESTONES.format(review="eligibility_review_date"), cast="date"),
        *_named(STATES),
    )


def product_loan_details(base: DataFrame, correspondents: DataFrame, borrowers: DataFrame, product: str = "DPA") -> DataFrame:
    """Closed loans of one product with the two-way buyer; a narrower drill-down."""
    rows = _with_people(_closed(base, product, None, None), correspondents, borrowers)
    hidden = ("first_mortgage_base_amount", "appraised_value", "loan_officer_email", "property_type")
    return rows.select(
        *_closing_month(),
        buyer("two_way").alias("buyer"),
        *_named(DETAIL_PARTS["ids"]),
        *_named(DETAIL_PARTS["people"]),
        F.col("product_type").alias("dpa_program_name"),
        F.col("dpa_repayment_type").alias("dpa_program_type"),
        "workflow_type",
        *_named(DETAIL_PARTS["amounts"], hidden),
        *_named(DETAIL_PARTS["partner"], hidden),
        *_named(DETAIL_PARTS["property"], hidden),
        *_named(MILESTONES.format(review="clear_to_close_date"), cast="date"),
        *_named(STATES),
    )


def current_overview(base: DataFrame, as_of: date) -> DataFrame:
    """Per product: loans closed or registered since one month before ``as_of``."""
    since = F.add_months(F.lit(as_of), F.lit(-1))
    recent = base.filter((F.col("closing_date") >= since) | (F.col("registered_at") >= since.cast("timestamp")))
    return recent.groupBy(F.col("product_type").alias("product")).agg(
        F.count(F.lit(1)).alias("loans"),
        F.count("closing_date").alias("closings"),
        F.count("registered_at").alias("registrations"),
    )


def ytd_by_product(base: DataFrame, as_of: date) -> DataFrame:
    """Closings and volume per product and month since January 1 of ``as_of``'s year."""
    this_year = base.filter(F.col("closing_date") >= F.lit(date(as_of.year, 1, 1)))
    return this_year.groupBy("product_type", dates.year_month(F.col("closing_date")).alias("month")).agg(
        F.count(F.lit(1)).alias("closings"), F.sum("dpa_amount").alias("dpa_volume")
    )


def _calendar_months(calendar: DataFrame) -> DataFrame:
    return calendar.select("date_id", "year", "month", "year_month")


def correspondent_dashboard(base: DataFrame, correspondents: DataFrame, calendar: DataFrame) -> DataFrame:
    """Per partner and closing month: loan counts, volumes and averages.

    Rows are reduced to (partner, month, loan) first, so a loan that occurs twice counts
    once and a hot partner is shared by many tasks; amounts add up over rows.
    """
    status = F.col("current_status")
    known = F.col("loan_id").isNotNull()
    months = _calendar_months(calendar)
    dated = base.join(months, base.closing_date_key == months.date_id)
    month = ("correspondent_id", "year", "month", "year_month")
    per_loan = dated.groupBy(*month, "loan_id").agg(
        F.max(known.cast("int")).alias("n"),
        F.max((known & (status == "Purchased")).cast("int")).alias("purchased"),
        F.max((known & (status == "Cancelled")).cast("int")).alias("cancelled"),
        F.sum("first_mortgage_total_amount").alias("volume"),
        F.sum(F.col("first_mortgage_interest_rate").cast("decimal(18,6)")).alias("rate_sum"),
        F.count("first_mortgage_interest_rate").alias("rate_n"),
        F.sum("credit_score").alias("score_sum"),
        F.count("credit_score").alias("score_n"),
        F.sum("dpa_amount").alias("dpa"),
    )
    sums = "n purchased cancelled volume rate_sum rate_n score_sum score_n dpa".split()
    dated = per_loan.groupBy(*month).agg(*[F.sum(c).alias(c) for c in sums])
    # Loans of unknown partners share one group without a key.
    names = correspondents.select(F.col("correspondent_id").alias("_known_id"), "correspondent_name")
    named = dated.join(names, dated.correspondent_id == names["_known_id"], "left")
    return named.groupBy(
        F.col("_known_id").alias("correspondent_id"), "correspondent_name", "year", "month", "year_month"
    ).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(name) for c, name in (("n", "total_loans"), ("purchased", "purchased_loans"), ("cancelled", "cancelled_loans"))],
        F.sum("volume").cast("decimal(28,2)").alias("total_loan_volume"),
        F.round(F.sum("rate_sum") / F.sum("rate_n"), 6).cast("decimal(10,6)").alias("avg_interest_rate"),
        (F.sum("score_sum").cast("double") / F.sum("score_n")).alias("avg_credit_score"),
        F.sum("dpa").cast("decimal(28,2)").alias("total_dpa_amount"),
    )


def monthly_metrics(base: DataFrame, calendar: DataFrame) -> DataFrame:
    """Per calendar month, product and workflow: loans, volumes and averages.

    A loan that occurs twice counts once.
    """
    months = _calendar_months(calendar)
    dated = base.join(months, base.closing_date_key == months.date_id)
    total, dpa = F.col("first_mortgage_total_amount"), F.col("dpa_amount")
    return dated.groupBy("year", "month", "year_month", "product_type", "workflow_type").agg(
        F.count_distinct("loan_id").alias("loan_count"),
        F.sum(total).alias("total_volume"),
        decimal_avg(total).alias("avg_loan_amount"),
        F.sum(dpa).alias("total_dpa_volume"),
        decimal_avg(dpa).alias("avg_dpa_amount"),
        exact_avg(F.col("credit_score")).alias("avg_credit_score"),
        decimal_avg(F.col("backend_dti"), 6).alias("avg_dti"),
        decimal_avg(F.col("combined_ltv"), 6).alias("avg_ltv"),
    )


def amounts_by_month(metrics: DataFrame, calendar: DataFrame, product: str = "DPA") -> DataFrame:
    chosen = metrics.filter(F.col("product_type") == product)
    months = _calendar_months(calendar)
    return chosen.join(months, chosen.closing_date_key == months.date_id).groupBy("year_month").agg(
        F.count(F.lit(1)).alias("dpa_loans"),
        F.sum("dpa_amount").alias("total_dpa"),
        decimal_avg(F.col("dpa_percent"), 6).alias("avg_dpa_percent"),
    )


def volume_by_product(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("product_type").agg(
        F.count(F.lit(1)).alias("loan_count"), F.sum("first_mortgage_total_amount").alias("total_volume")
    )
