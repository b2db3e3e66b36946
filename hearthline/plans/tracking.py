"""Procurement analysis view, scorecard and trends."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.functions import dates, domains
from hearthline.functions.numbers import exact_avg, percent_of
from hearthline.functions.text import blank_to_null, has_text
from hearthline.operators.rollup import apply_slicers, distinct_counts, month_roles

BLANK = "Blank"
# Names of the age buckets on the scorecard.
AGE_COLUMNS = {
    "worked_loans_1978_or_older": "1978 or older",
    "worked_loans_newer_than_1978": "Newer than 1978",
}


def _or_blank(c: Column) -> Column:
    return F.coalesce(blank_to_null(c), F.lit(BLANK))


def procurement_analysis(fact: DataFrame, as_of: date) -> DataFrame:
    """One row per submission with the labels, buckets and flags dashboards filter on."""
    c = F.col
    request, close = c("request_month_start"), c("close_month_start")
    month = F.coalesce(request, close)
    closed = c("closed_flag") == 1
    loan_known = has_text(c("loan_key_v3"))

    def label(m: Column) -> Column:
        return F.coalesce(dates.month_label(m), F.lit(BLANK))

    def sort_key(m: Column) -> Column:
        return F.coalesce(dates.month_sort(m), F.lit(0))

    bucket = F.coalesce(domains.flood_label(c("flood_required_inferred_code")), F.lit("Unknown"))
    source = F.when(domains.is_internal_source(c("source_type")), "Internal Procured").otherwise("External")
    metadata = [n for n in ("dt", "_etl_loaded_at") if n in fact.columns]
    return fact.filter(has_text(c("loan_key"))).select(
        *"loan_key loan_key_v2 loan_key_v3 loan_number_norm policy_number_norm ah_loan_number_norm".split(),
        source.alias("source"),
        c("source_type").alias("source_type_raw"),
        "state",
        _or_blank(c("status_normalized_v2")).alias("status"),
        "status_normalized",
        "status_normalized_v2",
        _or_blank(c("policy_type_raw")).alias("policy_type"),
        *"policy_type_raw flood_required_flag flood_required_code flood_required_inferred_code".split(),
        bucket.alias("flood_required_bucket"),
        *"age_bucket year_built property_condition dwelling_amount premium closed_flag days_to_close".split(),
        *"request_date close_bind_date request_month_start close_month_start".split(),
        label(request).alias("request_month_label"),
        sort_key(request).alias("request_year_month_sort"),
        label(close).alias("close_month_label"),
        sort_key(close).alias("close_year_month_sort"),
        label(month).alias("month_label"),
        sort_key(month).alias("year_month_sort"),
        dates.month_label(F.lit(as_of)).alias("current_month_label"),
        F.coalesce(month == F.lit(as_of.replace(day=1)), F.lit(False)).cast("int").alias("is_current_month"),
        F.lit(1).alias("is_worked_submission"),
        closed.cast("int").alias("is_closed_submission"),
        loan_known.cast("int").alias("is_worked_loan_row"),
        (closed & loan_known).cast("int").alias("is_closed_loan_row"),
        *"lender_name lender_canonical lender_group address city zip county borrower_name".split(),
        *metadata,
    )


def kpi_scorecard(view: DataFrame, slicers: Mapping[str, object] | None = None) -> DataFrame:
    """One row of submission and loan measures, optionally for a slice.

    Six distinct counts share one reduction to the loan instead of one row
    expansion per count.
    """
    c = F.col
    flags = {
        "worked_loans": F.lit(True),
        "closed_loans": c("is_closed_loan_row") == 1,
        "loans_flood_required": c("flood_required_inferred_code") == "REQ",
        **{name: c("age_bucket") == bucket for name, bucket in AGE_COLUMNS.items()},
    }
    sliced = apply_slicers(view, slicers)
    # Closed submissions are summed, not flagged, so they ride along per loan.
    reduced = sliced.groupBy("loan_key_v3").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("is_closed_submission").alias("closed_rows"),
        *[F.max((c("loan_key_v3").isNotNull() & F.coalesce(f, F.lit(False))).cast("int")).alias(n) for n, f in flags.items()],
    )
    totals = reduced.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("worked_submissions"),
        F.sum("closed_rows").alias("closed_submissions"),
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in flags],
    )
    rate = percent_of(c("closed_loans"), c("worked_loans")).cast("decimal(5,2)")
    return totals.withColumn("loans_close_rate_pct", rate)


def _by_month(view: DataFrame, slicers: Mapping[str, object] | None, value: str | None = None) -> DataFrame:
    sliced = apply_slicers(view, slicers)
    return month_roles(
        sliced, "loan_key_v3", "request_month_start", "close_month_start", "is_closed_loan_row", value
    )


def _on_axis(measured: DataFrame, months: DataFrame | None) -> DataFrame:
    """Measures per month with the months' labels; ``months`` adds those without any measure.

    A view's own months all have a measure, so they need no second pass over it.
    """
    if months is not None:
        return months.select("month_start", "month_label", "year_month_sort").join(measured, "month_start", "left")
    month = F.col("month_start")
    return measured.withColumns({"month_label": dates.month_label(month), "year_month_sort": dates.month_sort(month)})


def month_trend(view: DataFrame, months: DataFrame | None = None, slicers: Mapping[str, object] | None = None) -> DataFrame:
    """Worked loans, closed loans and submissions per month.

    A submission counts in its request month and, if closed, in its close month.  Without
    ``months``, the months that occur; with them, empty months show 0.
    """
    measures = {"worked_loans": "worked", "closed_loans": "closed", "worked_submissions": "submissions"}
    counts = _by_month(view, slicers).groupBy("month_start").agg(
        *[F.sum(source).alias(name) for name, source in measures.items()]
    )
    return _on_axis(counts, months).select(
        "month_label", "year_month_sort", *[F.coalesce(m, F.lit(0)).alias(m) for m in measures]
    )


def _averages(view: DataFrame, value: str, label: str, slicers: Mapping[str, object] | None) -> DataFrame:
    """(month_start, avg_{label}_worked, avg_{label}_closed) over known loans.

    Months come out once, so the two roles never multiply each other's rows.
    """
    def mean(role: str) -> Column:
        return exact_avg(F.when(F.col(role) == 1, F.col(f"{role}_top"))).alias(f"avg_{label}_{role}")

    per_loan = _by_month(view, slicers, value)
    return per_loan.groupBy("month_start").agg(mean("worked"), mean("closed"))


def avg_by_month(
    view: DataFrame, value: str, label: str, months: DataFrame | None = None, slicers: Mapping[str, object] | None = None
) -> DataFrame:
    """Mean over loans of the loan's largest ``value``, worked against closed, per month."""
    names = [f"avg_{label}_{role}" for role in ("worked", "closed")]
    return _on_axis(_averages(view, value, label, slicers), months).select("month_label", "year_month_sort", *names)


def avg_coverage_by_month(view: DataFrame, months: DataFrame | None = None, slicers: Mapping[str, object] | None = None) -> DataFrame:
    return avg_by_month(view, "dwelling_amount", "coverage", months, slicers)


def avg_premium_by_month(view: DataFrame, months: DataFrame | None = None, slicers: Mapping[str, object] | None = None) -> DataFrame:
    return avg_by_month(view, "premium", "premium", months, slicers)


def avg_premium_observed(view: DataFrame, slicers: Mapping[str, object] | None = None) -> DataFrame:
    """As ``avg_premium_by_month`` for months that have a premium, without a month table."""
    month = F.col("month_start")
    means = _averages(view, "premium", "premium", slicers)
    names = ("avg_premium_worked", "avg_premium_closed")
    return means.filter(F.coalesce(*names).isNotNull()).select(
        dates.month_label(month).alias("month_label"), dates.month_sort(month).alias("year_month_sort"), month, *names
    )


def flood_donut(view: DataFrame, slicers: Mapping[str, object] | None = None) -> DataFrame:
    counts = distinct_counts(
        apply_slicers(view, slicers), ["flood_required_bucket"], "loan_key_v3", {"worked_loans": F.lit(True)}
    )
    return counts.drop("rows")


def closed_by_source(view: DataFrame, slicers: Mapping[str, object] | None = None) -> DataFrame:
    flags = {"closed_loans": F.col("is_closed_loan_row") == 1}
    return distinct_counts(apply_slicers(view, slicers), ["source"], "loan_key_v3", flags).drop("rows")


def filter_lists(view: DataFrame) -> DataFrame:
    """(list, value, sort_key): the choices of all five slicers, from one pass over the view."""
    entries = [
        F.struct(F.lit(name).alias("list"), F.col(name).alias("value"), F.lit(0).alias("sort_key"))
        for name in ("source", "state", "status", "policy_type")
    ]
    month = F.struct(
        F.lit("month_label").alias("list"),
        F.col("month_label").alias("value"),
        F.col("request_year_month_sort").alias("sort_key"),
    )
    # The combination is reduced before it is unpivoted: few rows reach the explode.
    used = "source state status policy_type month_label request_year_month_sort".split()
    combos = view.select(*used).distinct()
    return combos.select(F.inline(F.array(*entries, month))).distinct()


def current_month(days: DataFrame, day: str) -> DataFrame:
    """Label and sort key of the month of each row's day."""
    value = F.col(day)
    return days.select(
        dates.month_label(value).alias("current_month_label"), dates.month_sort(value).alias("year_month_sort"), value.alias("as_of_date")
    )


def current_month_default(spark: SparkSession, as_of: date) -> DataFrame:
    return current_month(spark.range(1).select(F.lit(as_of).alias("day")), "day")


def label_check(view: DataFrame) -> DataFrame:
    """Sanity counts: rows and filled month labels."""
    return view.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("month_label").alias("with_month_label"),
        F.count("request_month_label").alias("with_request_month"),
        F.count("close_month_label").alias("with_close_month"),
    )
