"""Servicing scorecards, condition turnaround, aging and reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.functions import domains

# The delinquency buckets a scorecard counts.
LATE = {"30-59": "30_to_59", "60-89": "60_to_89", "90+": "90plus"}


def _tag(band: str) -> str:
    return band.replace("-", "_to_").replace("+", "_plus")


def servicing_scorecard(
    loans: DataFrame, by: Sequence[str], fico: str, dti: str, delinquency: str, volume: str
) -> DataFrame:
    """Units and volumes per group: all, per delinquency, and per delinquency x score or ratio band.

    One row per group; loans are banded in the scan and added up in one pass.
    """
    banded = loans.select(
        *by,
        domains.fico_band(F.col(fico)).alias("_fico"),
        domains.dti_band(F.col(dti)).alias("_dti"),
        F.col(delinquency).alias("_late"),
        F.col(volume).cast("decimal(18,2)").alias("_volume"),
    )

    def pair(stem: str, condition: Column) -> list[Column]:
        amount = F.sum(F.when(condition, F.col("_volume")).otherwise(F.lit(0).cast("decimal(18,2)")))
        return [
            F.count_if(condition).alias(stem.format("units")),
            amount.cast("decimal(28,2)").alias(stem.format("volume")),
        ]

    measures = pair("total_servicing_{}", F.lit(True))
    for bucket, tag in LATE.items():
        late = F.col("_late") == bucket
        measures += pair(f"servicing_{{}}_delinquent_{tag}", late)
        for kind, bands in (("fico", domains.FICO_BANDS), ("dti", domains.DTI_BANDS)):
            for name in bands:
                stem = f"delinquency_{tag}_{{}}_by_{kind}_{_tag(name)}"
                measures += pair(stem, late & (F.col(f"_{kind}") == name))
    return banded.groupBy(*by).agg(*measures)


def band_counts(loans: DataFrame, band: Column, volume: str, extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Long form: (band, units, volume) plus any extra counted conditions."""
    counted = [F.count_if(c).alias(n) for n, c in (extra or {}).items()]
    total = F.sum(F.col(volume).cast("decimal(18,2)")).cast("decimal(28,2)")
    return loans.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("units"), total.alias("volume"), *counted)


def days_between(start: str, end: str) -> Column:
    """Whole days from start to end; NULL while either is missing."""
    return F.datediff(F.col(end), F.col(start))


def fact_conditions(conditions: DataFrame) -> DataFrame:
    """Conditions with the days they took to clear."""
    return conditions.withColumn("days_to_clear", days_between("created_at", "cleared_at"))


def variance(df: DataFrame, invoice: str, payment: str) -> DataFrame:
    """Invoice minus payment."""
    amounts = [F.col(c).cast("decimal(18,2)") for c in (invoice, payment)]
    return df.withColumn("variance_amount", (amounts[0] - amounts[1]).cast("decimal(18,2)"))


def turnaround(df: DataFrame, by: Sequence[str], start: str, end: str, sla_days: int, as_of: date) -> DataFrame:
    """Per group: finished, mean days, late ones, open ones and open ones past the limit."""
    took, waiting = days_between(start, end), F.datediff(F.lit(as_of), F.col(start))
    is_open = F.col(end).isNull()
    return df.groupBy(*by).agg(
        F.count(took).alias("finished"),
        (F.sum(took).cast("double") / F.count(took)).alias("avg_days"),
        F.count_if(took > sla_days).alias("sla_breaches"),
        F.count_if(is_open).alias("backlog"),
        F.count_if(is_open & (waiting > sla_days)).alias("backlog_overdue"),
    )


def aging(df: DataFrame, since: str, as_of: date, edges: Sequence[int] = (30, 60, 90)) -> DataFrame:
    """Open items by age in days: (age_bucket, items)."""
    age = F.datediff(F.lit(as_of), F.col(since))
    low, label = 0, F.lit(None).cast("string")
    for edge in edges:
        label = F.coalesce(label, F.when(age < edge, f"{low}-{edge - 1}"))
        low = edge
    label = F.coalesce(label, F.when(age >= low, f"{low}+"))
    return df.groupBy(label.alias("age_bucket")).agg(F.count(F.lit(1)).alias("items"))
