"""Checks as rows (check, subject, rows_checked, violations)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.functions.text import has_text

# Patterns of well-formed contact data.
EMAIL = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
PHONE = r"^\(?[0-9]{3}\)?[-. ]?[0-9]{3}[-. ]?[0-9]{4}$"
SSN = r"^[0-9]{3}-?[0-9]{2}-?[0-9]{4}$"


@dataclass(frozen=True)
class Rule:
    """A check of single rows: the rows it applies to, and which of them break it."""

    name: str
    subject: str
    broken: Column
    applies: Column


def check(df: DataFrame, *rules: Rule) -> DataFrame:
    """One row per rule: rows it applies to and rows that break it.  All rules take one scan."""
    counts = []
    for i, rule in enumerate(rules):
        counts += [
            F.count_if(rule.applies).alias(f"checked_{i}"),
            F.count_if(rule.applies & F.coalesce(rule.broken, F.lit(False))).alias(f"broken_{i}"),
        ]
    lines = [
        F.struct(
            F.lit(rule.name).alias("check"), F.lit(rule.subject).alias("subject"),
            F.col(f"checked_{i}").alias("rows_checked"), F.col(f"broken_{i}").alias("violations"),
        )
        for i, rule in enumerate(rules)
    ]
    return df.agg(*counts).select(F.inline(F.array(*lines)))


def domain(column: str, allowed: Sequence[object]) -> Rule:
    """Values outside the allowed list; NULL is not a value."""
    c = F.col(column)
    return Rule("domain", column, ~c.isin(list(allowed)), c.isNotNull())


def pattern(column: str, regex: str) -> Rule:
    c = F.col(column)
    return Rule("pattern", column, ~c.rlike(regex), has_text(c))


def in_range(column: str, low: float, high: float) -> Rule:
    c = F.col(column)
    return Rule("range", column, ~c.between(low, high), c.isNotNull())


def required(*columns: str) -> Rule:
    """Rows in which any of the columns is missing or blank."""
    gap = F.lit(False)
    for name in columns:
        gap = gap | ~has_text(F.col(name))
    return Rule("required", ",".join(columns), gap, F.lit(True))


def unique(df: DataFrame, *keys: str, where: Column | None = None) -> DataFrame:
    """Keys held by more than one row; ``where`` gives a partial key.

    ``violations`` counts surplus rows.  Grouping combines map-side, so a key
    repeated often costs one partial row per task.
    """
    rows = df if where is None else df.filter(where)
    per_key = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.lit("unique").alias("check"),
        F.lit(",".join(keys)).alias("subject"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_checked"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations"),
    )


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """The keys that repeat, with their row counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def referential(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose key is not in the parent.

    Child rows are counted per key first; only distinct keys are joined.
    """
    per_key = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_fk")).agg(
        F.count(F.lit(1)).alias("n")
    )
    known = parent.select(F.col(parent_key).alias("_pk")).distinct()
    matched = per_key.join(known, F.col("_fk") == F.col("_pk"), "left")
    return matched.agg(
        F.lit("referential").alias("check"),
        F.lit(column).alias("subject"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_checked"),
        F.coalesce(F.sum(F.when(F.col("_pk").isNull(), F.col("n"))), F.lit(0)).alias("violations"),
    )


def staleness(df: DataFrame, column: str, as_of: date, max_days: int = 1) -> DataFrame:
    """Newest extraction day, its age at ``as_of``, and whether that is too old."""
    newest = F.max(F.col(column).try_cast("date"))
    aged = df.agg(newest.alias("newest"))
    age = F.datediff(F.lit(as_of), "newest")
    return aged.select("newest", age.alias("age_days"), F.coalesce(age > max_days, F.lit(True)).alias("is_stale"))


def split_bad_records(df: DataFrame, *tests: tuple[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good, dead letters); each dead letter carries the names of the tests it failed.

    A test is true for a bad row.  Both results are filters over the same input.
    """
    failed = F.filter(
        F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in tests]),
        lambda reason: reason.isNotNull(),
    )
    judged = df.withColumn("_reasons", failed)
    good = judged.filter(F.size("_reasons") == 0).drop("_reasons")
    return good, judged.filter(F.size("_reasons") > 0).withColumnRenamed("_reasons", "reasons")
