"""The procurement fact: patterns matched once, and respelled texts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from hearthline.functions import dates, numbers, text
from hearthline.operators import rollup
from hearthline.plans import procurement


def read(spark, given, *columns):
    frame = spark.createDataFrame(list(enumerate(given)), "i int, t string")
    return list(zip(*[tuple(r)[1:] for r in frame.select("i", *columns).orderBy("i").collect()], strict=True))


def test_each_pattern_is_matched_once(spark):
    """However often its text is used."""
    sheet = spark.range(3).select(*[F.col("id").cast("string").alias(names.split()[0]) for names in procurement.SHEET_COLUMNS.values()])
    fact = procurement.fact_procurement(procurement.conform_union(sheet, None))
    held = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", 500)
    plan = fact._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.set("spark.sql.debug.maxToStringFields", held)
    # Dates 7 and numbers 2; tokens 3, lender, address and digits; the year.
    assert [plan.count(f"{name}(") for name in ("RLIKE", "regexp_replace", "regexp_extract")] == [9, 6, 1]


def test_days(spark):
    given = ["1/2/24", "01/02/2024T1:02", "1/2/24 10:11:12.5", "1/2/24\t1:02", " 2024-01-02 ", "2024-01-02\n", "1/2/2024\n"]
    unread = ["2/30/24", "1/2/024", "12/31/9", "2024-1-2", "1/2/2024/5", "2024-01-02 ago", "", None]
    assert read(spark, given + unread, dates.flex_date(F.col("t"))) == [(date(2024, 1, 2),) * len(given) + (None,) * len(unread)]


def test_numbers(spark):
    given = ["$ 1,2\t3.5", "1e30", "+.5", "n/a", "", None, "1978.0", "c. 19655", "1234567890", "-12.", "x123"]
    money, year = read(spark, given, numbers.money_text(F.col("t")), numbers.year_in_text(F.col("t")))
    assert money == (123.5, None, 0.5, None, None, None, 1978.0, None, 1234567890.0, -12.0, None)
    assert year == (None, None, None, None, None, None, 1978, 1965, 1234, -12, None)


def test_texts_within_and_beyond_ascii(spark):
    t = F.col("t")
    given = [" a-1  b\t2 ", "é a - 1 ßx", "<>  > <", "１2 34５ 567", "", None, "1  2   3    4"]
    tokens, words, codes, empty = read(spark, given, text.norm_token(t), text.norm_address(t), text.zip5(t), text.token(t) == "")
    assert tokens == ("A1B2", "A1SSX", None, "234567", None, None, "1234")
    assert words == ("A1 B2", "A 1 SSX", None, "2 34 567", None, None, "1 2 3 4")
    assert codes == (None, None, None, "23456", None, None, None)
    assert empty == (False, False, True, False, True, True, False)


def test_texts_are_raised_and_trimmed_once(spark):
    """Before patterns are matched, however often a pattern's step uses them."""
    sheet = spark.range(3).select(*[F.col("id").cast("string").alias(names.split()[0]) for names in procurement.SHEET_COLUMNS.values()])
    fact = procurement.fact_procurement(procurement.conform_union(sheet, None)).select("loan_number_norm", "lender_name_norm", "address_norm", "request_date")
    held = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", 500)
    plan = fact._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.set("spark.sql.debug.maxToStringFields", held)
    assert plan.count("ISAOA") == 1 and plan.count("RLIKE(") == 1
    # Nothing between the pattern's name and the text's: it was trimmed in the step before.
    assert "RLIKE(_request_date_text" in plan and "translate(_loan_text" in plan


def test_months_take_one_shuffle_per_loan_and_month(spark):
    rows = [
        ("a", date(2024, 1, 1), date(2024, 2, 1), 1, 5.0), ("a", date(2024, 1, 1), date(2024, 2, 1), 0, 9.0), ("a", date(2024, 1, 1), None, 1, None),
        (None, date(2024, 1, 1), date(2024, 1, 1), 1, 7.0), ("b", None, date(2024, 2, 1), 1, 2.0), ("b", None, None, None, 3.0), ("c", date(2024, 2, 1), date(2024, 2, 1), None, None),
    ]
    df = spark.createDataFrame(rows, "k string, w date, c date, f int, v double")
    out = rollup.month_roles(df, "k", "w", "c", "f", "v")
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("HashAggregate") == 2
    found = {(r.month_start.month, r.k): tuple(r)[2:] for r in out.collect()}
    assert found == {
        (1, "a"): (1, 0, 3, 9.0, None), (2, "a"): (0, 1, 0, None, 5.0), (1, None): (0, 0, 1, 7.0, 7.0),
        (2, "b"): (0, 1, 0, None, 2.0), (2, "c"): (1, 0, 1, None, None),
    }
    assert rollup.month_roles(df, "k", "w", "c", "f").columns == ["month_start", "k", "worked", "closed", "submissions"]
