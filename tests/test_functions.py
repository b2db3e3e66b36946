"""Column functions on hand-made values."""

from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from hearthline.functions import dates, domains, names, numbers, text

D = datetime.date


def apply(spark, fn, values, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


CASES = {
    "flex_date": (dates.flex_date, {
        "2024-11-18 00:00:00": D(2024, 11, 18), "2024-11-18T10:20:30.5": D(2024, 11, 18), "11/18/2024": D(2024, 11, 18),
        "1/2/24": D(2024, 1, 2), " 1/2/2024 ": D(2024, 1, 2), "07/01/2026/2026": None, "Pending": None, "-": None, "": None,
        "02/30/2024": None, "45614": None, "1/2/24 n/a": None, "2024-1-8": None, None: None,
    }),
    "money_text": (numbers.money_text, {"$1,234.50": 1234.5, " 2 000 ": 2000.0, "(5.00)": None, "": None, "n/a": None, None: None}),
    "zip5": (text.zip5, {"84043-1234": "84043", "2134": None, "84043.0": "84043", None: None}),
    "norm_lender": (text.norm_lender, {
        "Acme Bank, N.A. ISAOA/ATIMA": "ACME BANK NA", "acme bank its successors and/or assigns": "ACME BANK", "Acme-Bank": "ACMEBANK", " ": None,
    }),
    "norm_token": (text.norm_token, {"ab-12Cd": "AB12CD", "--": None, None: None}),
    "norm_token_legacy": (lambda c: text.norm_token(c, legacy_case=True), {"ab-12Cd": "12C", "abc": None}),
    "norm_address": (text.norm_address, {" 1  Main St. ": "1 MAIN ST", "": None}),
    "year": (numbers.year_in_text, {"1978": 1978, "1979.0": 1979, "c. 1965": 1965, "unk": None, "": None, None: None, "99999999999": 9999}),
    "safe_int": (numbers.safe_int, {"360.0": 360, "{value=180}": 180, "x": None, "": None}),
    "safe_decimal": (numbers.safe_decimal, {"{value=5500.00}": Decimal("5500.00"), " ": None, "n/a": None, "1.239": Decimal("1.24")}),
    "clean_string": (text.clean_string, {"{value= a }": "a", " ": None, "b": "b"}),
    "safe_bool": (domains.safe_bool, {"Yes": True, "t": True, "0": False, "n": False, "maybe": None, None: None}),
    "settled": (domains.settled_status, {"SETTLED": "Settled", " unsettled": "Unsettled", "open": None}),
    "delinquency": (domains.delinquency_bucket, {"30 - 59": "30-59", "90 +": "90+", "90plus": "90+", "120": None}),
    "mask": (text.mask_ssn, {"123-45-6789": "***-**-6789", None: None}),
    "condition": (domains.property_condition, {"c3": "C3", "": "MNF - BLANK", "poor": "MNF - poor", None: "MNF - BLANK"}),
    "flood": (domains.flood_code, {"NOT REQUIRED": "NOT_REQ", "Yes - required": "REQ", "": "UNK", "y": "REQ", "false": "NOT_REQ", None: "UNK"}),
    "title": (domains.status_title, {"ACTIVE": "Active", "canceled": "Cancelled", "PAID IN FULL": "Paid In Full", "BLANK": "Blank", "ODD": "Unmapped"}),
    "listed": (text.first_listed, {'["abc","d"]': "abc", "[]": None, "[x]": "x"}),
}


@pytest.mark.parametrize("name", CASES)
def test_values(spark, name):
    fn, cases = CASES[name]
    assert apply(spark, fn, list(cases)) == list(cases.values())


@pytest.mark.parametrize("fn", [text.norm_token, text.norm_lender, text.norm_address, text.zip5, text.clean_string, domains.settled_status, domains.delinquency_bucket])
def test_idempotent(spark, fn):
    values = ["ab-12Cd", "Acme Bank, N.A. ISAOA", " 1  Main St. ", "84043-12", "settled", "90 +", "", None, "{value= 3 }"]
    once = apply(spark, fn, values)
    assert apply(spark, fn, once) == once


def test_serial_dates(spark):
    got = apply(spark, dates.serial_to_date, [46174.0, 45614.75, 1.0, 59.0, 60.0, 61.0, 0.0, 295847.0], "double")
    assert got[:2] == ["06/01/2026", "11/18/2024"]
    assert got[2:6] == ["01/01/1900", "02/28/1900", "02/28/1900", "03/01/1900"]
    assert got[6:] == [None, None]


def test_flood_evidence_names_the_rule(spark):
    rows = [("", "NFIP", None), ("", "HO3", "AE"), ("", "", "x"), ("", "", "D"), ("no", "NFIP", "AE")]
    df = spark.createDataFrame(rows, "raw string, policy string, zone string")
    e = domains.flood_evidence(F.col("raw"), F.col("policy"), F.col("zone"))
    assert [tuple(r[0]) for r in df.select(e).collect()] == [
        ("REQ", "policy-type-inferred"), ("REQ", "zone-inferred"), ("NOT_REQ", "zone-inferred"), ("UNK", "unresolved"), ("NOT_REQ", "raw"),
    ]


def test_status_by_source(spark):
    rows = [("Internal Procured", "", None), ("External", "Active", " "), ("External", "Active", "pending items"), ("External", None, None), ("Internal Procured", "Odd", "Approved")]
    df = spark.createDataFrame(rows, "s string, st string, ap string")
    got = [r[0] for r in df.select(domains.status_normalized(F.col("s"), F.col("st"), F.col("ap"))).collect()]
    assert got == ["BLANK", "ACTIVE", "PENDING", "BLANK", "ODD"]


def test_bands(spark):
    assert apply(spark, domains.fico_band, [599, 600, 639, 640, 700, None], "int") == [None, "600-639", "600-639", "640-679", "700+", None]
    assert apply(spark, domains.dti_band, [0.0, 39.9, 40.0, 50.0, None], "double") == ["0-39", "0-39", "40-44", "50+", None]


def test_buyer_rules(spark):
    rows = [("owned usf", None, None), ("MWF", "U1", None), ("MWF", "  ", None), (None, None, "2020-01-01"), (None, "", None)]
    df = spark.createDataFrame(rows, "o string, n string, d string")
    two = [r[0] for r in df.select(domains.buyer_from_marks(F.col("o"), F.col("n"))).collect()]
    three = [r[0] for r in df.select(domains.buyer_three_way(F.col("o"), F.col("n"), F.col("d"))).collect()]
    assert two == ["USF", "USF", "MWF", "MWF", "MWF"]
    assert three == ["USF", "USF", "USF", "MWF", "Unknown"]


def test_names():
    snake = {"Lender Loan #": "lender_loan", "FEMA Flood Zone": "fema_flood_zone", "2nd Policy": "col_2nd_policy", "": "col",
             "VendorONeal": "vendor_o_neal", "Ext_SomeCompanyLLC": "ext_some_company_llc", "firstMortgageUpb": "first_mortgage_upb"}
    assert {k: names.snake_case(k) for k in snake} == snake
    assert names.unique_names(["a", "a", "a_1"]) == ["a", "a_2", "a_1"]
    assert len({n.lower() for n in names.unique_names(["A", "a", "a_1", "A_1", "b"])}) == 5
    assert names.header_names(["x", "", None, "x"]) == ["x", "col_1", "col_2", "x_1"]


def test_exact_mean_ignores_order(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.3,), (None,)], "v double")
    assert df.select(numbers.exact_avg(F.col("v"))).first()[0] == 0.6 / 3
    assert df.select(numbers.decimal_avg(F.col("v").cast("decimal(18,2)"))).first()[0] == Decimal("0.20")


def test_exact_avg_with_integer_column(spark):
    assert spark.createDataFrame([(600,), (601,)], "v int").select(numbers.exact_avg(F.col("v"))).first()[0] == 600.5


def test_no_digits_are_cut(spark):
    df = spark.sql("select * from values (1.0D, 1.4D, 2.4D), (0.8D, 0.4D, 0.0D), (0.0D, 1.0D, 1.0D), (1e300D, 2.0D, 1.0D) as t(w, p, q)")
    got = [tuple(r) for r in df.select(numbers.percent_of(F.col("p"), F.col("w")), numbers.percent_of(F.col("q"), F.col("p"))).collect()]
    assert got == [(Decimal("140.00"), Decimal("171.43")), (Decimal("50.00"), Decimal("0.00")), (None, Decimal("100.00")), (None, Decimal("50.00"))]
    small = spark.sql("select * from values (10.005D), (0.004D), (1e300D) as t(v)")
    assert small.select(numbers.exact_avg(F.col("v"))).first()[0] == 5.0045
    text = spark.sql("select * from values ('$1,234.505'), ('1e300'), ('9e21') as t(v)")
    assert [r[0] for r in text.select(numbers.money_text(F.col("v"))).collect()] == [1234.505, None, 9e21]
