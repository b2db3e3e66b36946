"""Star schema, procurement, reports, quality, publishing, history."""

from __future__ import annotations

import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from hearthline.operators import calendar, history, privacy, quality, trends
from hearthline.plans import procurement, reports, scorecard, star, tracking
from hearthline.sinks import publish
from hearthline.streaming.upsert import compact, read_latest, stream_latest

D = datetime.date


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# ------------------------------------------------------------------------ star


def test_star_from_two_batches(spark):
    loans = spark.createDataFrame(
        [
            ("1", "old", None, "{value=5.00}", "c1", "i1", None, '[{"firstName":"A","ssn":"123-45-6789","fico":"700.0"},{"firstName":"B"}]', "2024-01-01 00:00:00"),
            ("1", "DPA", "2024-03-04", "{value=7.50}", "c1", "i1", None, '[{"firstName":"A","ssn":"123-45-6789","fico":"700.0"},{"firstName":"B"}]', "2024-01-02 00:00:00"),
            ("2", "EEP", "2024-03-05", "", "c2", "i9", "Own", "not json", "2024-01-02 00:00:00"),
        ],
        "_id string, productType string, closingDate string, dpaAmount string, correspondentId string, secondMortgageInvestorId string, investorName string, borrowers string, _etl_extracted_at string",
    )
    investors = spark.createDataFrame([("i1", "Inv One")], "_id string, name string")
    tables = star.build_star(spark, {"loans": loans, "investors": investors, "holidays": None}, "2024-02-02 00:00:00")
    assert "dimensions/dim_holiday" not in tables and len(tables) == 10
    loan = tables["dimensions/dim_loan"].orderBy("loan_id").select("loan_id", "product_type", "second_mortgage_investor_name", "_etl_loaded_at")
    assert rows(loan) == [("1", "DPA", "Inv One", "2024-02-02 00:00:00"), ("2", "EEP", "Own", "2024-02-02 00:00:00")]
    borrowers = tables["dimensions/dim_borrower"]
    assert "ssn" not in borrowers.columns
    assert rows(borrowers.select("loan_id", "borrower_position", "first_name", "ssn_masked", "credit_score", "is_primary"), "borrower_position") == [
        ("1", 0, "A", "***-**-6789", 700, True), ("1", 1, "B", None, None, False),
    ]
    again = star.build_star(spark, {"loans": loans}, "x")["dimensions/dim_borrower"]
    assert rows(again.select("borrower_id"), "borrower_id") == rows(borrowers.select("borrower_id"), "borrower_id")
    assert [r[0] for r in rows(tables["facts/fact_loan_metrics"].select("dpa_amount"), "loan_id")] == [Decimal("7.50"), None]
    assert tables["facts/fact_loan_status"].filter("closing_date_key = 20240304").count() == 1
    assert rows(tables["dimensions/dim_correspondent"].select("correspondent_id"), "correspondent_id") == [("c1",), ("c2",)]
    assert tables["dimensions/dim_date"].count() == 4018 and tables["dimensions/dim_product"].count() == 6
    assert tables["dimensions/dim_eep_processing_entry"].count() == 0 and tables["dimensions/dim_user"].count() == 0


@pytest.mark.parametrize("value, want", [("null", 0), ("''", 0), ("'[]'", 0), ("'not json'", 0), ("array(named_struct('firstName', 'Z'))", 1), ("5", 0)])
def test_borrowers_in_every_shape(spark, value, want):
    raw = spark.sql(f"select '1' as _id, {value if value != 'null' else 'cast(null as string)'} as borrowers")
    assert star.dim_borrower(raw).count() == want


def test_nested_partner_and_struct_entries(spark):
    raw = spark.sql(
        "select '1' as _id, named_struct('_id', 'c1', 'name', 'N', 'zip', '1') as correspondent,"
        " array(named_struct('_key', 'k', 'user', named_struct('_id', 'u1'), 'at', '2024-01-02T03:04:05')) as eepProcessingEntries"
    )
    assert rows(star.correspondents_in_loans(raw).select("correspondent_id", "correspondent_name", "zip_code")) == [("c1", "N", "1")]
    assert rows(star.dim_eep_processing_entry(raw).select("entry_key", "user_id", "processed_at")) == [("k", "u1", datetime.datetime(2024, 1, 2, 3, 4, 5))]


def test_conditions_without_time_columns(spark):
    raw = spark.sql("select 'a' as _id, array('x', null, 'y') as documentTypes")
    assert rows(star.dim_loancondition(raw).select("status")) == [("Created",)]
    assert rows(star.dim_loancondition_documenttype(raw).select("document_type_position", "document_type"), "document_type") == [(0, "x"), (2, "y")]
    assert star.dim_loancondition_documenttype(spark.sql("select 'a' as _id")) is None


# ----------------------------------------------------------------- procurement


def procure(spark, external, internal=None, **more):
    ext = spark.createDataFrame([list(e.values()) for e in external], ", ".join(f"{k} string" for k in external[0]))
    inside = spark.createDataFrame([list(e.values()) for e in internal], ", ".join(f"{k} string" for k in internal[0])) if internal else None
    return procurement.fact_procurement(procurement.conform_union(ext, inside), **more)


def test_keys(spark):
    base = {"borrower_first_name": "Jo", "borrower_last_name": "Doe", "lender_loan": "1-2 3", "lender": "Acme Bank", "borrower_address": "1 Main St.", "borrower_zip": "84043-1"}
    facts = procure(spark, [base, {**base, "lender_loan": None}, {**base, "borrower_first_name": " ", "borrower_last_name": None}, {**base, "lender_loan": "", "borrower_address": ""}])
    assert rows(facts.select("loan_key", "loan_key_v2", "loan_key_v3"), "loan_key_v3") == [
        ("JO DOE", "LN:123", "LN:123|ACME BANK|1 MAIN ST|84043"),
        ("JO DOE", "NAME:JO DOE", "NAME:JO DOE|1 MAIN ST|84043"),
        ("JO DOE", "NAME:JO DOE", "NAME:JO DOE||84043"),
    ]


def test_master_rows(spark):
    ext = {"home_buyers_name": "B", "lender_loan": "9", "lender": "L", "borrower_address": "1 A", "borrower_zip": "11111", "date_requested_by_lender": "1/5/2024", "closed_bind": "1/9/2024", "county": "Late", "certificate_policy": "P"}
    internal = {"home_buyers_name": "B", "lender_loan_number": "9", "lender_name": "L", "address": "1 A", "zip": "11111", "request_date": "1/2/2024", "close_bind_date": None, "county": None, "ah_loan_number": "h1"}
    moved = {**ext, "borrower_address": "2 B", "certificate_policy": None}
    masters = procurement.loan_master(procure(spark, [ext, moved], [internal]))
    got = {r["address_norm"]: r for r in masters.collect()}
    one, two = got["1 A"], got["2 B"]
    assert (one["procurement_row_count"], one["has_multiple_source_types"], one["is_closed_any"], one["county"]) == (2, True, 1, "Late")
    assert (one["first_request_date"], one["latest_request_date"], one["distinct_ah_loan_number_count"]) == (D(2024, 1, 2), D(2024, 1, 5), 1)
    assert one["has_address_conflict"] and two["has_address_conflict"] and not one["has_lender_conflict"]
    assert (one["key_quality_flag"], two["key_quality_flag"], two["has_multiple_source_types"]) == ("Full", "Partial", False)


def test_alias_table(spark):
    alias = spark.createDataFrame([("ACME", "Acme Inc", "Group")], "lender_name_norm string, lender_canonical string, lender_group string")
    facts = procure(spark, [{"home_buyers_name": "a", "lender": "acme"}, {"home_buyers_name": "b", "lender": "other"}], aliases=alias)
    assert rows(facts.select("lender_canonical", "lender_group", "lender_alias_is_mapped"), "loan_key") == [("Acme Inc", "Group", True), ("OTHER", "OTHER", False)]


TREND = [  # id, request, close, closed, loan, premium
    (1, D(2024, 1, 1), D(2024, 2, 1), 1, "A", 10.0), (2, D(2024, 2, 1), D(2024, 2, 1), 1, "A", 20.0), (3, D(2024, 2, 1), None, 0, "B", 30.0),
    (4, None, D(2024, 2, 1), 1, "C", 5.0), (5, D(2024, 3, 1), D(2024, 3, 1), 1, "D", 7.0),
]


def trend_view(spark, data):
    return spark.createDataFrame(data, "id int, request_month_start date, close_month_start date, is_closed_loan_row int, loan_key_v3 string, premium double")


def test_month_trend_fixture(spark):
    view = trend_view(spark, TREND)
    months = calendar.month_spine(spark.sql("select explode(sequence(date'2024-01-01', date'2024-04-01', interval 1 month)) as m"), "m")
    assert rows(tracking.month_trend(view, months).drop("month_label"), "year_month_sort") == [(202401, 1, 0, 1), (202402, 2, 2, 2), (202403, 1, 1, 1), (202404, 0, 0, 0)]
    assert rows(tracking.avg_premium_by_month(view, months).drop("month_label"), "year_month_sort") == [
        (202401, 10.0, None), (202402, 25.0, 12.5), (202403, 7.0, 7.0), (202404, None, None)]
    assert rows(tracking.avg_premium_observed(view).select("year_month_sort", "avg_premium_closed"), "year_month_sort") == [(202401, None), (202402, 12.5), (202403, 7.0)]


def test_month_trend_equals_the_or_join(spark):
    """Random rows with NULL months and NULL loans against the definition itself."""
    rng = random.Random(5)
    months = [None, *[D(2024, m, 1) for m in range(1, 7)]]
    data = [(i, rng.choice(months), rng.choice(months), rng.randint(0, 1), rng.choice([None, "A", "B", "C", "D"]), rng.choice([None, 1.25, 2.5])) for i in range(400)]
    view = trend_view(spark, data)
    axis = calendar.month_spine(view, "request_month_start", "close_month_start")
    got = rows(tracking.month_trend(view, axis).drop("month_label"), "year_month_sort")
    want = []
    for m in months[1:]:
        worked = [r for r in data if r[1] == m]
        closed = [r for r in data if r[2] == m and r[3]]
        want.append((m.year * 100 + m.month, len({r[4] for r in worked} - {None}), len({r[4] for r in closed} - {None}), len(worked)))
    assert got == want
    averages = rows(tracking.avg_premium_by_month(view, axis).drop("month_label"), "year_month_sort")
    for (_, avg_worked, avg_closed), m in zip(averages, months[1:], strict=True):
        for got_mean, picked in ((avg_worked, [r for r in data if r[1] == m]), (avg_closed, [r for r in data if r[2] == m and r[3]])):
            tops = {}
            for r in picked:
                if r[4] is not None and r[5] is not None:
                    tops[r[4]] = max(tops.get(r[4], 0), r[5])
            assert got_mean == pytest.approx(sum(tops.values()) / len(tops))


def test_kpi_on_no_rows(spark):
    view = spark.createDataFrame([], "loan_key_v3 string, is_closed_submission int, is_closed_loan_row int, flood_required_inferred_code string, age_bucket string")
    got = tracking.kpi_scorecard(view).first()
    assert (got["worked_submissions"], got["worked_loans"], got["loans_close_rate_pct"]) == (0, 0, None)


def test_month_default(spark):
    assert rows(tracking.current_month_default(spark, D(2024, 11, 5))) == [("Nov 2024", 202411, D(2024, 11, 5))]


# --------------------------------------------------------------------- reports


def test_share_of_the_month(spark):
    base = spark.range(78).select(
        F.col("id").cast("string").alias("loan_id"), F.lit("dpa").alias("product_type"), F.lit("2026-01-15").cast("date").alias("closing_date"),
        F.when(F.col("id") < 45, "USF").alias("first_mortgage_ownership_status"), F.lit(None).cast("string").alias("usf_loan_number"),
        F.lit("2020-01-01").alias("contract_date"), F.lit("c").alias("correspondent_id"), F.lit(1).cast("decimal(18,2)").alias("dpa_amount"),
    )
    got = rows(reports.buyer_share(base).select("buyer", "closing_count", "total_closings_month", "buyer_percentage"), "buyer")
    assert [(b, n, t, float(p)) for b, n, t, p in got] == [("MWF", 33, 78, 42.31), ("USF", 45, 78, 57.69)]
    by_buyer = reports.monthly_closings_by_buyer(base, "two_way", year=2026, month=1)
    assert reports.monthly_closings_by_buyer(base, "two_way", year=2026, month=2).count() == 0
    assert [r["buyer"] for r in reports.newest_first(by_buyer, "buyer").collect()] == ["MWF", "USF"]
    with pytest.raises(ValueError, match="buyer rule"):
        reports.buyer("other")


def test_filters_reach_the_scan(spark, tmp_path):
    base = spark.range(10).select(F.col("id").cast("string").alias("loan_id"), F.lit("2024-01-15").cast("date").alias("closing_date"), F.lit("EEP").alias("product_type"))
    base.write.parquet(str(tmp_path / "loans"))
    read = spark.read.parquet(str(tmp_path / "loans"))
    plan = read.filter(reports.in_year("closing_date", 2024))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(closing_date" in plan and "LessThan(closing_date" in plan


# ------------------------------------------------------- quality and publishing


def test_quality(spark):
    df = spark.createDataFrame([("a", 700, "x@y.z"), ("b", 900, "bad"), ("a", None, None)], "k string, fico int, email string")
    found = {(r["check"], r["violations"]) for c in (
        quality.check(df, quality.domain("k", ["a"]), quality.in_range("fico", 1, 850), quality.pattern("email", quality.EMAIL)),
        quality.unique(df, "k"), quality.check(df, quality.required("email")), quality.referential(df, "k", df.filter("k = 'b'"), "k"),
    ) for r in c.collect()}
    assert found == {("domain", 1), ("range", 1), ("pattern", 1), ("unique", 1), ("required", 1), ("referential", 2)}
    good, bad = quality.split_bad_records(df, ("range", F.col("fico") > 850), ("none", F.col("fico").isNull()))
    assert good.count() == 1 and rows(bad.select(F.array_join("reasons", ",")), "k") == [("none",), ("range",)]
    stale = spark.sql("select '2024-01-02' as d")
    assert rows(quality.staleness(stale, "d", D(2024, 1, 3))) == [(D(2024, 1, 2), 1, False)]
    assert rows(quality.staleness(stale.limit(0), "d", D(2024, 1, 3)).select("is_stale")) == [(True,)]


def test_publish_modes(spark, tmp_path):
    df = spark.range(5)
    publish.publish(df, str(tmp_path / "s"), "snapshot", "2024-01-01")
    publish.publish(df.limit(2), str(tmp_path / "s"), "snapshot", "2024-01-02")
    assert spark.read.parquet(str(tmp_path / "s")).count() == 2
    for day, n in (("2024-01-01", 5), ("2024-01-02", 4), ("2024-01-02", 3)):
        publish.publish(df.limit(n), str(tmp_path / "d"), "daily_partition", day)
    assert spark.read.parquet(str(tmp_path / "d")).count() == 8
    with pytest.raises(ValueError, match="mode must be"):
        publish.publish(df, str(tmp_path / "x"), "other", "2024-01-01")


def test_verified_writes_and_log(spark, tmp_path):
    path = str(tmp_path / "raw")
    first = publish.write_verified(spark.range(7), path)
    more = publish.write_verified(spark.range(3), path, "incremental")
    assert (first["records"], first["written"], more["written"], more["missing"]) == (7, 7, 3, 0)
    assert spark.read.parquet(path).count() == 10
    assert publish.skip_if_empty(spark.range(0), lambda d: {})["status"] == "skipped"
    with pytest.raises(ValueError, match="no rows"):
        publish.skip_if_empty(spark.range(0), lambda d: {}, fail=True)
    log = publish.run_log(spark, [{"source": "a", **first}, {"source": "b", "status": "error", "message": "x"}], "2024-01-01 00:00:00")
    assert rows(publish.run_totals(log), "status") == [("error", 1, 0), ("success", 1, 7)]


def test_catalog_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    publish.publish(spark.range(4), path, "daily_partition", "2024-01-01")
    publish.register_table(spark, "reg_db", "t", path, partitioned=True)
    assert spark.table("reg_db.t").count() == 4
    publish.publish(spark.range(2), path, "daily_partition", "2024-01-02")
    publish.add_new_partitions(spark, "reg_db.t")
    assert spark.table("reg_db.t").filter("dt = '2024-01-02'").count() == 2
    assert publish.define_view(spark.range(3), "v3").count() == 3
    report = publish.refresh_snapshot_tables(spark, {"snap_a": lambda: spark.range(2), "snap_b": lambda: 1 / 0}, "2024-01-01 00:00:00")
    assert [r["status"] for r in report] == ["success", "error"] and "_refreshed_at" in spark.table("snap_a").columns
    publish.write_with_layout(spark.range(20).withColumn("v", F.col("id") % 3), "laid_out", "id", ["id"], 4)
    joined = spark.table("laid_out").join(spark.table("laid_out").withColumnRenamed("v", "w").hint("merge"), "id")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()


def test_report_folders_and_sizes(spark, tmp_path):
    df = spark.createDataFrame([(2024, 1, "USF"), (2024, 2, "MWF")], "year int, month int, buyer string").withColumn("n", F.lit(1))
    publish.write_partitioned_report(df, str(tmp_path / "r"), ["year", "month", "buyer"])
    assert (tmp_path / "r" / "year=2024" / "month=1" / "buyer=USF").is_dir()
    publish.write_compact(df, str(tmp_path / "one"))
    assert len(list((tmp_path / "one").glob("part-*"))) == 1
    assert [publish.target_partitions(n) for n in (0, 25_000, 10**9)] == [1, 2, 100_000]
    stamped = publish.lineage_columns(df, publish.extraction_stamps("2024-01-02 03:04:05", "docs", "loans"))
    assert stamped.first()["_etl_extraction_date"] == "2024-01-02"
    publish.write_staging(df, str(tmp_path / "st"))
    assert spark.read.parquet(str(tmp_path / "st")).count() == 2


def test_stream_upsert(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    schema = spark.createDataFrame([], "_id string, ts string, v int").schema
    spark.createDataFrame([("a", "1", 1), ("b", "1", 1)], schema).write.mode("append").parquet(src)
    for extra in (None, [("a", "2", 2), ("c", "1", 3)], [("a", "0", 9)]):
        if extra:
            spark.createDataFrame(extra, schema).write.mode("append").parquet(src)
        stream_latest(spark, src, schema, out, ck, "_id", "ts").awaitTermination()
    want = [("a", "2", 2), ("b", "1", 1), ("c", "1", 3)]
    assert rows(read_latest(spark, out, "_id", "ts"), "_id") == want and spark.read.parquet(out).count() == 5
    compact(spark, out, "_id", "ts")
    assert rows(read_latest(spark, out, "_id", "ts"), "_id") == want and spark.read.parquet(out).count() == 3


# --------------------------------------------------------------------- history


def test_scd2_equals_brute_force(spark):
    rng = random.Random(3)
    start = datetime.datetime(2024, 1, 1)
    data = [(rng.choice(["x", "x", "x", "x", "y", "z", None]), start + datetime.timedelta(hours=rng.randint(0, 400)), i, rng.choice(["A", "B", None])) for i in range(300)]
    df = spark.createDataFrame(data, "k string, ts timestamp, id int, s string")
    got = history.scd2(df, ["k"], "ts", ["s"], ["id"])
    want = []
    for key in ("x", "y", "z", None):
        changes = []
        for _, ts, _, state in sorted((r for r in data if r[0] == key), key=lambda r: (r[1], r[2])):
            if not changes or changes[-1][0] != state:
                changes.append((state, ts))
        ends = [c[1] for c in changes[1:]] + [None]
        want += [(key, st, ts, end, end is None) for (st, ts), end in zip(changes, ends, strict=True)]
    assert sorted(rows(got), key=str) == sorted(want, key=str)


def test_growth_skips_gaps(spark):
    df = spark.createDataFrame([("p", D(2023, 1, 1), 10), ("p", D(2024, 1, 1), 15), ("p", D(2024, 3, 1), 5)], "g string, m date, n long")
    got = rows(trends.growth(df, "m", "n", ["g"]).select("previous_month", "previous_year", "yoy_pct"), "m")
    assert [(a, b, c and float(c)) for a, b, c in got] == [(None, None, None), (None, 10, 50.0), (None, None, None)]


def test_scorecard_helpers(spark):
    df = spark.sql("select 'a' as g, date'2024-01-01' as s, date'2024-01-11' as e union all select 'a', date'2024-01-01', null")
    assert rows(scorecard.turnaround(df, ["g"], "s", "e", 7, D(2024, 1, 20))) == [("a", 1, 10.0, 1, 1, 1)]
    assert rows(scorecard.aging(df, "s", D(2024, 2, 10))) == [("30-59", 2)]
    assert scorecard.variance(spark.sql("select 5.50 as i, 2.25 as p"), "i", "p").first()["variance_amount"] == Decimal("3.25")


def test_privacy(spark):
    df = spark.sql("select 'abc1' as a, 'x' as b, '123456789' as c, 'q' as d")
    got = privacy.apply_policy(df, {"a": "mask", "b": "drop", "c": "last4", "d": "hash", "absent": "drop"})
    first = got.first().asDict()
    assert (first["a"], first["c"], len(first["d"]), "b" in first) == ("xxxn", "***6789", 64, False)
    with pytest.raises(ValueError, match="unknown action"):
        privacy.apply_policy(df, {"a": "shred"})
