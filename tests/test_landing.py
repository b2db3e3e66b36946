"""Landing, reading, grids and deduplication."""

from __future__ import annotations

import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from hearthline.operators import dedupe
from hearthline.operators.lookup import backfill_nulls, lookup
from hearthline.schema import Field, Record, coalesce_spellings, drop_ancient_dates, first_existing, first_of_list_fk, resolve_fk, safe_col, union_all
from hearthline.sources import grid as grids
from hearthline.sources import landing, readers


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_latest_per_key_is_total_and_stable(spark):
    data = [("a", "1", "x"), ("a", "2", "y"), ("a", "2", "z"), ("b", "1", "q"), ("b", None, "r")]
    want = None
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "_id string, ts string, v string").repartition(seed + 1)
        got = rows(dedupe.latest_per_key(df, "_id", "ts"), "_id")
        want = want or got
        assert got == want and len(got) == 2 and got[1] == ("b", "1", "q")


def test_latest_per_key_limits_rows_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("ts"))
    plan = dedupe.latest_per_key(df, "k", "ts")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_latest_without_time_column_keeps_one_row(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "_id string, v int")
    assert dedupe.latest_per_key(df, "_id", "absent").count() == 1
    assert rows(dedupe.dedupe_report(df, "_id")) == [(2, 1, 1)]


@pytest.mark.parametrize("limit", ["-1", "10485760"])
def test_lookup_is_a_left_join_whatever_the_size(spark, limit):
    """A hot key, NULL keys and unmatched keys."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        left = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k"))
        right = spark.sql("select * from values ('hot', 1), ('4', 2), ('unused', 3) as t(k, v)")
        got = lookup(left, right, "k")
        assert got.columns == ["id", "k", "v"] and got.count() == 3000
        assert rows(got.groupBy("v").count(), "v") == [(None, 1999), (1, 1000), (2, 1)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_backfill_fills_only_gaps(spark):
    df = spark.createDataFrame([(1, "5", " "), (2, None, "7"), (3, "", None), (4, None, None)], "_id int, a string, b string")
    patch = spark.createDataFrame([("1", "9", "8"), ("2", "6", "x"), ("3", None, "y")], "_id string, a string, b string")
    got = backfill_nulls(df, patch, "_id", ["a", "b"])
    assert rows(got, "_id") == [(1, "5", "8"), (2, "6", "7"), (3, None, "y"), (4, None, None)]
    with pytest.raises(ValueError, match="absent"):
        backfill_nulls(df, patch, "_id", ["a", "absent"])


def test_backfill_takes_the_newest_of_several_versions(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "_id int, a string")
    patch = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (None, "x", 3)], "_id int, a string, at int")
    assert rows(backfill_nulls(df, patch, "_id", ["a"], newest="at"), "a") == [(None, None), (1, "new")]


def test_flatten_and_canonical(spark):
    df = spark.createDataFrame([json.dumps({"x": 1})], "string").select(
        F.lit("i1").alias("_id"),
        F.struct(F.lit("c1").alias("_id"), F.lit("n").alias("name")).alias("owner"),
        F.array(F.struct(F.lit(1).alias("k"), F.lit(None).cast("string").alias("v"))).alias("items"),
        F.lit(True).alias("flag"),
        F.lit(datetime.datetime(2024, 1, 2, 3, 4, 5)).alias("at"),
    )
    assert landing.land(df).first().asDict() == {
        "_id": "i1", "ownerId": "c1", "items": '[{"k":"1","v":null}]', "flag": "true", "at": "2024-01-02T03:04:05",
    }
    clash = spark.createDataFrame([("", "v", None)], "zipcode string, zipCode string, other string")
    assert landing.canonical_columns(clash).first().asDict() == {"zipCode": "v", "other": None}
    assert landing.rename_duplicate_columns(clash).columns == ["zipcode", "zipCode__dup1", "other"]


def test_choice_struct_leaves_real_documents(spark):
    df = spark.sql("select named_struct('int', 5, 'string', null) as a, named_struct('int', 5, 'name', 'x') as b")
    got = landing.flatten_choice_structs(df)
    assert got.schema["a"].dataType.simpleString() == "string" and got.schema["b"].dataType.simpleString().startswith("struct")


def test_ancient_dates_and_union(spark):
    df = spark.sql("select date'1200-01-01' as d, timestamp'1582-10-14 23:00:00' as t, date'1582-10-15' as ok")
    assert rows(drop_ancient_dates(df)) == [(None, None, datetime.date(1582, 10, 15))]
    a, b = spark.sql("select 1 as x"), spark.sql("select 2 as y")
    assert rows(union_all([a, b])) == [(1, None), (None, 2)] and rows(union_all([b, a]).select("x", "y"), "y") == [(1, None), (None, 2)]


def test_schema_helpers(spark):
    df = spark.sql("select 'z' as zipCode, 'q' as Name, array('e') as ids, array() as none, named_struct('id', 's1') as user, 'p' as loan")
    r = Record.of(df)
    got = df.select(
        coalesce_spellings(r, "zip", "zipCode"), first_existing(r, "nothing", "name", ignore_case=True), first_existing(r, "absent"),
        first_of_list_fk(r, "one", "ids"), first_of_list_fk(r, "one", "none"), resolve_fk(r, "user"), resolve_fk(r, "loan"),
        resolve_fk(r, "absent"), safe_col(r, "absent", "int"),
    )
    assert rows(got) == [("z", "q", None, "e", None, "s1", "p", None, None)]
    assert got.schema.fields[-1].dataType.simpleString() == "int"
    structs = spark.sql("select array(named_struct('_id', 'a1')) as ids, 'solo' as one")
    assert rows(structs.select(first_of_list_fk(Record.of(structs), "absent", "ids"), first_of_list_fk(Record.of(structs), "one", "ids"))) == [("a1", "solo")]


def test_optional_and_incremental_reads(spark, tmp_path):
    empty = readers.read_optional(spark, str(tmp_path / "none"), [Field("_id"), Field("amount", "money")])
    assert empty.count() == 0 and empty.dtypes == [("_id", "string"), ("amount", "decimal(18,2)")]
    assert readers.read_optional(spark, str(tmp_path / "none")) is None
    spark.sql("select 1 as a").write.parquet(str(tmp_path / "t" / "x=1"))
    spark.sql("select 2 as a, 'n' as b").write.parquet(str(tmp_path / "t" / "x=2"))
    assert set(readers.read_raw(spark, str(tmp_path / "t")).columns) == {"a", "b", "x"}
    df = spark.sql("select timestamp'2024-01-10' as at, '2024-01-10T00:00:00' as text")
    as_of = datetime.datetime(2024, 1, 12)
    assert [readers.incremental_slice(df, c, n, as_of).count() for c, n in (("at", 1), ("at", 2), ("text", 1), ("text", 3), (None, 0))] == [0, 1, 0, 1, 1]
    with pytest.raises(ValueError, match="no cursor column"):
        readers.incremental_slice(df, "updatedAt", 1, as_of)


def test_sources_run_in_isolation():
    def job(source):
        if source.name == "users":
            raise RuntimeError("down")
        return {"records": 1}

    report = readers.run_each(readers.SOURCES, job)
    assert len(report) == 9 and [r["source"] for r in report if r["status"] == "error"] == ["users"]


def test_newest_file_per_stem(spark):
    at = datetime.datetime
    files = spark.createDataFrame(
        [("s3/in/Trial_1.xls", at(2024, 1, 1)), ("s3/in/TRIAL_2.xlsx", at(2024, 1, 2)), ("s3/in/trial.txt", at(2024, 1, 9)),
         ("s3/latest/Trial_3.xls", at(2024, 1, 8)), ("s3/in/my dash.xlsx", at(2024, 1, 3))],
        "path string, modificationTime timestamp",
    )
    got = readers.latest_per_stem(files, ["trial", "dash"], ignore=["/latest/"])
    assert rows(got.select("stem", "path")) == [("trial", "s3/in/TRIAL_2.xlsx")]
    anywhere = readers.latest_per_stem(files, ["dash"], anywhere=True)
    assert rows(anywhere.select("path")) == [("s3/in/my dash.xlsx",)]


def test_list_files_and_table_map(spark, tmp_path):
    (tmp_path / "a.xls").write_bytes(b"123")
    assert rows(readers.list_files(spark, str(tmp_path)).select("length")) == [(3,)]
    assert readers.table_map(["A", "B"], '{"A": "t_a", "C": "t_c"}') == {"A": "t_a"}
    with pytest.raises(ValueError, match="not found"):
        readers.table_map(["A"], {"C": "t_c"}, missing="fail")
    assert rows(readers.inline_table(spark, [(1, "a")], "i int, s string")) == [(1, "a")]


def sheet(spark, lines, name="s1"):
    cells = [[(t, v) for t, v in line] for line in lines]
    return spark.createDataFrame([("u", name, i, c) for i, c in enumerate(cells)], "source_uri string, sheet string, row_idx int, cells array<struct<t:string,v:string>>")


def s(*values):
    return [("s", v) for v in values]


def test_grid_to_table(spark):
    wide = [("z", None)] * 40
    lines = [
        s("Title"), [], s("Loan #", "PTD", "Premium", "", "2nd Policy") ,
        s("L1") + [("n", "46174"), ("n", "46174"), ("b", "true"), ("e", "#N/A")],
        s("L2"), s(" ", ""), s("L3") + [("d", "2024-11-18 00:00:00"), ("n", "1.5"), ("s", " x "), ("s", "p")] + wide[:3],
    ]
    grid = sheet(spark, lines)
    head = grids.header_rows(grid).first()
    assert (head["header_idx"], head["width"]) == (2, 5)
    table = grids.snake_columns(grids.sheet_table(grid, "u", "s1"))
    assert table.columns == ["loan", "ptd", "premium", "col_3", "col_2nd_policy"]
    assert rows(table, "loan") == [("L1", "06/01/2026", "46174", "1", ""), ("L2", "", "", "", ""), ("L3", "11/18/2024", "1.5", "x", "p")]


def test_header_rules(spark):
    numeric = sheet(spark, [s("1", "2", "$3", "-4.5"), s("a", "b", "c", "4")])
    assert grids.detect_header(numeric).first()["header_idx"] == 1
    none = sheet(spark, [s("1", "2"), s("x", "y")])
    assert grids.detect_header(none).first()["header_idx"] == 0
    late = sheet(spark, [s("1", "2", "3")] * 30 + [s("a", "b", "c")])
    assert grids.detect_header(late).first()["header_idx"] == 0


def test_numeric_text(spark):
    values = {"1": True, "-1,000.5%": True, "$5": True, ".5": True, "5.": True, "1.2.3": False, "--1": False, "": False, "a1": False, ".": False}
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert [r[0] for r in df.select(grids.is_numeric_text(F.col("v"))).collect()] == list(values.values())


def test_empty_columns(spark):
    df = spark.createDataFrame([("a", " ", None), ("b", "", None)], "`Keep Me` string, gap string, none string")
    assert grids.snake_columns(grids.drop_empty_columns(df)).columns == ["keep_me"]
    assert rows(grids.non_blank_counts(df)) == [(2, 0, 0)]
