"""Tables that are kept and changed: what a change rewrites, what readers see meanwhile, and what a repeat does."""

from __future__ import annotations

import datetime
import pathlib
import random
import threading
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.operators import history
from hearthline.operators.lookup import among, backfill_nulls
from hearthline.plans import runs
from hearthline.sinks import pointers, publish
from hearthline.sinks.commits import KEPT, CommitLog, Taken
from hearthline.sinks.dead_letters import DeadLetters
from hearthline.sinks.history_table import HistoryTable
from hearthline.sources import readers
from hearthline.streaming.upsert import LatestLog


def rows(df, *order):
    found = [tuple(r) for r in df.collect()]
    return sorted(found, key=str) if not order else [tuple(r) for r in df.orderBy(*order).collect()]


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in pathlib.Path(path).rglob("*.parquet")}


# -------------------------------------------------------------------- commits


def test_commits(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "t"))
    assert log.read() == (0, {})
    assert log.commit(0, {"a": 1}) == 1
    with pytest.raises(Taken):
        log.commit(0, {"a": 2})
    assert log.change(lambda s: {**s, "b": 2}) == {"a": 1, "b": 2} and log.change(lambda s: None) == {"a": 1, "b": 2}
    assert log.read() == (2, {"a": 1, "b": 2}) and log.read(back=1) == (1, {"a": 1})
    for _ in range(KEPT + 5):
        log.change(lambda s: {**s, "a": s["a"] + 1})
    assert log.read()[1]["a"] == KEPT + 6 and len(list((tmp_path / "t" / "_commits").glob("0*.json"))) == KEPT


def test_commits_of_many_writers(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "t"))

    def add(n):
        for k in range(5):
            log.change(lambda s: {"seen": [*s.get("seen", []), [n, k]]})

    threads = [threading.Thread(target=add, args=(n,)) for n in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(map(tuple, log.read()[1]["seen"])) == [(n, k) for n in range(4) for k in range(5)]


# ------------------------------------------------------------ type-2 versions

EVENT = "k string, ts timestamp, id int, s string"
START = datetime.datetime(2024, 1, 1)


def history_table(spark, path, buckets=8):
    schema = spark.createDataFrame([], EVENT).schema
    return HistoryTable(spark, str(path), schema, ["k"], "ts", ["s"], ["id"], buckets)


def test_batches_give_the_whole_history(spark, tmp_path):
    """Hot, NULL and single keys, equal times, states that go on over the border of batches."""
    rng = random.Random(8)
    data = [(rng.choice(["x"] * 5 + ["y", "z", None, f"n{i}"]), START + datetime.timedelta(hours=i // 3), i, rng.choice(["A", "B", None])) for i in range(240)]
    df = spark.createDataFrame(data, EVENT)
    table = history_table(spark, tmp_path / "h")
    assert table.read().count() == 0
    for n, (low, high) in enumerate([(0, 90), (90, 91), (91, 240)]):
        assert table.merge(df.where(F.col("id").between(low, high - 1)), f"b{n}")["status"] == "merged"
    assert rows(table.read()) == rows(history.scd2(df, ["k"], "ts", ["s"], ["id"]))
    before = rows(table.read())
    assert table.merge(df, "b1") == {"status": "known", "buckets": 0, "late": 0, "closed": 0} and rows(table.read()) == before


def test_a_batch_rewrites_its_buckets_only(spark, tmp_path):
    data = [(f"k{i}", START, i, "A") for i in range(60)]
    table = history_table(spark, tmp_path / "h")
    table.merge(spark.createDataFrame(data, EVENT), "first")
    before = files(tmp_path / "h")
    assert len(before) >= 8
    done = table.merge(spark.createDataFrame([("k7", START + datetime.timedelta(days=1), 100, "B")], EVENT), "second")
    assert done == {"status": "merged", "buckets": 1, "late": 0, "closed": 1}
    after = files(tmp_path / "h")
    assert before.items() <= after.items()
    live = list(table.log.read()[1]["current"].values())
    assert sorted(map(live.count, set(live))) == [1, 7]
    changed = table.read().where("k = 'k7'").orderBy("valid_from").select("s", "is_current")
    assert rows(changed) == sorted([("A", False), ("B", True)], key=str) and table.read().count() == 61


def test_late_rows_are_kept_apart(spark, tmp_path):
    hour = datetime.timedelta(hours=1)
    table = history_table(spark, tmp_path / "h")
    table.merge(spark.createDataFrame([("a", START + 5 * hour, 1, "A"), ("a", START + 9 * hour, 2, "A")], EVENT), "one")
    before = rows(table.read())
    # After the version began, but before its last row: it would have split the version.
    done = table.merge(spark.createDataFrame([("a", START + 7 * hour, 3, "B"), ("b", START, 4, "Z")], EVENT), "two")
    assert done["late"] == 1 and rows(table.read_late()) == [("a", START + 7 * hour, 3, "B")]
    assert rows(table.read().where("k = 'a'")) == before and table.read().count() == 2


def test_a_merge_that_lost_the_race_is_done_again(spark, tmp_path):
    table, other = history_table(spark, tmp_path / "h"), history_table(spark, tmp_path / "h")
    inner = table._merge
    raced = []

    def slower(*args):
        if not raced:
            raced.append(other.merge(spark.createDataFrame([("a", START, 1, "A")], EVENT), "other"))
        return inner(*args)

    table._merge = slower
    table.merge(spark.createDataFrame([("a", START + datetime.timedelta(days=1), 2, "B")], EVENT), "own")
    assert [r[1] for r in rows(table.read(), "valid_from")] == ["A", "B"]


# ------------------------------------------------------------------- pointers


def test_readers_never_miss_a_table(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS swap_db")
    name, faults, counts, ended = "swap_db.report", [], set(), threading.Event()
    publish.refresh_snapshot_tables(spark, {name: lambda: spark.range(1)}, "2024-01-01 00:00:00")

    def look():
        while not ended.is_set():
            try:
                counts.add(spark.table(name).count())
            except Exception as problem:  # noqa: BLE001
                faults.append(str(problem)[:300])

    reader = threading.Thread(target=look)
    reader.start()
    for n in range(2, 7):
        publish.refresh_snapshot_tables(spark, {name: lambda n=n: spark.range(n).withColumn(f"c{n}", F.lit("x"))}, "2024-01-02 00:00:00")
        path = str(tmp_path / f"f{n % 2}_{n}")
        spark.range(n).withColumn(f"d{n}", F.lit(1)).write.parquet(path)
        publish.register_table(spark, "swap_db", "folder", path)
        time.sleep(0.2)
    ended.set()
    reader.join()
    assert not faults and counts <= set(range(1, 7)) and len(counts) > 1
    assert spark.table(name).columns == ["id", "c6", "_refreshed_at"] and spark.table("swap_db.folder").columns == ["id", "d6"]
    assert len(pointers.versions(spark, name)) == 2
    pointers.rollback(spark, name)
    assert spark.table(name).columns == ["id", "c5", "_refreshed_at"]
    with pytest.raises(ValueError, match="no earlier version"):
        pointers.rollback(spark, name)
    publish.refresh_snapshot_tables(spark, {name: lambda: spark.range(9)}, "2024-01-03 00:00:00")
    assert spark.table(name).count() == 9


def test_plain_tables_become_pointers(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS plain_db")
    spark.range(3).write.saveAsTable("plain_db.old")
    assert pointers.target_of(spark, "plain_db.old") is None
    publish.refresh_snapshot_tables(spark, {"plain_db.old": lambda: spark.range(4)}, "2024-01-01 00:00:00")
    assert spark.table("plain_db.old").count() == 4 and pointers.target_of(spark, "plain_db.old")


def test_quotes_in_paths(spark, tmp_path):
    path = str(tmp_path / "it's `here`")
    spark.range(2).write.parquet(path)
    publish.register_table(spark, "quote_db", "t", path)
    publish.register_table(spark, "quote_db", "t", path)
    assert spark.table("quote_db.t").count() == 2 and len(pointers.versions(spark, "quote_db.t")) == 1


# ----------------------------------------------------------------- projection


def test_projection_reads_the_asked_folders_only(spark, tmp_path):
    base = str(tmp_path / "days")
    for day in readers.days(datetime.date(2024, 1, 1), datetime.date(2024, 1, 30)):
        if day != "2024-01-11":
            spark.range(int(day[-2:])).write.parquet(f"{base}/dt={day}")
    # Whoever lists the folder finds a part that can't be one.
    (tmp_path / "days" / "other=1").mkdir()
    (tmp_path / "days" / "other=1" / "broken.parquet").write_text("no table")
    found = readers.read_projected(spark, base, "dt=${dt}", {"dt": readers.days(datetime.date(2024, 1, 10), datetime.date(2024, 1, 12))})
    counted = found.groupBy(F.col("dt").cast("string")).count()
    assert rows(counted) == [("2024-01-10", 10), ("2024-01-12", 12)]
    scan = found._jdf.queryExecution().analyzed().collectLeaves().apply(0).relation().location()
    assert scan.rootPaths().size() == 2
    assert readers.days(datetime.date(2024, 1, 30), datetime.date(2024, 2, 5), 3) == ["2024-01-30", "2024-02-02", "2024-02-05"]


def test_projection_of_numbers_and_lists(spark, tmp_path):
    base = str(tmp_path / "r")
    for year in (2023, 2024):
        for month in (1, 2, 3):
            spark.range(month).write.parquet(f"{base}/closing_year={year}/closing_month={month}")
    template = "closing_year=${closing_year}/closing_month=${closing_month}"
    found = readers.read_projected(spark, base, template, {"closing_year": [2024, 2025], "closing_month": range(2, 13)})
    assert rows(found.groupBy("closing_year", "closing_month").count()) == [(2024, 2, 2), (2024, 3, 3)]
    schema = T.StructType([T.StructField("id", T.LongType())])
    none = readers.read_projected(spark, base, template, {"closing_year": [1], "closing_month": [1]}, schema)
    assert none.columns == ["id", "closing_year", "closing_month"] and none.count() == 0
    with pytest.raises(ValueError, match="no partition"):
        readers.read_projected(spark, base, template, {"closing_year": [1], "closing_month": [1]})
    with pytest.raises(ValueError, match="the template names"):
        readers.read_projected(spark, base, template, {"dt": [1]})


# --------------------------------------------------------------- dead letters


def test_letters_are_merged_back_once(spark, tmp_path):
    bad = spark.createDataFrame(
        [(1, "-5", ["negative"]), (2, "x", ["not a number"]), (3, None, ["none"]), (3, "x3", ["not a number"]), (3, "x4", ["not a number"]), (None, "x5", ["not a number"])],
        "id int, v string, reasons array<string>",
    )
    letters = DeadLetters(spark, str(tmp_path / "l"), bad.drop("reasons").schema, ["id"])
    assert letters.open().count() == 0 and letters.recovered().count() == 0
    assert letters.add(bad, "run") == 6 and letters.add(bad, "run") == 0 and letters.open().count() == 6
    tests = [("negative", F.col("v").startswith("-")), ("none", F.col("v").isNull()), ("not a number", ~F.col("v").rlike("^-?[0-9]+$"))]

    def fix(df):
        return df.withColumn("v", F.when(F.col("v").startswith("x") & (F.length("v") > 1), F.substring("v", 2, 9)).otherwise(F.col("v")))

    assert letters.reprocess(fix, *tests) == {"recovered": 2, "changed": 1, "open": 4}
    assert rows(letters.recovered()) in ([(3, "3"), (None, "5")], [(3, "4"), (None, "5")])
    open_ = rows(letters.open().select("id", F.array_join("reasons", ","), "attempt"))
    assert open_ == sorted([(1, "negative", 1), (2, "not a number", 1), (3, "none", 1), (3, "repeated key", 2)], key=str)
    state, held = letters.log.read(), files(tmp_path / "l")
    assert letters.reprocess(fix, *tests) == {"recovered": 0, "changed": 0, "open": 4}
    assert letters.log.read() == state and files(tmp_path / "l") == held
    assert letters.reprocess(lambda df: df.withColumn("v", F.lit("7")), *tests) == {"recovered": 2, "changed": 2, "open": 2}
    assert rows(letters.recovered().select("id"), "id")[1:] == [(1,), (2,), (3,)]


# --------------------------------------------------------- stream, compaction


def test_compaction_rewrites_full_buckets_only(spark, tmp_path):
    out = str(tmp_path / "log")
    log = LatestLog(spark, out, "k", "ts", buckets=4)
    assert log.read() is None and log.compact() == []
    bucket = F.pmod(F.xxhash64("k"), F.lit(4)).cast("int")
    data = spark.range(80).select(F.col("id").cast("string").alias("k"), F.col("id").alias("ts"))
    log.upsert(data)
    first = {b: held[0][1] for b, held in log.log.read()[1]["live"].items()}
    assert sum(first.values()) == 80 and len(first) == 4
    for n in range(1, 6):
        log.upsert(data.where(bucket == 2).withColumn("ts", F.col("ts") + 1000 * n))
    before, limit = files(out), max(first.values())
    assert log.compact(over=limit) == [2] and log.compact(over=limit) == []
    # A compacted bucket counts from its compaction on, and no file of another bucket is new.
    after = files(out)
    assert before.items() <= after.items() and {f.split("/")[0] for f in set(after) - set(before)} == {"_bucket=2"}
    want = {r["k"]: r["ts"] for r in data.withColumn("ts", F.when(bucket == 2, F.col("ts") + 5000).otherwise(F.col("ts"))).collect()}
    assert dict(rows(log.read())) == want
    assert log.vacuum() == 6 and log.vacuum() == 0
    left = files(out)
    assert dict(rows(log.read())) == want and {f for f in before if not f.startswith("_bucket=2")} < set(left) < set(after)


def test_batches_go_on_during_compaction(spark, tmp_path):
    log = LatestLog(spark, str(tmp_path / "log"), "k", "ts", buckets=2)
    for n in range(3):
        log.upsert(spark.createDataFrame([(str(i), n) for i in range(10)], "k string, ts int"))
    inner = log._write

    def write(df, folder):
        held = inner(df, folder)
        LatestLog(spark, str(tmp_path / "log"), "k", "ts").upsert(spark.createDataFrame([("3", 99)], "k string, ts int"))
        return held

    log._write = write
    assert log.compact() == [0, 1]
    log._write = inner
    assert dict(rows(log.read())) == {str(i): 99 if i == 3 else 2 for i in range(10)}
    assert sum(n for held in log.log.read()[1]["live"].values() for _, n, _ in held) == 11


def test_a_replayed_batch_is_added_once(spark, tmp_path):
    log = LatestLog(spark, str(tmp_path / "log"), "k", "ts", buckets=2)
    batch = spark.createDataFrame([("a", 1)], "k string, ts int")
    for number in (0, 0, 1, 0):
        log.upsert(batch, stream="s", number=number)
    assert sum(n for held in log.log.read()[1]["live"].values() for _, n, _ in held) == 2


# ------------------------------------------------------- schemas, source pool


def test_schemas_are_kept(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.range(2).write.mode("append").parquet(path)
    assert readers.remember_schema(spark, path, "r1")["history"] == [{"run_ts": "r1", "added": {"id": "bigint"}}]
    time.sleep(0.01)
    spark.range(3).select("id", F.lit("x").alias("more")).write.mode("append").parquet(path)
    state = readers.remember_schema(spark, path, "r2")
    assert [e["added"] for e in state["history"]] == [{"id": "bigint"}, {"more": "string"}]
    number = readers._schema_log(spark, path).read()[0]
    assert readers.read_raw(spark, path).columns == ["id", "more"] and readers.read_raw(spark, path).count() == 5
    # Nothing new, nothing committed; and rows of files without the column have none.
    assert readers._schema_log(spark, path).read()[0] == number
    assert readers.read_raw(spark, path).where("more is null").count() == 2
    assert rows(readers.schema_history(spark, path)) == [("r1", "id", "bigint"), ("r2", "more", "string")]
    time.sleep(0.01)
    spark.range(1).select(F.col("id").cast("string").alias("id")).write.mode("append").parquet(path)
    with pytest.raises(ValueError, match="changed their type"):
        readers.read_raw(spark, path)
    spark.range(4).select(F.col("id").cast("string").alias("id")).write.mode("overwrite").parquet(path)
    assert readers.remember_schema(spark, path, "r3", replaced=True)["history"][-1] == {"run_ts": "r3", "added": {"id": "string"}}
    assert readers.read_raw(spark, path).columns == ["id"] and readers.read_raw(spark, path).count() == 4


def test_sources_run_side_by_side(spark):
    running, most, lock = set(), [0], threading.Lock()

    def job(source):
        with lock:
            running.add(source.name)
            most[0] = max(most[0], len(running))
        time.sleep(0.3 if source.name == "loans" else 0.1)
        pool = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
        with lock:
            running.remove(source.name)
        if source.name == "users":
            raise RuntimeError("down")
        return {"records": spark.range(3).count(), "pool": pool}

    report = readers.run_each(readers.SOURCES, job, at_once=3, spark=spark)
    assert most[0] == 3 and [r["source"] for r in report] == [s.name for s in readers.SOURCES]
    assert all(r["status"] == "error" if r["source"] == "users" else (r["records"], r["pool"]) == (3, r["source"]) for r in report)


# -------------------------------------------- patches, buckets and workbooks


def test_patches_are_reduced_before_their_newest_rows_are_looked_for(spark):
    patch = spark.range(10_000).select((F.col("id") % 5000).cast("string").alias("k"), F.col("id").alias("at"), F.col("id").cast("string").alias("a"))
    wanted = spark.createDataFrame([("7",), ("4999",), ("absent",)], "w string")
    for words in (1, 16, 1 << 17):
        assert rows(among(patch, "k", wanted, words).select("k", "a")) == [("4999", "4999"), ("4999", "9999"), ("7", "5007"), ("7", "7")]
    holed = spark.createDataFrame([("7", None), ("8", "full"), (None, None)], "k string, a string")
    filled = backfill_nulls(holed, patch, "k", ["a"], newest="at")
    assert rows(filled) == sorted([("7", "5007"), ("8", "full"), (None, None)], key=str)
    plan = filled._jdf.queryExecution().optimizedPlan().toString()
    window = plan.index("Window")
    assert "LeftSemi" in plan[window:] and "_bits" in plan[window:]


def test_bucketed_star_joins_without_a_shuffle(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS bucket_db")
    hot = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).cast("string").alias("loan_id")
    for name, column in (("a", "x"), ("b", "y")):
        publish.write_with_layout(spark.range(3000).select(hot, F.col("id").alias(column)), f"bucket_db.{name}", "loan_id", ["loan_id"], 4)
    joined = spark.table("bucket_db.a").hint("merge").join(spark.table("bucket_db.b"), "loan_id", "left")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.count() == 1000 * 1000 + 2000


def cells(*texts):
    return [("s", t) for t in texts]


def test_workbooks_keep_their_columns(spark, tmp_path):
    grid = spark.createDataFrame(
        [
            ("a.xlsx", "S", 0, cells("Name", "City", "Zip")), ("a.xlsx", "S", 1, cells("Ann", "Rome", "1x")),
            ("b.xlsx", "S", 0, cells("Zip", "Name", "City", "Name")), ("b.xlsx", "S", 1, cells("2y", "Bob", "Oslo", "B.")),
            ("c.xlsx", "S", 3, cells("Zip", "Empty", "Name")), ("c.xlsx", "S", 4, cells("3z", "", "Cy")), ("c.xlsx", "T", 0, cells("u", "v", "w")),
        ],
        "source_uri string, sheet string, row_idx int, cells array<struct<t string, v string>>",
    )
    log = runs.curate_sheets(grid, {"S": "people"}, str(tmp_path), "2024-01-01", "2024-01-01 00:00:00")
    assert [(r["source"], r["records"], r["written"]) for r in log.collect()] == [("people", 3, 3)]
    found = spark.read.parquet(str(tmp_path / "people"))
    assert set(found.columns) == {"name", "city", "zip", "name_1", "_source_file", "_source_sheet", "_etl_loaded_at", "dt"}
    assert rows(found.select("_source_file", "name", "city", "zip", "name_1"), "_source_file") == [
        ("a.xlsx", "Ann", "Rome", "1x", None), ("b.xlsx", "Bob", "Oslo", "2y", "B."), ("c.xlsx", "Cy", None, "3z", None),
    ]
