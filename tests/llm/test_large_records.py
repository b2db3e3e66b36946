"""Records far larger than a chunk pass through the archives in chunks."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from hearthline.llm import warc_chunks


def test_fifty_megabytes(spark):
    """One record of 50 MB beside small ones: as many rows as chunks, each of a chunk's size, and no array of them in the plan."""
    size, chunk = 50_000_000, 1 << 16
    pages = spark.range(3).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"), F.when(F.col("id") == 1, F.repeat(F.lit("0123456789"), size // 10)).otherwise("small").alias("html")
    )
    records = warc_chunks.dedup_plan(pages)
    rows = warc_chunks.chunk_rows(records, chunk)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "transform(" not in plan and "encode(" not in plan and "Generate explode(sequence(" in plan
    found = warc_chunks.read_archives(warc_chunks.write_archives(rows), chunk, with_data=False).collect()
    assert sum(r.page_id == 1 for r in found) == -(-size // chunk)
    last = {r.page_id: r for r in found if r.last}
    assert (last[1].payload_bytes, last[1].payload_digest) == (size, hashlib.sha1(b"0123456789" * (size // 10)).hexdigest())
    assert sorted(last) == [0, 1, 2]


def test_other_bytes_are_noticed(spark):
    rows = warc_chunks.chunk_rows(warc_chunks.dedup_plan(spark.createDataFrame([(1, "u", "x" * 300)], "page_id long, url string, html string")), 100)
    with pytest.raises(Exception, match="are not its payload"):
        warc_chunks.write_archives(rows.withColumn("data", F.when(F.col("chunk") == 1, F.lit(b"y")).otherwise(F.col("data"))))
