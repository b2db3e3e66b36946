"""The limit for lines of the pipeline and of the registered query acts alike in hosts of every size."""

from __future__ import annotations

import random

import corpus_pipeline
from hearthline.llm import queries

SHAPE = "doc_id long, text string, lang string, source string, n_chars long"
r = random.Random(8)


def own():
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(3, 8))) for _ in range(25))


def test_host_sizes(spark, tmp_path):
    """A line of 21 documents goes from hosts of 50 and 5000, one of 10 stays everywhere, one of all goes from 50 and 5000."""
    docs, expected = [], {}
    for size in (10, 50, 5000):
        for k in range(size):
            shared = [name for name, n in (("line of ten", 10), ("line of twenty one", 21), ("line of twenty", 20), ("line of all", size)) if k < n]
            text = own()
            present = {"line of ten": 10, "line of twenty one": min(size, 21), "line of twenty": min(size, 20), "line of all": size}
            expected[len(docs)] = "\n".join([text, *(x for x in shared if present[x] <= 20)])
            whole = "\n".join([text, *shared])
            docs.append((len(docs), whole, "en", f"h{size}", len(whole)))
    df = spark.createDataFrame(docs, SHAPE).repartition(4)
    assert {x.doc_id: x.text for x in corpus_pipeline.quality_rules(spark, df, "").collect()} == expected
    df.write.parquet(str(tmp_path / "documents.parquet"))
    found = {x.doc_id: x for x in queries.op2_line_quality(spark, str(tmp_path)).collect()}
    assert all(x.kept for x in found.values()) and {i: x.n_words_left for i, x in found.items()} == {i: len(t.split()) for i, t in expected.items()}


def test_small_rates_stay(spark):
    """Rates far below a millionth keep six digits, alike in Spark and in the reference SQL."""
    import duckdb
    from pyspark.sql import functions as F

    from hearthline.llm.poisson_mix import rounded
    from hearthline.llm.sql import rounded as rounded_sql

    rates = [3.14159265358, 1.0, 0.123456789012, 4.1234567891e-7, 9.87654321e-13, 2.5e-26, 0.0]
    found = [r[0] for r in spark.createDataFrame([(x,) for x in rates], "x double").select(rounded(F.col("x"))).collect()]
    assert found == [duckdb.sql(f"select {rounded_sql(f'{x!r}::double')}").fetchall()[0][0] for x in rates]
    assert all(abs(a - b) <= 1e-6 * b for a, b in zip(found, rates[:5], strict=False)) and found[5] > 0 and found[6] == 0
