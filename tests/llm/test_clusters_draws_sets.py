"""Table clustering, importance resampling and odd sketches against brute force, on fixtures and the given tables."""

from __future__ import annotations

import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hearthline.llm import importance_resample, odd_sketch, table_clusters
from hearthline.llm.queries import QUERIES

from . import brute_more

SF = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables are not here")


def key(row):
    return tuple((v is None, v) for v in row)


def same(found, expected):
    assert sorted(map(tuple, found), key=key) == sorted(expected, key=key)


# 11

VECTOR_SHAPE = "vec_id long, embedding array<double>, id int, cluster int, distance string, `a.b` int"


def vector_rows(n, dims, spread):
    rng = random.Random(n)
    return [(i, [rng.choice((rng.gauss(0, spread), float(rng.randint(-2, 2)))) for _ in range(dims)]) for i in range(n)]


def clustered(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, 2, "x", 3) for r in rows], VECTOR_SHAPE).repartition(3)
    return table_clusters.cluster(df, **options)


@pytest.mark.parametrize("spread", [0.3, 1e4, 1e12])
def test_clusters(spark, spread):
    rows = vector_rows(300, 5, spread)
    options = {"k": 7, "rounds": 3, "dims": 5, "scale": 64, "seed": 1}
    same(clustered(spark, rows, **options).collect(), brute_more.clusters(rows, **options))


def test_clusters_odd(spark):
    """Nulls, other lengths, non-finite and huge components, repeated rows, ties, null ids; fewer vectors than clusters; none."""
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [1.0, 2.0]), (4, [1.0, 2.0, None]), (5, [1.0, nan, 0.0]), (6, [1.0, inf, 0.0]), (7, [1e300, -1e300, 1e18]),
        (8, [0.5, 0.5, 0.5]), (8, [0.5, 0.5, 0.5]), (8, [0.25, 0.5, 0.5]), (None, [0.1, 0.2, 0.3]), (9, [-0.5, -0.5, -0.5]), (10, [0.0, 0.0, 0.0]),
    ]
    options = {"k": 4, "rounds": 2, "dims": 3, "scale": 64, "seed": 1}
    same(clustered(spark, rows, **options).collect(), brute_more.clusters(rows, **options))
    options["k"] = 50
    same(clustered(spark, rows, **options).collect(), brute_more.clusters(rows, **options))
    none = clustered(spark, rows[:6], **options)
    assert none.collect() == [] and none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_tables_hold_occurring_values():
    vectors = np.array([[3, -1], [3, 5], [7, 5], [3, -1]])
    block = table_clusters.coded(vectors)
    held = table_clusters.tables(block, [[0, 0], [3, 5]])
    assert [t.tolist() for t in held] == [[[9, 0], [49, 16]], [[1, 36], [25, 0]]]
    best, distance = table_clusters.nearest(block, [[0, 0], [3, 5]])
    assert best.tolist() == [0, 1, 1, 0] and distance.tolist() == [10, 0, 16, 10]


def test_many_values_in_blocks(spark):
    """More vectors than a block, each component another value."""
    rng = np.random.default_rng(3)
    rows = [(i, v) for i, v in enumerate(rng.normal(0, 1000, (table_clusters.BLOCK + 500, 2)).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    options = {"k": 3, "rounds": 2, "dims": 2, "scale": 64, "seed": 1}
    same(table_clusters.cluster(df, **options).collect(), brute_more.clusters(rows, **options))


# 12

WORDS = "Alpha beta gamma-delta épsilon zeta9 eta theta iota kappa lambda mu nu".split()
DOC_SHAPE = "doc_id long, text string, id string, score int, rank int, `a.b` int"


def texts(n, seed=4):
    rng = random.Random(seed)
    return [" ".join(rng.choices(WORDS[: rng.randint(2, 12)], k=rng.randint(0, 60))) for _ in range(n)]


def resampled(spark, rows, target, **options):
    df = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], DOC_SHAPE).repartition(3)
    return importance_resample.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), **options)


@pytest.mark.parametrize("options", [{}, {"runs": 3, "buckets": 50}, {"share": 100, "min_words": 0, "buckets": 100_000}, {"share": 1}, {"share": 0}])
def test_resample(spark, options):
    rows = list(enumerate(texts(400)))
    target = ["alpha BETA gamma", None, "", "zeta9 zeta9 kappa", "absent"]
    same(resampled(spark, rows, target, **options).collect(), brute_more.resampled(rows, target, **options))


def test_resample_odd(spark):
    """Null and empty texts, one long text, repeated rows, null ids, no target, no rows."""
    long = " ".join(random.Random(1).choices(WORDS, k=30_000))
    rows = [(0, None), (1, ""), (2, "-- !!"), (3, long), (4, WORDS[0] * 3000), (None, "alpha " * 30), (None, "alpha " * 30), (6, "alpha " * 30)]
    rows += [(7, "beta mu " * 20)] * 6
    for share in (10, 50, 90):
        same(resampled(spark, rows, [], share=share).collect(), brute_more.resampled(rows, [], share=share))
    none = resampled(spark, [], ["alpha"])
    assert none.collect() == [] and none.columns == ["doc_id", "n_features", "weight", "score", "rank"]


def test_bracket_is_widened(spark, monkeypatch):
    """A sketch that misses by far is found out by the counts; equal scores of a third of the rows don't matter."""
    rows = [(i, 0 if i % 3 == 0 else i, i) for i in range(3000)]
    scores = spark.createDataFrame(rows, "id long, score long, row long")
    asked = []

    def wrong(df, shares):
        asked.append(shares)
        return sorted([5, 6][: len(shares)])

    monkeypatch.setattr(importance_resample, "score_quantiles", wrong)
    for share in (1, 10, 66, 67, 90, 100):
        expected = sorted(rows, key=lambda r: (-r[1], r[0]))[share * 30 - 1]
        asked.clear()
        assert importance_resample.cutoff(scores, share) == (expected[1], expected[0], expected[2])
        assert len(asked) > (share == 10)


def test_bracket_is_small(spark):
    scores = spark.range(200_000).select(F.pmod(F.xxhash64("id"), F.lit(1_000_000)).alias("score"))
    low, high, above = importance_resample.bracket(scores, 200_000, 20_000)
    inside = scores.where(f"score between {low} and {high}").count()
    assert above < 20_000 <= above + inside and inside < 4000


# 13


def grouped(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], DOC_SHAPE).repartition(3)
    return odd_sketch.grouped(df, **options)


def near_copies(seed, n, n_words, changes):
    rng = random.Random(seed)
    base = [f"w{seed}x{i}" for i in range(n_words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(0, changes)):
            own[rng.randrange(n_words)] = f"z{rng.randrange(10**6)}"
        out.append(" ".join(own))
    return out


def test_sets(spark):
    rng = random.Random(9)
    rows = list(enumerate(t for k in range(12) for t in near_copies(k, 14, 90, 9)))
    rows += [(1000 + i, " ".join(rng.choices(WORDS, k=rng.randint(0, 7)))) for i in range(150)]
    rng.shuffle(rows)
    same(grouped(spark, rows).collect(), brute_more.set_groups(rows))


def test_wide_bucket(spark, monkeypatch):
    """A family whose members are linked in chains only, in blocks of few members."""
    monkeypatch.setattr(odd_sketch, "WIDE", 8)
    rows = list(enumerate(near_copies(77, 120, 120, 14)))
    expected = brute_more.set_groups(rows)
    assert 1 < len({r[2] for r in expected}) < 60
    same(grouped(spark, rows).collect(), expected)


@pytest.mark.parametrize("shingle", [1, 2, 5])
def test_sets_odd(spark, shingle):
    """Null and empty texts, single words, repeated rows and ids, null ids, long texts, letters of either case."""
    long = " ".join(f"v{i}" for i in range(20_000))
    rows = [
        (0, None), (1, ""), (2, " \n\t"), (3, "One"), (4, "one"), (4, "one"), (5, "one two"), (6, "two one"), (7, long), (8, long + " more"), (9, "É é"),
        (10, "é É"), (None, "solo text here"), (None, "solo text here"), (None, None), (11, "a a a a a a"), (12, "A a"), (4, "other words"),
        (13, "p q r s t u"), (14, "p q r s t"), (15, "q r s t u"), (16, "solo text here and more of it"),
    ]
    same(grouped(spark, rows, shingle=shingle).collect(), brute_more.set_groups(rows, shingle))
    none = grouped(spark, [])
    assert none.collect() == [] and none.columns == ["doc_id", "n_shingles", "component_id", "kept"]


def test_sketches_estimate_similarity():
    """The differing bits of pairs follow their similarity, and pairs of the asked one are within the limit."""
    rng = np.random.default_rng(2)
    most, n = odd_sketch.most_bits(0.8), 400
    for similarity, passes in ((0.95, True), (0.8, True), (0.5, False)):
        shared = round(2 * n * similarity / (1 + similarity))
        bits = []
        for _ in range(60):
            values = rng.integers(0, 2**63, 2 * n - shared, dtype=np.uint64)
            two = np.concatenate([np.sort(values[:n]), np.sort(values[n - shared :])])
            x, y = odd_sketch.odd_sketches(odd_sketch.samples(two, np.array([0, n, 2 * n])))
            bits.append(int(np.bitwise_count((x ^ y).view(np.uint64)).sum()))
        differ = odd_sketch.BANDS * odd_sketch.ROWS * (1 - similarity)
        expected = odd_sketch.BITS / 2 * (1 - (1 - 2 / odd_sketch.BITS) ** (2 * differ))
        assert abs(np.mean(bits) - expected) < 6
        assert all((b <= most) for b in bits) == passes


def test_set_hashes_tell_shingles_apart():
    values, begin = odd_sketch.shingle_sets(pa.array(["a b", "a", "b a", "", None, "a b a b"]), 2)
    sets = [set(values[a:b].tolist()) for a, b in zip(begin, begin[1:], strict=False)]
    assert [len(s) for s in sets] == [1, 1, 1, 0, 0, 2] and sets[5] == sets[0] | sets[2] and not sets[1] & (sets[0] | sets[2])


@given
def test_op13(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    same(QUERIES["op13_odd_sketch"](spark, SF).collect(), brute_more.set_groups(docs))
