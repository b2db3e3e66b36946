"""SimHash groups of odd tables."""

from __future__ import annotations

import random

import pytest

from hearthline.llm import simhash

from . import brute

SHAPE = "doc_id long, text string, fp int, root string, `a.b` int"


def test_groups_of_odd_rows(spark):
    """Null ids and texts, empty texts, repeated rows, one long text, equal texts in other letters."""
    long = " ".join(f"v{i}" for i in range(8000))
    rows = [(3, "One two three four"), (1, "one TWO three four"), (None, "one two three four"), (None, "only here and null"), (None, None), (7, None), (5, ""), (6, " \n"), (9, long), (9, long)]
    df = spark.createDataFrame([(*r, 1, "r", 2) for r in rows], SHAPE).repartition(3)
    found = sorted(simhash.grouped(df, 3, 2).collect(), key=str)
    prints = [brute.fingerprint(t) for _, t in rows]
    groups = brute.groups(prints)
    least = {g: min((i for (i, _), h in zip(rows, groups, strict=True) if h == g and i is not None), default=None) for g in groups}
    expected = [(i, p - (1 << 64) if p >> 63 else p, least[g]) for (i, _), p, g in zip(rows, prints, groups, strict=True)]
    assert sorted(((r.doc_id, r.fp, r.component_id) for r in found), key=str) == sorted(expected, key=str)


def test_groups_of_nothing(spark):
    found = simhash.grouped(spark.createDataFrame([], SHAPE))
    assert found.collect() == [] and found.columns == ["doc_id", "fp", "root", "component_id"]


@pytest.mark.parametrize("k", [1, 2, 3])
def test_wide_buckets_of_any_distance(spark, k):
    """Clouds of near fingerprints, pair by pair and through the values between them: the same groups as by brute force."""
    r = random.Random(k)
    prints = set()
    for _ in range(6):
        base = r.getrandbits(64)
        for _ in range(25):
            near = base
            for _ in range(r.randint(0, k + 1)):
                near ^= 1 << r.randrange(64)
            prints.add(near)
    prints = sorted(simhash.signed(p) for p in prints)
    expected = brute.groups([p % (1 << 64) for p in prints], k)
    distinct = spark.createDataFrame([(p,) for p in prints], "fp long").repartition(2)
    for wide in (1, 1000):
        roots = {x.node: x.root for x in simhash.components(simhash.links(distinct, k, wide)).collect()}
        assert [roots.get(p, p) for p in prints] == [min(q for q, h in zip(prints, expected, strict=True) if h == g) for g in expected]
