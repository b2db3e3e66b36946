"""Factors of the substring parse: where their sources are, and how much of the given documents' duplicates they explain."""

from __future__ import annotations

import os
import random

import pytest

from hearthline.llm import lempel_ziv

from . import brute

SF = "/root/testdata/sf0.001"
r = random.Random(21)


def sentence(n):
    return [f"{r.choice('abcdefgh')}{r.randint(0, 4000)}" for _ in range(n)]


def told(df, texts, length=20):
    """Checks every factor against the corpus; returns the words in factors with a source, and all duplicate words."""
    corpus, places = [], {}
    for k, text in enumerate(texts):
        places[k] = len(corpus)
        corpus += brute.words(text)
    explained = duplicate = 0
    for row in lempel_ziv.parse(df, length, with_text=False).collect():
        own, covered = brute.words(texts[row.doc_id]), set()
        reached = 0
        for f in row.factors:
            assert f["last"] - f["first"] >= length
            if f["source"] is None:
                continue
            n = f["last"] - f["first"]
            assert corpus[f["source"] : f["source"] + n] == own[f["first"] : f["last"]]
            assert f["source"] < places[row.doc_id] + f["first"]
            assert f["last"] > reached
            reached = f["last"]
            covered |= set(range(f["first"], f["last"]))
        explained += len(covered)
        duplicate += row.n_removed
    return explained, duplicate


def test_factors_have_sources(spark):
    """A long passage, one put together of two sources, one with a changed word, a text that repeats itself, and copies of a copy."""
    a, b, c = sentence(300), sentence(200), sentence(90)
    changed = a[:60] + ["new"] + a[61:150]
    texts = [a, b, sentence(30) + a[40:140] + sentence(5), a[200:260] + b[20:90] + sentence(9), changed, c + c + c[:50], changed + b, sentence(50)]
    texts = [" ".join(t) for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    explained, duplicate = told(df, texts)
    assert explained > 0.99 * duplicate > 700


def test_greedy():
    import numpy as np

    first, end = np.array([0, 0, 5, 10, 12, 60, 61]), np.array([25, 30, 26, 50, 49, 90, 85])
    assert lempel_ziv.greedy(first, end) == [1, 3, 5]
    assert lempel_ziv.greedy(first[:0], end[:0]) == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="given tables are not here")
def test_factors_of_the_given_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    texts = [t for _, t in sorted(df.collect())]
    explained, duplicate = told(df, texts)
    assert explained > 0.95 * duplicate > 1000
