"""The pipeline stage by stage against brute force."""

from __future__ import annotations

import os
import random

import numpy as np
import pytest

import corpus_pipeline
from hearthline.session import settle

from . import brute

r = random.Random(12)


def sentence(n):
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(1, 7))) for _ in range(n))


def corpus():
    passage = sentence(60)
    texts = [sentence(r.randint(25, 200)) for _ in range(40)]
    texts += [texts[3], texts[3], texts[5] + " tail", texts[6].title()]
    texts += [f"{sentence(12)} {passage}\n{sentence(15)}" for _ in range(5)]
    texts += ["too short", None, "", "again " * 200, sentence(2500), "  \n"]
    texts += [f"notice to all\n{sentence(30)}" for _ in range(30)]
    return [(k, t, "en", "s0" if k % 3 else "s1", len(t or "")) for k, t in enumerate(texts)]


def followed(docs):
    """(id, text, source) after each of the first four stages."""
    judged = brute.quality([(d[3], d[1]) for d in docs])
    rows = [(d[0], j["clean_text"], d[3]) for d, j in zip(docs, judged, strict=True) if j["kept"]]
    yield rows
    prints = [brute.fingerprint(t) for _, t, _ in rows]
    rows = [row for k, (row, g) in enumerate(zip(rows, brute.groups(prints), strict=True)) if g == k]
    yield rows
    rows = [(i, brute.without(t, gone), s) for (i, t, s), gone in zip(rows, brute.duplicates([t for _, t, _ in rows]), strict=True)]
    yield rows
    n = brute.copies([(i, s, t) for i, t, s in rows])
    yield [row for row, k in zip(rows, n, strict=True) for _ in range(k)]


def test_stages(spark):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    columns, brief = df.columns, lambda rows: sorted(rows, key=str)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "simhash_dedup", "substring_dedup", "source_mix", "packing"]
    sizes = []
    for (name, stage), expected in zip(corpus_pipeline.STAGES, followed(docs), strict=False):
        df = settle(stage(spark, df, ""), name)
        assert df.columns == columns
        found = df.collect()
        assert brief((x.doc_id, x.text, x.source) for x in found) == brief(expected), name
        assert all(x.n_chars == len(x.text) for x in found)
        sizes.append(len(found))
    assert len(docs) > sizes[0] > sizes[1] == sizes[2] and len(sizes) == 4
    pieces = corpus_pipeline.STAGES[4][1](spark, df, "").collect()
    own, sequences = {}, {}
    for x in pieces:
        own.setdefault(x.doc_id, []).append((x.piece, x.start, np.frombuffer(x.ids, "<u4").tolist()))
        sequences.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for doc_id, text, _ in expected:
        ids = brute.ids_of("byte_bpe_50k.json", text)
        n = sum(i == doc_id for i, _, _ in expected)
        parts = sorted(own[doc_id])[::n]
        assert [i for _, _, p in parts for i in p] == ids and len(own[doc_id]) == n * -(-len(ids) // 1024)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024


def test_stages_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        df = settle(stage(spark, df, ""), name)
        assert df.count() == 0


def test_stages_keep_odd_rows(spark):
    """Null ids, sources and texts, repeated rows, a long text."""
    text, long = sentence(40), sentence(5000)
    rows = [(None, text, "en", None, None), (1, sentence(30), None, "s", 3), (1, sentence(30), "en", "s", 3), (2, None, "en", "s", 0), (3, long, "en", "s", 1)]
    df = spark.createDataFrame([*rows, rows[0], rows[4]], "doc_id long, text string, lang string, source string, n_chars long")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        df = settle(stage(spark, df, ""), name)
        if k in (0, 1, 2):
            assert df.count() == (6, 4, 4)[k], name
    assert df.count() > 0


SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="given tables are not here")
def test_run(spark):
    found = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(found.columns)
    assert found.count() > 50
