"""Copies of a document, as the mixing stage makes them, are spread over the pipeline's sequences."""

from __future__ import annotations

import os
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from hearthline.llm import exact_packing
from hearthline.llm.tokens import encoder

SHAPE = "doc_id long, text string, lang string, source string, n_chars long"
COPIES = 4


def test_copies_are_spread(spark):
    """300 documents of 256 ids, four copies each: four to a sequence, in random order."""
    docs = [(k, "a" + " a" * 254, "en", "s", 509) for k in range(300) for _ in range(COPIES)]
    df = spark.createDataFrame(docs, SHAPE).repartition(3)
    found = corpus_pipeline.packing(spark, df, "").collect()
    assert {x.length for x in found} == {256} and Counter(x.doc_id for x in found) == dict.fromkeys(range(300), COPIES)
    sequences = {}
    for x in found:
        sequences.setdefault(x.sequence_id, []).append(x.doc_id)
    assert len(sequences) == 300 and all(len(own) == 4 for own in sequences.values())
    # In random order 1200 pieces leave 300 * 6 * 3 / 1199 = 4.5 pairs of copies in a sequence; side by side they would be 1800.
    assert sum(n * (n - 1) // 2 for own in sequences.values() for n in Counter(own).values()) < 30
    assert [x for own in sequences.values() for x in sorted(own)] != sorted(x for own in sequences.values() for x in own)
    again = corpus_pipeline.packing(spark, df.repartition(5), "").collect()
    place = lambda rows: sorted((x.doc_id, x.sequence_id, x.offset) for x in rows)
    assert place(found) == place(again)


def test_odd_rows(spark):
    """Null ids, empty texts and repeated rows keep all their pieces."""
    rows = [(None, "", "en", "s", 0)] * 3 + [(1, None, "en", "s", 0)] * 2 + [(2, "a b", "en", "s", 3)]
    found = corpus_pipeline.packing(spark, spark.createDataFrame(rows, SHAPE), "").collect()
    assert Counter(x.doc_id for x in found) == {None: 3, 1: 2, 2: 1}
    assert len({(x.sequence_id, x.offset) for x in found}) == 6


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="given tables are not here")
def test_complements_of_the_given_table():
    """On the given documents, pairs and triples fill sequences exactly, and cost none against best fit."""
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column(0).combine_chunks()
    _, counts = encoder(public_tokenizers.path("byte_bpe_50k.json"), 2, True).encode(texts)
    sizes = exact_packing.cut(counts, 1024)[3]
    plan = exact_packing.packing_plan({int(k): int(n) for k, n in zip(*np.unique(sizes, return_counts=True), strict=True)}, 1024)
    used = {n: sum(times for line, times in plan if len(line) == n and sum(line) == 1024) for n in (2, 3, 4)}
    assert used[2] > 100 and used[3] > 10 and used[4] > 0
    total, limit = sum(times for _, times in plan), sum(times for _, times in exact_packing.best_fit(np.bincount(sizes, minlength=1025), 1024))
    assert total <= limit
