"""Lines that near copies share, in the pipeline's quality rules and in the registered query's."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from hearthline.llm import queries

SHAPE = "doc_id long, text string, lang string, source string, n_chars long"


def lines(r, n, size=10):
    return [" ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(3, 8))) for _ in range(size)) for _ in range(n)]


def changed(r, text, k):
    """The text with one word replaced in each of k lines."""
    out = list(text)
    for at in r.sample(range(len(out)), k):
        w = out[at].split()
        w[r.randrange(len(w))] = lines(r, 1, 1)[0]
        out[at] = " ".join(w)
    return "\n".join(out)


@pytest.fixture(params=["stage", "query"])
def kept(request, spark, tmp_path):
    def of_stage(pairs):
        return {x.doc_id: x.text for x in corpus_pipeline.quality_rules(spark, table(spark, pairs), "").collect()}

    def of_query(pairs):
        """The query returns no texts; those it keeps have lost the lines that it counts."""
        table(spark, pairs).write.parquet(str(tmp_path / "documents.parquet"))
        found = {x.doc_id: x for x in queries.op2_line_quality(spark, str(tmp_path)).collect()}
        texts = of_stage(pairs)
        assert {i for i, x in found.items() if x.kept} == set(texts)
        assert all(found[i].n_words_left == len(t.split()) for i, t in texts.items())
        return texts

    return {"stage": of_stage, "query": of_query}[request.param]


def table(spark, pairs):
    rows = [(k, t, "en", h, len(t)) for k, (h, t) in enumerate(pairs)]
    return spark.createDataFrame(rows, SHAPE).repartition(3)


def test_near_copies_survive(spark, kept):
    """A third of a host is near copies of one text; they stay whole, and one at least passes on to the next stage's result."""
    r = random.Random(3)
    base = lines(r, 8)
    pairs = [("h", changed(r, base, 1 + k % 2)) for k in range(300)] + [("h", "\n".join(lines(r, 8))) for _ in range(600)]
    found = kept(pairs)
    assert found == {k: t for k, (_, t) in enumerate(pairs)}
    df = spark.createDataFrame([(k, t, "en", "h", len(t)) for k, t in found.items()], SHAPE)
    assert any(x.doc_id < 300 for x in corpus_pipeline.simhash_dedup(spark, df, "").collect())


def test_common_lines_still_go(kept):
    """A line of many documents, and one of many groups of near copies, are removed; documents of little else are rejected."""
    r = random.Random(4)
    footer, menu = lines(r, 1)[0], lines(r, 9)
    pairs = [("h", "\n".join([*lines(r, 8), *menu])) for _ in range(60)]
    pairs += [("h", "\n".join([*menu, *lines(r, 1)])) for _ in range(40)]
    for _ in range(30):
        base = lines(r, 8)
        pairs += [("g", changed(r, base, 1) + "\n" + footer) for _ in range(25)]
    found = kept(pairs)
    assert set(found) == {*range(60), *range(100, len(pairs))}
    assert all(found[k] == "\n".join(pairs[k][1].split("\n")[:8]) for k in found if k < 60)
    assert all(found[k] == pairs[k][1].removesuffix("\n" + footer) for k in found if k >= 100)
