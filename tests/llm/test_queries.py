"""The registered queries over whole given tables: against their reference SQL, or brute force where there is none."""

from __future__ import annotations

import os
import sys
import zlib

import numpy as np
import pytest

import __spark_entry__
from hearthline.llm.queries import QUERIES
from hearthline.llm.sql import SQL

from . import brute

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from compare import connect, differences  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.fixture(scope="module")
def docs(con):
    return con.execute("select doc_id, text from documents order by doc_id").fetchall()


def test_all_are_registered():
    names = __spark_entry__.queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(names) and set(SQL) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", SQL)
def test_reference_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, SQL[name]) == []


def test_op1(spark, docs):
    start = 0
    for row, (doc, text) in zip(sorted(QUERIES["op1_token_planes"](spark, SF).collect()), docs, strict=True):
        ids = brute.ids_of("word_bpe_49k.json", text)
        assert tuple(row) == (doc, start, len(ids), zlib.crc32(np.array(ids, "<u4")))
        start += len(ids)


def test_op3(spark, docs):
    found = QUERIES["op3_exact_packing"](spark, SF).collect()
    ids = {doc: brute.ids_of("byte_bpe_50k.json", text) for doc, text in docs}
    assert sum(r.length for r in found) == sum(map(len, ids.values()))
    used = {}
    for r in found:
        assert zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")) == r.ids_crc32
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in used.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 1024


def test_op8(spark, con, docs):
    found = {r.doc_id: r for r in QUERIES["op8_boosted_quality"](spark, SF).collect()}
    assert sorted(found) == [d for d, _ in docs]
    held = [(found[i], q) for i, q in con.execute("select doc_id, quality from labels").fetchall() if found[i].held_out]
    assert sum(r.predicted == q for r, q in held) / len(held) > 0.85


def test_op9(spark, docs):
    found = sorted(QUERIES["op9_simhash"](spark, SF).collect())
    prints = [brute.fingerprint(t) for _, t in docs]
    groups = brute.groups(prints)
    assert [tuple(r) for r in found] == [(d, f"{p:016x}", docs[g][0]) for (d, _), p, g in zip(docs, prints, groups, strict=True)]


def test_op10(spark, docs):
    found = QUERIES["op10_tree_sharding"](spark, SF).collect()
    texts = dict(docs)
    load, home, slots = [0] * 16, {}, {}
    for r in found:
        raw = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        assert home.setdefault(raw, r.shard) == r.shard
        load[r.shard] += r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(found) == len(docs) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(load) - min(load) < 0.05 * sum(load) / 16
