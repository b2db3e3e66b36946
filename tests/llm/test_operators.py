"""Every operator on small tables against brute force: nulls, empty and long texts, ties, repeated rows, no rows, clashing columns."""

from __future__ import annotations

import gzip
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from hearthline.llm import (
    bond_search, boosted_quality, exact_packing, lempel_ziv, line_quality, poisson_mix, simhash, token_planes, tree_sharding, warc_chunks,
)
from hearthline.session import opened

from . import brute

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
rng = random.Random(5)
PASSAGE = " ".join(f"w{i}" for i in range(70))
LONG = " ".join(rng.choice("alpha beta gamma delta, Epsilon zeta eta theta iota kappa".split()) for _ in range(9000))


def sentence(n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 7))) for _ in range(n))


BASE = [sentence(60) for _ in range(6)]
TEXTS = [
    *BASE, BASE[0], BASE[0], BASE[1] + " end", BASE[2].upper(), None, "", " \n\t ", "one", "One two", "one two three", LONG, LONG + " more",
    sentence(10) + " " + PASSAGE + " " + sentence(12), sentence(4) + "\n" + PASSAGE + "\n" + sentence(9), PASSAGE, PASSAGE + " " + PASSAGE,
    "same " * 100, "sym### bol$$ | < >\n" * 5, sentence(30) + "\n" + sentence(5) + "\n\n" + sentence(5), "<|endoftext|> it's “quoted” naïve",
]
CLASHES = "n_words copy shard fp score c0 c1 _row _fp _place _words _lines _host _source _group size place kept clean_text doc text_crc32 Slot".split()
SHAPE = "doc_id long, text string, source string, lang string, `a.b` int, " + ", ".join(f"`{c}` int" for c in CLASHES)


def rows_of(texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    return [(i, t, None if k % 5 == 4 else f"s{k % 3}", "en", k, *range(-len(CLASHES), 0)) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]


def unharmed(found, *results):
    """Columns that aren't results keep their values, whatever their names."""
    for r in found:
        for c, v in zip(CLASHES, range(-len(CLASHES), 0), strict=True):
            assert c.lower() in results or r[c] == v
    return found


@pytest.fixture(scope="module")
def docs(spark):
    ids = list(range(len(TEXTS)))
    return spark.createDataFrame(rows_of(TEXTS, ids), SHAPE).repartition(3)


@pytest.fixture(scope="module")
def odd(spark):
    """A null id, repeated ids and repeated rows."""
    rows = rows_of([BASE[0], PASSAGE, PASSAGE, None, LONG, BASE[3]], [None, 1, 1, 2, 3, 3])
    return spark.createDataFrame([*rows, rows[1], rows[4]], SHAPE).repartition(2)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SHAPE)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4"))


# 1


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_token_planes(docs, kind):
    manifest = token_planes.write_ids(docs, WORD_BPE, planes=kind, block=1000)
    found = token_planes.read_ids(manifest, with_ids=True).collect()
    start = 0
    for row, text in zip(sorted(found), TEXTS, strict=True):
        ids = brute.ids_of("word_bpe_49k.json", text)
        assert (row.start, row.n_tokens, row.ids_crc32, row.ids) == (start, len(ids), crc(ids), ids)
        start += len(ids)
    assert sum(r.n_ids for r in manifest.collect()) == start


def test_token_planes_odd(odd, none):
    found = token_planes.read_ids(token_planes.write_ids(odd, WORD_BPE)).collect()
    assert len(found) == 8 and sorted(r.doc_id for r in found if r.doc_id is not None) == [1, 1, 1, 2, 3, 3, 3]
    order = sorted(found, key=lambda r: r.start)
    assert [r.doc_id for r in order] == [None, 1, 1, 1, 2, 3, 3, 3]
    assert [r.start for r in order] == np.cumsum([0, *(r.n_tokens for r in order[:-1])]).tolist()
    assert token_planes.read_ids(token_planes.write_ids(none, WORD_BPE)).collect() == []


# 2


def host_docs(n=45):
    """One host whose documents share a line, another with few documents."""
    out = [("h", f"{sentence(25)}\nShared LINE {k} of 9\n{sentence(3)}") for k in range(n)]
    out += [("h", f"shared line {k}{k} of 0\n" * 2 + "  SHARED line 7 of 7\t") for k in range(3)]
    out += [("h", "\n".join([*(f"shared line {10 + k} of {k + 1}" for k in range(9)), sentence(10)]))]
    return [*out, ("few", "shared line 1 of 0\n" + sentence(25)), (None, sentence(22)), ("h", None), (None, None), ("h", "")]


@pytest.mark.parametrize("limits", [line_quality.Limits(), line_quality.Limits(share=0.5, least=3, min_words=4, min_left=0.6)])
def test_line_quality(spark, limits):
    pairs = host_docs()
    pairs += [pairs[0]] * 30  # copies aren't further documents
    df = spark.createDataFrame([(k, h, t, k, "z") for k, (h, t) in enumerate(pairs)], "doc_id long, source string, text string, n_words int, kept string")
    found = sorted(line_quality.judge(df, limits=limits).collect(), key=lambda r: r.doc_id)
    expected = brute.quality(pairs, limits.share, limits.least, limits.min_words, limits.min_left, limits.max_repeat_pct)
    assert len(found) == len(pairs)
    for row, e in zip(found, expected, strict=True):
        assert {k: row[k] for k in e} == e
    assert any(e["n_lines_removed"] for e in expected) and any(not e["kept"] and not e["base_failed"] for e in expected)
    stay = sorted(line_quality.accepted(df, limits=limits).collect(), key=lambda r: r.doc_id)
    assert [(r.doc_id, r.text) for r in stay] == [(k, e["clean_text"]) for k, e in enumerate(expected) if e["kept"]]
    assert line_quality.accepted(df).columns == df.columns


def test_line_quality_other(docs, odd, none):
    found = {r.doc_id: r for r in unharmed(line_quality.judge(docs).collect(), *line_quality.STATISTICS, "clean_text")}
    for k, e in enumerate(brute.quality([("h", t) for t in TEXTS])):
        assert {c: found[k][c] for c in e} == e
    assert unharmed(line_quality.accepted(docs).collect()) and line_quality.accepted(docs).columns == docs.columns
    assert line_quality.judge(odd).count() == 8
    assert line_quality.judge(none).collect() == []


def test_line_keys_agree(spark):
    lines = ["", " A1b ", "\tÉ 907", "x\x0c", "日本 Z9"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    from pyspark.sql import functions as F

    found = df.select(F.xxhash64(line_quality.normalised(F.col("line"))).alias("h")).collect()
    assert [r.h for r in found] == [line_quality.line_key(x.encode()) for x in lines]


# 3


def check_packing(found, texts, full=1024):
    pieces, sequences = {}, {}
    for r in found:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for k, text in enumerate(texts):
        ids = brute.ids_of("byte_bpe_50k.json", text)
        own = sorted(pieces[k], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(ids) // full)))
        at = 0
        for r in own:
            part = ids[at : at + r.length]
            assert (r.start, r.ids_crc32) == (at, crc(part)) and np.frombuffer(r.ids, "<u4").tolist() == part
            assert r.length == full or r.piece == 0
            at += r.length
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= full
    return len(sequences)


def test_packing(docs, none):
    found = exact_packing.pack_documents(docs, BYTE_BPE).collect()
    n = check_packing(found, TEXTS)
    assert n == -(-sum(r.length for r in found) // 1024)
    assert exact_packing.pack_documents(none, BYTE_BPE).collect() == []


def test_packing_odd(odd):
    found = exact_packing.pack_documents(odd, BYTE_BPE).collect()
    places = {(r.sequence_id, r.offset) for r in found}
    assert len(places) == len(found)
    assert sum(r.doc_id is None for r in found) == 1


# 4


def page_rows():
    big = "ä" * 700
    huge = "".join(rng.choice("abcdef\r\n ") for _ in range(300_000))
    bodies = [big, big, "small", "small", None, "", "x" * 999, "y" * 1000, "y" * 1000, huge, huge, big, "\r\n\r\nWARC/1.1\r\n\r\n" * 90]
    return [(k, None if k == 2 else f"http://h/é?{k}", b) for k, b in enumerate(bodies)]


def expected_page(rows, page, body):
    payload = (body or "").encode()
    same = [p for p, _, b in rows if (b or "").encode() == payload and p is not None]
    revisit = len(payload) >= 1000 and bool(same) and page != max(same)
    return (page, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", max(same) if revisit else None)


@pytest.mark.parametrize("chunk", [100, 1 << 16])
def test_archives(spark, chunk):
    rows = page_rows()
    df = spark.createDataFrame([(*r, 1, "d") for r in rows], "page_id long, url string, html string, chunk int, digest string").repartition(2)
    manifest = warc_chunks.write_archives(warc_chunks.chunk_rows(warc_chunks.dedup_plan(df), chunk))
    found = warc_chunks.read_archives(manifest, chunk).collect()
    whole = {}
    for r in sorted(found, key=lambda r: (r.page_id, r.chunk)):
        assert len(r.data) <= chunk
        if r.record_type == "response":
            whole[r.page_id] = whole.get(r.page_id, b"") + r.data
            assert (r.payload_bytes, r.payload_digest) == (len(whole[r.page_id]), hashlib.sha1(whole[r.page_id]).hexdigest())
    ends = {r.page_id: (r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found if r.last}
    assert ends == {r[0]: expected_page(rows, r[0], r[2]) for r in rows}
    assert all(whole[p] == (b or "").encode() for p, _, b in rows if p in whole)
    assert {r.page_id: r.url for r in found} == {p: u for p, u, _ in rows}
    assert sum(r.records for r in manifest.collect()) == len(rows)


def test_archives_are_plain_gzip(spark):
    df = spark.createDataFrame(page_rows(), "page_id long, url string, html string").coalesce(1)
    (file,) = [r.file for r in warc_chunks.archive(df).collect()]
    store, place = opened(file)
    with store.open_input_stream(place, compression=None) as source:
        assert gzip.decompress(source.read()).startswith(b"WARC/1.1\r\nWARC-Type: re")


def test_archives_odd(spark):
    body = "z" * 2000
    rows = [(None, None, body), (3, "u", body), (3, "u", body), (1, "a\r\nb", body), (None, None, "q" * 2000), (None, None, "q" * 2000), (None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = warc_chunks.read_archives(warc_chunks.archive(df), with_data=False).where("last").collect()
    got = sorted((r.page_id or -1, r.payload_bytes, r.record_type, r.refers_to or -1) for r in found)
    assert got == sorted(
        [(-1, 2000, "revisit", 3), (3, 2000, "response", -1), (3, 2000, "response", -1), (1, 2000, "revisit", 3)]
        + [(-1, 2000, "response", -1)] * 2 + [(-1, 0, "response", -1)]
    )
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc_chunks.read_archives(warc_chunks.archive(empty)).collect() == []


def test_broken_archives_are_noticed():
    import io

    row = {"record_type": "response", "page_id": 1, "refers_to": None, "url": "u", "digest": hashlib.sha1(b"abc").hexdigest(), "payload_bytes": 3}
    for data, fault in ((b"abd\r\n\r\n", "digest"), (b"ab", "within a record")):
        with pytest.raises(ValueError, match=fault):
            list(warc_chunks.archived(io.BytesIO(gzip.compress(warc_chunks.header(row) + data))))


# 5


def check_spans(df, texts, length=20):
    found = sorted(lempel_ziv.parse(df, length).collect(), key=lambda r: r.doc_id)
    for row, text, gone in zip(found, texts, brute.duplicates(texts, length), strict=True):
        assert (row.n_words, row.n_removed, row.kept_sha256) == (len(gone), sum(gone), brute.kept_sha256(text, gone)), row.doc_id
        assert row.clean_text == brute.without(text, gone)
        covered = [False] * len(gone)
        for f in row.factors:
            assert f["last"] - f["first"] >= length
            covered[f["first"] : f["last"]] = [True] * (f["last"] - f["first"])
        assert covered == gone


def test_spans(docs, none):
    check_spans(docs, TEXTS)
    assert lempel_ziv.parse(none).collect() == []
    unharmed(lempel_ziv.parse(docs).collect(), "n_words", "clean_text")
    assert lempel_ziv.without_duplicates(docs).columns == docs.columns and unharmed(lempel_ziv.without_duplicates(docs).collect())


@pytest.mark.parametrize("length", [9, 20])
def test_spans_across_borders(spark, length):
    """Windows that two earlier texts hold in part, and a third one whole; many short repeats over few words."""
    a, b = [f"a{i}" for i in range(60)], [f"b{i}" for i in range(60)]
    texts = [" ".join(a), " ".join(b), " ".join(a[30:] + b[:30]), " ".join(a[:40] + b[:25]), " ".join(a[20:] + b), "x " * 50 + "y " * 30]
    texts += [" ".join(rng.choice("pqr") for _ in range(200)) for _ in range(6)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    check_spans(df, texts, length)


def test_spans_odd(odd):
    found = lempel_ziv.parse(odd).collect()
    assert len(found) == 8
    assert sorted(r.n_removed for r in found if r.doc_id == 1) == [0, 70, 70]
    kept = [r for r in found if r.doc_id == 3 and r.n_words == 9000]
    assert sorted(r.n_removed for r in kept) == sorted([sum(brute.duplicates([LONG])[0]), 9000])


# 6


@pytest.mark.parametrize("weights,epochs", [(None, 1.0), ({"s0": 3.0, "s1": 1.0}, 2.0), ({"s0": 1.0}, 60.0), ({}, 1.0)])
def test_mix(docs, weights, epochs):
    found = unharmed(poisson_mix.mix(docs, weights, epochs=epochs).collect(), "copy")
    rows = docs.collect()
    expected = dict(zip((r.doc_id for r in rows), brute.copies([(r.doc_id, r.source, r.text) for r in rows], weights, epochs=epochs), strict=True))
    counts = {}
    for r in found:
        counts.setdefault(r.doc_id, []).append(r.copy)
        assert r["a.b"] == r.doc_id and r.text == TEXTS[r.doc_id]
    assert {k: len(v) for k, v in counts.items()} == {k: n for k, n in expected.items() if n}
    assert all(sorted(v) == list(range(len(v))) for v in counts.values())
    assert len({r.shuffle_key for r in found}) == len(found)


def test_mix_reaches_target_weights(spark):
    rows = [(k, "big" if k % 10 else "small", "x" * 99) for k in range(20_000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    found = {r.source: r["count"] for r in poisson_mix.mix(df, {"big": 1.0, "small": 1.0}).groupBy("source").count().collect()}
    assert abs(found["big"] - 10_000) < 400 and abs(found["small"] - 10_000) < 400


def test_mix_odd(odd, none):
    assert poisson_mix.mix(none).collect() == []
    found = poisson_mix.mix(odd, epochs=5.0).collect()
    n = {}
    for r in found:
        n[r.doc_id, r.text, r.source] = n.get((r.doc_id, r.text, r.source), 0) + 1
    assert n and all(k in {(r.doc_id, r.text, r.source) for r in odd.collect()} for k in n)


def test_mix_is_native(docs):
    plan = poisson_mix.mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(bad in plan for bad in ("Python", "Pandas", "Arrow", "NestedLoop", "Cartesian"))


# 7


def vectors():
    r = np.random.default_rng(2)
    out = [(k, [float(x) for x in r.normal(size=8) * r.choice([0.1, 1.0])]) for k in range(230)]
    out[3] = (3, out[2][1])
    out[100] = (100, out[99][1])
    out[205] = (205, None)
    return [*out, (300, [float("nan")] * 8), (301, [1.0] * 7 + [None]), (400, []), (500, [1.0, 2.0, 3.0]), (501, [1.0, 1.0, 1.0]), (None, [1.0] * 8),
            (600, [float("inf")] * 8), (200, out[200][1])]


def test_search(spark):
    rows = vectors()
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, score int").repartition(3)
    from pyspark.sql import functions as F

    usable = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in rows
              if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    expected = []
    for n, (q, a) in enumerate(usable):
        if q % 100 == 0:
            hits = sorted((-sum(map(int.__mul__, a, b)), i) for m, (i, b) in enumerate(usable) if m != n and len(a) == len(b))
            expected += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(hits[:10])]
    found = bond_search.search(df, F.col("id") % 100 == 0, 10).collect()
    assert sorted(map(tuple, found)) == sorted(expected)
    empty = spark.createDataFrame([], df.schema)
    assert bond_search.search(empty, F.col("id") % 100 == 0).collect() == []
    assert bond_search.search(df, F.col("id") < 0).collect() == []


# 8


def test_quality_classifier(spark):
    good = [f"{sentence(20).capitalize()}.\n{sentence(12)}." for _ in range(300)]
    bad = [" | ".join(sentence(14).split()) for _ in range(60)] + ["again " * rng.randint(9, 60) for _ in range(60)]
    texts = [*good, *bad, None, ""]
    ids = list(range(len(texts)))
    df = spark.createDataFrame(rows_of(texts, ids), SHAPE)
    labels = [(i, int(i < 300)) for i in ids[:-2]] + [(None, 0), (5, None), (10**6, 0)]
    known = spark.createDataFrame([(*x, "q") for x in labels], "doc_id long, quality int, stats string")
    found = {r.doc_id: r for r in boosted_quality.classify(df, known).collect()}
    assert len(found) == len(texts)
    for i, r in found.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for i, r in found.items() if r.held_out and i < 420]
    assert sum(r.predicted == int(r.doc_id < 300) for r in held) / len(held) > 0.97
    # Held-out labels play no part.
    flipped = spark.createDataFrame([(i, (1 - q) if q is not None and found.get(i) and found[i].held_out else q, "q") for i, q in labels], known.schema)
    assert {r.doc_id: r.score for r in boosted_quality.classify(df, flipped).collect()} == {i: r.score for i, r in found.items()}


def test_quality_classifier_odd(spark, odd, none):
    no_labels = spark.createDataFrame([], "doc_id long, quality int")
    found = boosted_quality.classify(odd, no_labels).collect()
    assert len(found) == 8 and {r.score for r in found} == {0.5} and not any(r.held_out for r in found if r.doc_id is None)
    assert boosted_quality.classify(none, no_labels).collect() == []


# 9


@pytest.mark.parametrize("wide", [256, 1])
def test_simhash(docs, wide):
    found = sorted(simhash.grouped(docs, wide=wide).collect())
    prints = [brute.fingerprint(t) for t in TEXTS]
    assert [r.fp % 2**64 for r in found] == prints
    assert [r.component_id for r in found] == brute.groups(prints)


@pytest.mark.parametrize("wide", [10**6, 30, 2])
def test_links_connect_chains(spark, wide):
    r = random.Random(8)
    prints = [r.getrandbits(64) for _ in range(60)]
    for _ in range(340):
        base = r.choice(prints)
        for _ in range(r.choice([1, 1, 2, 3])):
            base ^= 1 << r.randrange(64)
        prints.append(base)
    prints = list(dict.fromkeys(prints))
    df = spark.createDataFrame([(simhash.signed(p),) for p in prints], "fp long")
    roots = {x.node: x.root for x in simhash.components(simhash.links(df, 2, wide)).collect()}
    label = [roots.get(simhash.signed(p), simhash.signed(p)) for p in prints]
    expected = brute.groups(prints)
    assert len({*zip(label, expected, strict=True)}) == len(set(label)) == len(set(expected))


def test_simhash_keeps_one(docs, odd, none):
    stay = sorted(r.doc_id for r in simhash.one_of_each(docs).collect())
    prints = [brute.fingerprint(t) for t in TEXTS]
    assert stay == sorted(set(brute.groups(prints)))
    assert simhash.one_of_each(docs).columns == docs.columns and unharmed(simhash.one_of_each(docs).collect())
    texts = sorted(str(r.text)[:9] for r in simhash.one_of_each(odd).collect())
    assert len(texts) == 5
    assert simhash.one_of_each(none).collect() == [] and simhash.grouped(none).collect() == []
    found = simhash.grouped(odd).collect()
    assert len(found) == 8 and [r.component_id for r in found if r.doc_id is None] == [None]


# 10


def check_shards(found, texts, shards):
    load, slots, homes = [0] * shards, {}, {}
    for r in found:
        raw = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        load[r.shard] += r["size"]
        slots.setdefault(r.shard, []).append((r.slot, r.doc_id))
        assert homes.setdefault(raw, r.shard) == r.shard
    for own in slots.values():
        assert [s for s, _ in sorted(own)] == list(range(len(own))) and [d for _, d in sorted(own)] == sorted(d for _, d in own)
    return load


def test_shards(spark, docs, none):
    check_shards(unharmed(tree_sharding.shard(docs, 4).collect(), "size", "text_crc32", "shard", "slot"), TEXTS, 4)
    texts = [sentence(rng.randint(1, 40)) for _ in range(700)] + ["copy " * 9] * 300 + [LONG * 3]
    df = spark.createDataFrame(rows_of(texts), SHAPE).repartition(4)
    load = check_shards(tree_sharding.shard(df, 5, payload=[]).collect(), texts, 5)
    rest = sorted(load)[:-1]  # one group is larger than an even share
    assert max(load) == 3 * len(LONG) + 1 and rest[-1] - rest[0] < 20
    assert tree_sharding.shard(none, 4).collect() == []
    assert "a.b" in tree_sharding.shard(docs, 4).columns


def test_shards_of_a_capacity(docs):
    found = tree_sharding.shard(docs, capacity=4000).collect()
    load = check_shards(found, TEXTS, 1 + max(r.shard for r in found))
    assert all(n <= 4000 or sum(r.shard == k for r in found) == 1 for k, n in enumerate(load))


def test_shards_odd(odd):
    found = tree_sharding.shard(odd, 3).collect()
    assert len(found) == 8 and len({(r.shard, r.slot) for r in found}) == 8


def test_planned_sizes(spark):
    from pyspark.sql import functions as F

    sizes = [1, 65535, 65536, 65537, 131071, 131072, 1 << 30, (1 << 30) + 1, (1 << 40) + 12345]
    df = spark.createDataFrame([(s,) for s in sizes], "s long")
    found = [r.p for r in df.select(tree_sharding.planned_size(F.col("s")).alias("p")).collect()]
    assert all(s <= p <= s * 1.001 for s, p in zip(sizes, found, strict=True)) and found[:3] == sizes[:3]
