"""Array code against plain Python, without Spark."""

from __future__ import annotations

import io
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hearthline.llm import bond_search, boosted_quality, exact_packing, line_quality, simhash, tree_sharding
from hearthline.llm.token_planes import PlaneReader, PlaneWriter, from_planes, to_planes
from hearthline.llm.tokens import TextEncoder
from hearthline.llm.words import Words, fits, gram_hashes, lowest_of

from . import brute

PARTS = [
    "a", "B", "é", "é", "'", "'s", "'ll", " ", "  ", "\n", "\t", "\r\n", " ", " ", "　", ".", ",", "!!", "—", "»", "1", "23",
    "½", "<|endoftext|>", "word", "The", "\x1c", "\x85", "̸", "<", "日本", "_", "😀", "à", "Σ", "İ",
]
TEXTS = st.lists(st.one_of(st.none(), st.lists(st.sampled_from(PARTS), max_size=40).map("".join)), max_size=8)


@given(TEXTS)
def test_words(texts):
    found = Words.of(pa.array(texts, pa.string()))
    data = found.content.tobytes()
    own = [data[a:b].decode() for a, b in zip(found.starts, found.ends, strict=True)]
    assert own == [w for t in texts for w in brute.words(t)]
    assert found.counts().tolist() == [len(brute.words(t)) for t in texts]
    codes, distinct = found.coded()
    assert [distinct[c].as_py().decode() for c in codes] == own


@pytest.fixture(scope="module", params=[("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def coder(request):
    name, spaced = request.param
    return name, TextEncoder(public_tokenizers.path(name), 2, spaced)


@settings(deadline=None, max_examples=200)
@given(texts=TEXTS)
def test_pieces_encode_like_whole_texts(coder, texts):
    name, encoder = coder
    ids, counts = encoder.encode(pa.array(texts, pa.string()))
    expected = [brute.ids_of(name, t) for t in texts]
    assert counts.tolist() == [len(e) for e in expected]
    assert ids.tolist() == [i for e in expected for i in e]


def test_encoder_drops_pieces(coder, monkeypatch):
    """Few pieces are kept, and those used again survive, until they are too many."""
    monkeypatch.setattr("hearthline.llm.tokens.KEPT_PIECES", 6)
    monkeypatch.setattr("hearthline.llm.tokens.AT_ONCE", 2)
    name, encoder = coder
    encoder.forget()
    kept = []
    for text in ("one two three, four five", "two one nine", "six seven eight", "ten one", "one two three four five six", "one two three four five six", "zero"):
        assert encoder.encode(pa.array([text]))[0].tolist() == brute.ids_of(name, text)
        kept.append(len(encoder.known))
    assert max(kept) <= 14 and any(b < a for a, b in zip(kept, kept[1:], strict=False))


@pytest.mark.parametrize("kind", ["byte", "bit"])
@given(ids=st.lists(st.integers(0, 2**32 - 1), max_size=70))
def test_planes(kind, ids):
    ids = np.array(ids, np.uint32)
    assert from_planes(to_planes(ids, kind), len(ids), kind).tolist() == ids.tolist()


@pytest.mark.parametrize("kind", ["byte", "bit"])
@pytest.mark.parametrize("sizes", [[1], [7, 1, 30, 2], [10, 10], [64]])
def test_plane_file(kind, sizes):
    rng = np.random.default_rng(1)
    parts = [rng.integers(0, 50_000, n).astype(np.uint32) for n in sizes]
    out = io.BytesIO()
    writer = PlaneWriter(out, kind, block=10)
    for k, ids in enumerate(parts):
        writer.add(ids, pa.RecordBatch.from_arrays([pa.array([k]), pa.array([len(ids)])], ["doc", "n"]))
    writer.close()
    reader = PlaneReader(pa.BufferReader(out.getvalue()))
    every = np.concatenate(parts)
    assert reader.documents().to_pydict() == {"doc": list(range(len(sizes))), "n": sizes}
    assert len(reader.footer["chunks"]) == -(-len(every) // 10)
    for a, b in ((0, len(every)), (0, 1), (len(every) // 2, len(every)), (3, min(25, len(every)))):
        assert (np.concatenate([*reader.ids(a, b), np.zeros(0, "<u4")]) == every[a:b]).all()
    with pytest.raises(ValueError, match="not a file"):
        PlaneReader(pa.BufferReader(b"x" * 40))


@given(st.lists(st.integers(0, 5), max_size=40), st.integers(1, 9))
def test_lowest_of(values, width):
    found = lowest_of(np.array(values, np.uint64), width)
    n = len(values) - width + 1
    assert found.tolist() == [i + min(range(width), key=lambda j: (values[i + j], j)) for i in range(n)] if n > 0 else not len(found)


def test_gram_hashes_tell_order_and_content():
    w = Words.of(pa.array(["a b c d", "b a c d", "a b c d e", None, ""]))
    h = gram_hashes(w.hashes(), 3)
    ok = fits(w.first, 3, len(h))
    grams = [tuple(x) for x in ("abc", "bcd", "bac", "acd", "abc", "bcd", "cde")]
    own = h[ok].tolist()
    assert len(own) == len(grams) and [own[i] == own[j] for i in range(7) for j in range(7)] == [a == b for a in grams for b in grams]


@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from("ab c".split()), max_size=40).map(" ".join)), max_size=5))
def test_repeat_words(texts):
    found = line_quality.repeat_words(Words.of(pa.array(texts, pa.string())))
    assert found.tolist() == [q["n_repeat_words"] for q in brute.quality([(None, t) for t in texts])]


@given(TEXTS)
def test_fingerprints(texts):
    found = simhash.fingerprints(pa.array(texts, pa.string()), 3)
    assert found.tolist() == [brute.fingerprint(t) for t in texts]


def test_close_fingerprints_share_three_blocks():
    masks = simhash.block_masks(2)
    rng = random.Random(3)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
        assert any(a & m == b & m for m in masks)
    assert min(m.bit_count() for m in masks) >= 38


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(1, 24), max_size=80))
def test_packing_plan(lengths):
    full = 24
    counts = {n: lengths.count(n) for n in set(lengths)}
    plan = exact_packing.packing_plan(counts, full)
    used = {}
    for line, times in plan:
        assert sum(line) <= full and times > 0
        for n in line:
            used[n] = used.get(n, 0) + times
    assert used == counts
    n_sequences = sum(times for _, times in plan)
    assert n_sequences >= -(-sum(lengths) // full)
    left = np.bincount(np.array(lengths, int), minlength=full + 1)
    assert n_sequences <= sum(times for _, times in exact_packing.best_fit(left, full))
    # Every piece has one place, and sequences are gapless.
    places = {}
    for length, first, last, sequence, offsets in exact_packing.plan_rows(plan):
        for rank in range(first, last):
            at = rank - first
            places[length, rank] = (sequence + at // len(offsets), offsets[at % len(offsets)])
    assert len(places) == len(lengths)
    filled = {}
    for (length, _), (sequence, offset) in places.items():
        filled.setdefault(sequence, []).append((offset, length))
    assert len(filled) == n_sequences
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length


def test_exact_complements_come_first():
    index = exact_packing.SumIndex(np.bincount([10, 6, 4, 3, 3, 2, 1], minlength=11))
    assert index.complement(6, 10, 3) == (4,)
    assert index.complement(4, 10, 3) == (3, 3)
    assert index.complement(6, 11, 3) == (4, 1)
    assert index.complement(4, 12, 3) == (3, 3, 2)
    assert index.complement(3, 10, 2) is None


def test_cut():
    doc, piece, start, size = exact_packing.cut(np.array([1, 8, 9, 20]), 8)
    assert list(zip(doc.tolist(), piece.tolist(), start.tolist(), size.tolist(), strict=True)) == [
        (0, 0, 0, 1), (1, 0, 0, 8), (2, 0, 0, 1), (2, 1, 1, 8), (3, 0, 0, 4), (3, 1, 4, 8), (3, 2, 12, 8),
    ]


@given(st.lists(st.tuples(st.booleans(), st.integers(0, 30)), max_size=200))
def test_tree(steps):
    tree, kept = tree_sharding.Tree(), set()

    def height(node):
        return 0 if node is None else 1 + max(height(node.left), height(node.right))

    for add, key in steps:
        if add and key not in kept:
            tree.add(key)
            kept.add(key)
        elif not add and key in kept:
            tree.drop(key)
            kept.discard(key)
        for k in (0, 11, 29):
            assert tree.ceiling(k) == min((x for x in kept if x >= k), default=None)
        assert height(tree.root) <= 2 * (len(kept) + 1).bit_length()


@given(st.lists(st.integers(1, 40), max_size=60), st.integers(10, 50))
def test_best_fit_decreasing(sizes, capacity):
    """In bulk as one by one."""
    rooms, expected = [], []
    for s in sorted(sizes, reverse=True):
        fit = min((r, i) for r, i in [*((r, i) for i, r in enumerate(rooms) if r >= s), (10**9, -1)])
        if fit[1] < 0:
            rooms.append(max(capacity, s))
            fit = (rooms[-1], len(rooms) - 1)
        rooms[fit[1]] -= s
        expected.append((s, fit[1]))
    counts = sorted(((s, sizes.count(s)) for s in set(sizes)), reverse=True)
    found = [(s, shard) for s, a, b, shard in tree_sharding.best_fit_decreasing(counts, capacity) for _ in range(b - a)]
    assert sorted(found) == sorted(expected)


@given(st.lists(st.integers(1, 300), max_size=60), st.integers(1, 6))
def test_balanced_plan(sizes, shards):
    counts = {s: sizes.count(s) for s in set(sizes)}
    plan = tree_sharding.balanced_plan(counts, shards)
    ranks = {}
    load = [0] * shards
    for size, a, b, shard in plan:
        assert ranks.get(size, 0) == a < b
        ranks[size] = b
        load[shard] += size * (b - a)
    assert ranks == counts
    if sizes:
        largest = max(sizes)
        assert max(load) <= max(largest, -(-sum(sizes) // shards) + 2 * largest)


@settings(deadline=None, max_examples=40)
@given(st.integers(1, 40), st.integers(1, 30), st.integers(1, 5), st.integers(0, 2**20))
def test_branch_and_bound(dim, n, k, seed):
    rng = np.random.default_rng(seed)
    rows = np.floor(1024 * rng.normal(size=(dim, n)) * rng.choice([0.01, 1], n)).astype(np.int64)
    queries = rows[:, : min(3, n)]
    exact = queries.T @ rows
    block = bond_search.Rows(rows, np.float64 if seed % 2 else np.int64)
    for j in range(queries.shape[1]):
        limit = np.sort(np.delete(exact[j], j))[::-1][:k]
        for before in (-np.inf, float(limit[-1]) if len(limit) == k else -np.inf):
            alive, score, after = bond_search.best(queries[:, j], block, k, j, before)
            assert (score == exact[j, alive]).all() and j not in alive
            assert after == (limit[-1] if len(limit) == k else -np.inf)
            if len(limit):
                assert set(np.flatnonzero(exact[j] >= limit[-1])) - {j} <= set(alive.tolist())


def test_scores_beyond_a_long():
    big = np.array([[2**62], [2**62]], np.int64)
    alive, score = bond_search.dense(big[:, 0], big, None)
    assert alive.tolist() == [0] and score.tolist() == [2**63 - 1]


def kept_share(rows, places, k):
    block = bond_search.Rows(rows, np.float64)
    return np.mean([len(bond_search.best(rows[:, j], block, k, j)[0]) for j in places]) / rows.shape[1]


def test_bounds_drop_rows():
    rng = np.random.default_rng(0)
    rows = np.floor(1024 * rng.normal(size=(64, 2000)) * np.exp(-np.arange(64) / 8)[:, None]).astype(np.int64)
    assert kept_share(rows, range(5), 3) < 0.05


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="given tables are not here")
def test_bounds_drop_rows_of_the_given_table():
    vectors = pq.read_table("/root/testdata/sf0.1/embeddings.parquet", columns=["embedding"]).column(0).to_pylist()
    rows = np.floor(1024 * np.array([v for v in vectors if v is not None and len(v) == 64 and np.isfinite(v).all()], float)).astype(np.int64).T
    assert kept_share(rows, range(0, rows.shape[1], 100), 10) < 0.1


def test_forest_learns_and_flattens():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] < -0.2)).astype(float)
    forest = boosted_quality.fit(x[:3000], y[:3000])
    score = forest.scores(x)
    assert ((score[3000:] >= 0.5) == y[3000:]).mean() > 0.97

    def walk(row):
        total = forest.base
        for t in range(len(forest.feature)):
            node = 0
            for _ in range(forest.depth):
                node = 2 * node + 1 + (row[forest.feature[t, node]] > forest.limit[t, node])
            total += forest.value[t, node]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(score[:50], [walk(r) for r in x[:50]])


def test_forest_without_labels():
    empty = boosted_quality.fit(np.zeros((0, 3)), np.zeros(0))
    assert empty.scores(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    assert (boosted_quality.fit(np.ones((9, 3)), np.ones(9)).scores(np.zeros((2, 3))) > 0.9).all()


def test_statistics_of_empty_texts():
    found = boosted_quality.statistics(pa.array([None, "", " \n", "One two. One!"]))
    assert found.shape == (4, len(boosted_quality.FEATURES)) and (found[:3] == 0).all() and found[3, 0] > 0
    assert boosted_quality.statistics(pa.array([], pa.string())).shape == (0, len(boosted_quality.FEATURES))


def test_crc_is_of_little_endian_ids():
    assert zlib.crc32(np.array([1, 2], "<u4")) == zlib.crc32(b"\x01\0\0\0\x02\0\0\0")
