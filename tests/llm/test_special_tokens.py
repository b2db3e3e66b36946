"""Special tokens' strings in texts, against the library encoding whole texts with its defaults."""

from __future__ import annotations

import zlib
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from hearthline.llm.queries import QUERIES
from hearthline.llm.tokens import TextEncoder

END, START = "<|endoftext|>", "<|startoftext|>"
PARTS = [
    "a", "B", "é", "'", "'s", " ", "  ", "\n", "　", ".", "!!", "1", "日本", "̸", "Σ", "<", "|", "<|endof", "text|>",
    END, START, END.upper(), "<|EndOfText|>", END * 2,
]
TEXTS = st.lists(st.one_of(st.none(), st.lists(st.sampled_from(PARTS), max_size=30).map("".join)), max_size=8)
FIXED = [f"a {END} b", f"A{END}'s", f" {START}{END}  x", "ends in <|endof", "text|> begins", END.upper(), None, "", END, "no such string"]


@cache
def library(vocabulary):
    return Tokenizer.from_file(public_tokenizers.path(vocabulary))


def ids_of(vocabulary, text):
    return library(vocabulary).encode(text or "", add_special_tokens=False).ids + [2]


@pytest.fixture(scope="module", params=[("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def coder(request):
    name, spaced = request.param
    return name, TextEncoder(public_tokenizers.path(name), 2, spaced, special=True)


def test_known_ids(coder):
    name, encoder = coder
    known = {"word_bpe_49k.json": [320, 49407, 321, 2], "byte_bpe_50k.json": [64, 220, 50256, 275, 2]}
    assert encoder.encode(pa.array([f"a {END} b"]))[0].tolist() == known[name]


@settings(deadline=None, max_examples=300)
@given(texts=TEXTS)
def test_like_whole_texts(coder, texts):
    name, encoder = coder
    for own in (texts, FIXED):
        ids, counts = encoder.encode(pa.array(own, pa.string()))
        expected = [ids_of(name, t) for t in own]
        assert counts.tolist() == [len(e) for e in expected]
        assert ids.tolist() == [i for e in expected for i in e]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4"))


def test_queries(spark, tmp_path):
    df = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in enumerate(FIXED)], "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    start = 0
    for row, text in zip(sorted(QUERIES["op1_token_planes"](spark, str(tmp_path)).collect()), FIXED, strict=True):
        ids = ids_of("word_bpe_49k.json", text)
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)
    expected = {k: crc(ids_of("byte_bpe_50k.json", t)) for k, t in enumerate(FIXED)}
    assert {r.doc_id: r.ids_crc32 for r in QUERIES["op3_exact_packing"](spark, str(tmp_path)).collect()} == expected
    assert {r.doc_id: r.ids_crc32 for r in corpus_pipeline.packing(spark, df, "").collect()} == expected
