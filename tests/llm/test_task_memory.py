"""What a task of the token files holds while it encodes, and what its worker keeps afterwards."""

from __future__ import annotations

import io
from types import SimpleNamespace

import public_tokenizers
import pyarrow as pa
import pytest

from hearthline.llm import common, token_planes

WORDS = ["one", "Two", "three's", "four,", "five", "日本", "seven\n"]


@pytest.fixture
def tasks(spark, monkeypatch):
    """The functions that the operator hands to Spark, in the order they are handed over."""
    given = []
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plain = type(df).mapInArrow

    def noted(self, run, *args, **options):
        given.append(run)
        return plain(self, run, *args, **options)

    monkeypatch.setattr(type(df), "mapInArrow", noted)
    token_planes.read_ids(token_planes.write_ids(df, public_tokenizers.path("word_bpe_49k.json")))
    return given


def test_small_slices_and_memory_given_back(tasks, monkeypatch):
    write, read = tasks
    trimmed, encoded = [], []
    monkeypatch.setattr(common, "_trim", lambda: trimmed.append)
    monkeypatch.setattr(token_planes, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    monkeypatch.setattr(token_planes, "new_file", lambda folder: (io.BytesIO(), "file"))
    coder = token_planes.encoder(public_tokenizers.path("word_bpe_49k.json"), 2, False, True)
    plain = coder.encode
    monkeypatch.setattr(coder, "encode", lambda column: (encoded.append(column.nbytes), plain(column))[1])
    texts = [" ".join(WORDS) * 30 for _ in range(6_000)]
    rows = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc", "text"])
    assert rows.column("text").nbytes > 6 << 20
    (told,) = write(iter([rows]))
    assert told.column("n_docs").to_pylist() == [len(texts)] and len(trimmed) == 1
    assert max(encoded) < (2 << 20) + 100_000
    assert list(read(iter([]))) == [] and len(trimmed) == 2
