"""Token ids in binary files of shuffled planes.

A file holds the ids of a range of documents in ascending order of their ids.  Blocks
of a fixed number of ids (little-endian unsigned 32-bit) are transposed, so that bytes
(or bits) of equal weight lie together, and each plane is compressed with zstandard:
the high planes of a vocabulary of 50,000 ids are nearly empty.  A chunk index in the
file's footer gives the place of every block's planes, so any range of ids can be read
without the rest.

    file   := MAGIC chunk* documents footer length-of-footer(8 bytes) MAGIC
    chunk  := the compressed planes of one block, one after the other
    footer := JSON {ids, block, planes, chunks: [[place, ids, [plane sizes]]], documents: [place, size]}

Tasks write files of their own name into the shared folder; only files that the
manifest lists exist for readers, and the manifest is a table that Spark commits.  A
task that is lost or runs twice leaves a file that nobody reads.
"""

from __future__ import annotations

import io
import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.llm.common import SLICE_BYTES, col, returned, sliced
from hearthline.llm.tokens import encoder
from hearthline.session import opened, scratch_path, settle

MAGIC = b"IDPLANE1"
BLOCK = 1 << 16
MANIFEST = "part int, file string, n_docs long, n_ids long"


def to_planes(ids: np.ndarray, kind: str) -> np.ndarray:
    """One row per plane: 4 of bytes, or 32 of bits (the last byte filled with zeros)."""
    rows = ids.astype("<u4", copy=False).view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return np.ascontiguousarray(rows.T)
    return np.packbits(np.unpackbits(rows, axis=1, bitorder="little").T, axis=1)


def from_planes(planes: np.ndarray, n: int, kind: str) -> np.ndarray:
    if kind == "byte":
        return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)
    bits = np.unpackbits(planes, axis=1, count=n)
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u4").reshape(-1)


class PlaneWriter:
    """Writes ids and the documents they belong to; holds one block and the documents' lengths."""

    def __init__(self, out, kind: str = "byte", block: int = BLOCK):
        if kind not in ("byte", "bit"):
            raise ValueError(f"planes are of kind byte or bit, not {kind}")
        self.out, self.kind, self.block = out, kind, block
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = 0
        self.chunks: list[list] = []
        self.docs: list[pa.RecordBatch] = []
        self.squeeze = zstandard.ZstdCompressor(level=3).compress
        self.place = out.write(MAGIC) and len(MAGIC)

    def add(self, ids: np.ndarray, docs: pa.RecordBatch | None = None) -> None:
        if docs is not None:
            self.docs.append(docs)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= self.block:
            joined = np.concatenate(self.waiting)
            whole = len(joined) // self.block * self.block
            for at in range(0, whole, self.block):
                self.chunk(joined[at : at + self.block])
            self.waiting, self.n_waiting = [joined[whole:].copy()], len(joined) - whole

    def chunk(self, ids: np.ndarray) -> None:
        planes = [self.squeeze(p.tobytes()) for p in to_planes(ids, self.kind)]
        self.chunks.append([self.place, len(ids), [len(p) for p in planes]])
        for p in planes:
            self.out.write(p)
            self.place += len(p)
        self.n_ids += len(ids)

    def close(self) -> None:
        rest = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        if len(rest):
            self.chunk(rest)
        table = io.BytesIO()
        with pa.ipc.new_stream(table, self.docs[0].schema if self.docs else pa.schema([])) as sink:
            for docs in self.docs:
                sink.write_batch(docs)
        docs = self.squeeze(table.getvalue())
        self.out.write(docs)
        footer = {"ids": self.n_ids, "block": self.block, "planes": self.kind, "chunks": self.chunks, "documents": [self.place, len(docs)]}
        told = json.dumps(footer).encode()
        self.out.write(told + len(told).to_bytes(8, "little") + MAGIC)


class PlaneReader:
    """Random access to the ids of one file through its chunk index."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        tail = source.read_at(len(MAGIC) + 8, size - len(MAGIC) - 8)
        if tail[8:] != MAGIC or source.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError("not a file of id planes")
        length = int.from_bytes(tail[:8], "little")
        self.footer = json.loads(source.read_at(length, size - len(tail) - length))
        self.open = zstandard.ZstdDecompressor().decompress
        self.kept: tuple[int, np.ndarray] = (-1, np.zeros(0, "<u4"))

    def chunk(self, k: int) -> np.ndarray:
        """A block's ids; the last block read is kept."""
        if k != self.kept[0]:
            self.kept = (k, self._chunk(k))
        return self.kept[1]

    def _chunk(self, k: int) -> np.ndarray:
        place, n, sizes = self.footer["chunks"][k]
        stored = memoryview(self.source.read_at(sum(sizes), place))
        planes, at = [], 0
        for size in sizes:
            planes.append(np.frombuffer(self.open(stored[at : at + size]), np.uint8))
            at += size
        return from_planes(np.stack(planes), n, self.footer["planes"])

    def ids(self, start: int, stop: int) -> Iterator[np.ndarray]:
        """The ids of a range, block by block; every block but the last of a file is full."""
        block = self.footer["block"]
        for k in range(start // block, -(-stop // block)):
            yield self.chunk(k)[max(0, start - k * block) : stop - k * block]

    def documents(self) -> pa.Table:
        place, size = self.footer["documents"]
        with pa.ipc.open_stream(self.open(self.source.read_at(size, place))) as stream:
            return stream.read_all()


def new_file(folder: str):
    """A file of the running task's own, open for writing, and its path."""
    path = f"{folder}/ids-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.planes"
    store, place = opened(path)
    store.create_dir(place.rpartition("/")[0], recursive=True)
    return store.open_output_stream(place, compression=None), path


def write_ids(
    df: DataFrame, vocabulary: str, end_id: int = 2, *, id_col: str = "doc_id", text_col: str = "text",
    spaced: bool = False, special: bool = True, planes: str = "byte", block: int = BLOCK, folder: str | None = None,
) -> DataFrame:
    """Encode all texts and write their ids in files; returns the manifest.

    Documents go to files in ascending order of ``id_col``; null ids come first, and equal
    ids are ordered by a hash of their text, which also lets many tasks share a hot id.
    A null text counts as empty and has the end id alone.  A table without rows gives no
    files.  Columns other than the two named are not read.  ``special``: special tokens'
    strings in a text have the ids of these tokens.
    """
    folder = folder or scratch_path(df.sparkSession, "planes")
    own = df.select(col(id_col).alias("doc"), col(text_col).cast("string").alias("text"))
    keys = (F.col("doc").asc_nulls_first(), F.xxhash64("text"))
    ordered = own.repartitionByRange(*keys).sortWithinPartitions(*keys)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, n_docs = None, 0
        coder = encoder(vocabulary, end_id, spaced, special)
        for rows in sliced(batches, "text", SLICE_BYTES):
            if writer is None:
                out, file = new_file(folder)
                writer = PlaneWriter(out, planes, block)
            ids, counts = coder.encode(rows.column("text"))
            writer.add(ids, pa.RecordBatch.from_arrays([rows.column("doc"), pa.array(counts)], ["doc", "n"]))
            n_docs += rows.num_rows
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([file]), pa.array([n_docs]), pa.array([writer.n_ids])],
                ["part", "file", "n_docs", "n_ids"],
            )

    return settle(ordered.mapInArrow(returned(write), MANIFEST), "manifest")


def read_ids(manifest: DataFrame, id_type: T.DataType | str = "long", with_ids: bool = False) -> DataFrame:
    """The documents of the files: doc_id, start, n_tokens, ids_crc32, and their ids if asked for.

    ``start`` counts the ids of all documents before, over all files; the files' totals,
    one row each, are summed up for that.  A task reads one file block by block, so that a
    document of any length needs the memory of one block (of its ids, if they are returned).
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).select("part", "file", "base")
    n = max(1, manifest.count())
    kind = id_type if isinstance(id_type, str) else id_type.simpleString()
    shape = f"doc_id {kind}, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, base in ((r["file"], r["base"]) for b in batches for r in b.to_pylist()):
            store, place = opened(file)
            with store.open_input_file(place) as source:
                reader = PlaneReader(source)
                at = 0
                for docs in reader.documents().to_batches(max_chunksize=2_000):
                    yield from told(reader, docs, at, base)
                    at += int(np.sum(docs.column("n").to_numpy()))

    def told(reader: PlaneReader, docs: pa.RecordBatch, at: int, base: int) -> Iterator[pa.RecordBatch]:
        counts = docs.column("n").to_numpy()
        stops = at + np.cumsum(counts)
        blocks, ready = reader.ids(at, int(stops[-1])), np.zeros(0, "<u4")
        sums, ids = [], []
        for n_left in counts.tolist():
            crc, own = 0, []
            while n_left:
                if not len(ready):
                    ready = next(blocks)
                taken, ready = ready[:n_left], ready[n_left:]
                crc = zlib.crc32(taken, crc)
                n_left -= len(taken)
                if with_ids:
                    own.extend(taken.tolist())
            sums.append(crc)
            ids.append(own)
        columns = [docs.column("doc"), pa.array(base + stops - counts), pa.array(counts), pa.array(sums, pa.int64())]
        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
        yield pa.RecordBatch.from_arrays(columns + [pa.array(ids, pa.list_(pa.int64()))] * with_ids, names + ["ids"] * with_ids)

    return files.repartitionByRange(n, "part").mapInArrow(returned(read), shape)
