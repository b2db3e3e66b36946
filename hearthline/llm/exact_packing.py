"""Packing of token pieces into sequences of a fixed length, by exact complements.

Only the number of pieces of each length matters for a plan, and lengths are bounded by
the sequence length.  The plan is therefore made from one row per length, however large
the corpus.  An index has, for every sum, the pairs and triples of lengths that are still
there.  Pieces that a single other piece completes are used up first.  Then, from the
lengths just over half a sequence to the longest and on to short ones, the gap is looked
up among the sums of pairs, then of triples, and the combination is used as often as its
scarcest length allows and as the surplus does: of the pieces up to a length, the mass
that the gaps up to that length can't take.  So long pieces are not left without the short
ones that fit them.  What has no exact complement is packed best fit decreasing.  A plan
line says which lengths lie in a sequence and how many sequences are like that.

Pieces then find their place by their number among the pieces of their length.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.llm.common import SLICE_BYTES, col, mapped, placed, returned, sliced
from hearthline.llm.token_planes import PlaneReader, PlaneWriter, new_file
from hearthline.llm.tokens import encoder
from hearthline.session import opened, scratch_path, settle

Line = tuple[tuple[int, ...], int]
SHARES = (0.1, 0.003, 0.0003, 0.00003, 0.0)  # of the surplus that one line of pairs or triples may take


class SumIndex:
    """Lengths that are left, with the single lengths, pairs and triples of them by their sum.

    ``pairs[sum]`` and ``triples[sum]`` have the longest length of each combination, from the
    longest on; those that counts rule out are taken off when a sum is looked up.
    """

    def __init__(self, left: np.ndarray):
        self.left = left
        self.pairs: dict[int, np.ndarray] = {}
        self.triples: dict[int, np.ndarray] = {}

    def has(self, *lengths: int) -> bool:
        return all(self.left[k] >= n for k, n in Counter(lengths).items())

    def pairs_of(self, total: int, most: int, least: int = 1, besides: tuple[int, ...] = ()) -> Iterator[tuple[int, int]]:
        """Pairs that sum to ``total``, with the longest first length first; lengths are from ``least`` to ``most``."""
        longer = self.pairs.get(total)
        if longer is None:
            longer = np.arange(total - 1, (total - 1) // 2, -1)
        self.pairs[total] = longer = longer[(self.left[longer] > 0) & (self.left[total - longer] > 0)]
        for a in longer[(longer <= most) & (total - longer >= least)].tolist():
            if self.has(a, total - a, *besides):
                yield a, total - a

    def complement(self, length: int, full: int, terms: int, least: int = 1) -> tuple[int, ...] | None:
        """What fills a sequence that holds ``length``: up to ``terms`` lengths no longer than it and, for two or more, from ``least`` on."""
        gap = full - length
        if terms >= 1 and gap <= length and self.has(length, gap):
            return (gap,)
        if terms >= 2 and (found := next(self.pairs_of(gap, length, least, (length,)), None)):
            return found
        if terms >= 3:
            longest = self.triples.get(gap)
            if longest is None:
                longest = np.arange(gap - 2, (gap - 1) // 3, -1)
            self.triples[gap] = longest = longest[self.left[longest] > 0]
            for a in longest[(longest <= length) & (gap - longest >= 2 * least)].tolist():
                if found := next(self.pairs_of(gap - a, a, least, (length, a)), None):
                    return (a, *found)
        return None


def surplus(left: np.ndarray) -> np.ndarray:
    """For each length, the mass of the pieces up to it that the gaps up to it, of sequences of one long piece, can't take."""
    full = len(left) - 1
    lengths = np.arange(full + 1)
    gaps = np.where(lengths < full - full // 2, left[::-1] * lengths, 0)
    return np.cumsum(left * lengths) - np.cumsum(gaps)


def packing_plan(counts: dict[int, int], full: int) -> list[Line]:
    """Lengths of the sequences and how many there are of each kind, for so many pieces of each length.

    A line of pairs or triples takes at most a share of the surplus.  Where even that costs
    a sequence against best fit alone, smaller shares are tried, which make more lines: the
    larger the counts, the smaller the share that pays.
    """
    left = np.zeros(full + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    limit = sum(times for _, times in best_fit(left, full))
    for share in SHARES:
        plan = exact_plan(left.copy(), full, share)
        if sum(times for _, times in plan) <= limit:
            return plan
    return best_fit(left, full)


def exact_plan(left: np.ndarray, full: int, share: float) -> list[Line]:
    """The plan with exact complements of one, two and three lengths, these within ``share`` of the surplus."""
    plan: list[Line] = []
    if left[full]:
        plan.append(((full,), int(left[full])))
        left[full] = 0
    index = SumIndex(left)

    def use(line: tuple[int, ...], most: int) -> None:
        need = Counter(line)
        times = min(most, *(int(left[k]) // n for k, n in need.items()))
        for k, n in need.items():
            left[k] -= times * n
        plan.append((line, times))

    for length in range(full - 1, 0, -1):
        while left[length] and (rest := index.complement(length, full, 1)):
            use((length, *rest), int(left[length]))
    half = full // 2
    for length in [*range(half + 1, full), *range(half, 0, -1)] if share else ():
        gap = full - length
        while left[length]:
            spare = share * surplus(left)
            # Below the last length that has too little to spare, nothing is taken.
            short = np.flatnonzero(spare[:gap] < gap)
            rest = index.complement(length, full, 3, int(short[-1]) + 1 if len(short) else 1)
            if rest is None:
                break
            taken = np.zeros(gap, np.int64)
            for part in rest:
                taken[part:] += part
            held = taken > 0
            use((length, *rest), max(1, int((spare[:gap][held] // taken[held]).min(initial=left[length]))))
    return plan + best_fit(left, full)


def best_fit(left: np.ndarray, full: int) -> list[Line]:
    """Best fit decreasing, for all pieces of a length at once: the tightest sequences that fit come first."""
    room: dict[int, list[Line]] = {}
    for length in range(full, 0, -1):
        n = int(left[length])
        while n and (fit := min((r for r, lines in room.items() if r >= length and lines), default=0)):
            line, times = room[fit].pop()
            used = min(n, times)
            if times > used:
                room[fit].append((line, times - used))
            room.setdefault(fit - length, []).append(((*line, length), used))
            n -= used
        each = full // length
        for size, times in ((each, n // each), (n % each, 1)):
            if size and times:
                room.setdefault(full - size * length, []).append(((length,) * size, times))
    return [line for lines in room.values() for line in lines]


def plan_rows(plan: list[Line]) -> list[tuple[int, int, int, int, list[int]]]:
    """For each length of each line: the first and last number of its pieces, the first sequence, and its offsets."""
    used: Counter[int] = Counter()
    rows, sequence = [], 0
    for line, times in plan:
        offsets: dict[int, list[int]] = {}
        at = 0
        for length in line:
            offsets.setdefault(length, []).append(at)
            at += length
        for length, own in offsets.items():
            rows.append((length, used[length], used[length] + times * len(own), sequence, own))
            used[length] += times * len(own)
        sequence += times
    return rows


def cut(lengths: np.ndarray, full: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, number, start and length of each piece; only the first of a long document may be short."""
    n = -(-lengths // full)
    doc = np.repeat(np.arange(len(lengths)), n)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    first = lengths - (n - 1) * full
    size = np.where(piece == 0, first[doc], full)
    start = np.where(piece == 0, 0, first[doc] + (piece - 1) * full)
    return doc, piece, start, size


def token_pieces(
    df: DataFrame, vocabulary: str, full: int = 1024, end_id: int = 2, *, id_col: str = "doc_id", text_col: str = "text",
    spaced: bool = True, special: bool = True, folder: str | None = None,
) -> DataFrame:
    """Pieces of all documents: doc_id, piece, start, length, ids_crc32, and the file and place of their ids.

    Every task writes the ids of its documents to a file of planes in the shared folder;
    the table of pieces, which Spark commits, is the only way to them, so files of lost
    tasks are never read.  A null text counts as empty: one piece that holds the end id.  A
    null or repeated doc_id is kept as it is; each row is a document.  ``special``: special
    tokens' strings in a text have the ids of these tokens.
    """
    folder = folder or scratch_path(df.sparkSession, "pieces")
    kind = df.schema[id_col].dataType.simpleString()
    shape = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, file string, at long"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, writer, out, file = encoder(vocabulary, end_id, spaced, special), None, None, ""
        before = 0
        for rows in sliced(batches, "text", SLICE_BYTES):
            if writer is None:
                out, file = new_file(folder)
                writer = PlaneWriter(out)
            ids, counts = coder.encode(rows.column("text"))
            writer.add(ids)
            doc, piece, start, size = cut(counts, full)
            data = memoryview(ids.astype("<u4", copy=False).view(np.uint8))
            stops = np.cumsum(size)
            sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip((stops - size).tolist(), stops.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc").take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(size),
                    pa.array(sums, pa.int64()), pa.array([file] * len(doc), pa.string()), pa.array(before + stops - size),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32", "file", "at"],
            )
            before += len(ids)
        if writer is not None:
            writer.close()
            out.close()

    own = df.select(col(id_col).alias("doc"), col(text_col).cast("string").alias("text"))
    return settle(own.mapInArrow(returned(encode), shape), "pieces")


def with_ids(pieces: DataFrame) -> DataFrame:
    """The pieces with their ids (unsigned 32-bit, little-endian) instead of the place of these.

    Pieces are sorted by their place, so that every block of a file is read once.
    """
    kept = [c for c in pieces.columns if c not in ("file", "at")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, source, reader = None, None, None
        for batch in batches:
            for rows in (batch.slice(at, 512) for at in range(0, batch.num_rows, 512)):
                found = []
                for file, at, length in zip(*(rows.column(c).to_pylist() for c in ("file", "at", "length")), strict=True):
                    if file != current:
                        if source is not None:
                            source.close()
                        store, place = opened(file)
                        current, source = file, store.open_input_file(place)
                        reader = PlaneReader(source)
                    found.append(np.concatenate([*reader.ids(at, at + length)]).tobytes())
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in kept), pa.array(found, pa.binary())], [*kept, "ids"])

    ordered = pieces.repartition("file").sortWithinPartitions("file", "at")
    return mapped(ordered, returned(read), kept, "ids binary")


PLAN = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("_length", "_first", "_last", "_sequence")] + [T.StructField("_offsets", T.ArrayType(T.LongType()))]
)


def pack(pieces: DataFrame, full: int = 1024, seed: int | None = None) -> DataFrame:
    """Pieces with their sequence_id and offset; sequences are gapless and as few as the plan finds.

    Needs columns doc_id, piece and length (1 to ``full``); all columns are kept.  The
    counts that reach the driver and the plan that is broadcast are bounded by ``full``.
    Pieces of equal length are numbered in the order of doc_id and piece, or with a
    ``seed`` in random order: by a hash that differs between copies of a piece, so that
    copies are spread over the sequences.  No pieces give no rows.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = spark.createDataFrame(plan_rows(packing_plan(counts, full)), PLAN)
    order = [F.col(c) for c in ("doc_id", "piece", "start", "ids_crc32") if c in pieces.columns]
    dealt = pieces
    if seed is not None:
        # Equal pieces can stand for each other, so it doesn't matter which copy is the first.
        same = Window.partitionBy("length", *order).orderBy(*[F.col(c) for c in ("file", "at") if c in pieces.columns] or [F.lit(0)])
        dealt = pieces.withColumn("_copy", F.row_number().over(same))
        order = [F.xxhash64(F.lit(seed), *[F.coalesce(c.cast("string"), F.lit("")) for c in order], F.col("_copy")), *order, F.col("_copy")]
    ranked = placed(dealt, ["length"], order, "ranked", "_rank")
    within = F.col("_rank") - F.col("_first")
    fits = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_last"))
    each = F.size("_offsets")
    return ranked.join(F.broadcast(plan), fits).select(
        *[col(c) for c in pieces.columns],
        (F.col("_sequence") + F.floor(within / each)).cast("long").alias("sequence_id"),
        F.col("_offsets")[(within % each).cast("int")].alias("offset"),
    )


def pack_documents(df: DataFrame, vocabulary: str, full: int = 1024, end_id: int = 2, *, seed: int | None = None, **columns) -> DataFrame:
    """All documents as packed pieces with their ids, in random order with a ``seed``."""
    return with_ids(pack(token_pieces(df, vocabulary, full, end_id, **columns), full, seed))
