"""SimHash near-duplicates: fingerprints of word shingles, linked where few bits differ.

Fingerprints of equal texts are equal, so everything after the first step works on the
distinct fingerprints.  To find pairs with at most ``k`` differing bits, the 64 bits are
split into ``k + 3`` blocks: such a pair agrees in at least three of them, so it meets
when all fingerprints are joined on each choice of three blocks, and its distance is
verified there.  (Blocks taken one at a time would be keys of 21 bits, which large
corpora fill; three of five blocks are 38 bits or more.)

A bucket of more than ``wide`` fingerprints isn't joined with itself.  There, every
fingerprint is listed under each value that differs from it in at most half of ``k`` bits,
rounded up, and the fingerprints listed under a value are linked to the smallest of those
that are within half of k, rounded down: these and any other are within k bits of each
other.  Every pair within k bits shares a value that is so near to one of them, so the
groups are the same, and the rows grow with the bucket and not with its square.

Groups are found by repeatedly giving each fingerprint the smallest label near it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import col, mapped, numbered, others, restored, returned, sliced
from hearthline.llm.words import SPACE, Words
from hearthline.session import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A") : ord("Z") + 1] += 32
SEED = 42
LINKS_PER_TASK = 500_000


def fingerprints(column: pa.Array, shingle: int) -> np.ndarray:
    """The fingerprint of each text as an unsigned 64-bit number.

    Shingles are ``shingle`` words joined by a space, repeats counted; a shorter text is
    one shingle, and one without words has fingerprint 0.
    """
    words = Words.of(column)
    counts = words.counts()
    sizes = words.ends - words.starts
    # All words, each followed by one space, in one array of bytes.
    begin = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes + 1, out=begin[1:])
    spaced = np.full(int(begin[-1]), 0x20, np.uint8)
    place = np.arange(int(sizes.sum()))
    place += np.repeat(np.arange(len(sizes)), sizes)
    spaced[place] = FOLD[words.content[~SPACE[words.content]]]
    n_shingles = np.where(counts > 0, np.maximum(counts - shingle + 1, 1), 0)
    text = np.repeat(np.arange(len(counts)), n_shingles)
    first = words.first[text] + np.arange(len(text)) - np.repeat(np.cumsum(n_shingles) - n_shingles, n_shingles)
    last = np.minimum(first + shingle, words.first[text + 1])
    digest, data = xxhash.xxh64_intdigest, memoryview(spaced)
    hashes = np.fromiter(
        (digest(data[a:b], SEED) for a, b in zip(begin[first].tolist(), (begin[last] - 1).tolist(), strict=True)), np.uint64, len(first)
    )
    out = np.zeros(len(counts), np.uint64)
    stop = np.cumsum(n_shingles)
    for k in np.flatnonzero(n_shingles).tolist():
        own = hashes[stop[k] - n_shingles[k] : stop[k]]
        ones = np.zeros(64, np.int64)
        for at in range(0, len(own), 4096):
            ones += np.unpackbits(own[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[k] = np.packbits(2 * ones > len(own), bitorder="little").view(np.uint64)[0]
    return out


def with_fingerprints(df: DataFrame, shingle: int, text_col: str = "text", name: str = "fp") -> DataFrame:
    """The rows with the fingerprint of their text as a signed long; a null text has no words."""
    kept = others(df, name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sliced(batches, text_col):
            found = fingerprints(rows.column(text_col), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in kept), pa.array(found)], [*kept, name])

    return mapped(df.select(*[col(c) for c in kept]), returned(run), kept, f"{name} long")


def block_masks(k: int) -> list[int]:
    """A mask of bits for each choice of three of ``k + 3`` blocks."""
    n = k + 3
    edges = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(choice) for choice in combinations(blocks, 3)]


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def variants(bits: int) -> list[int]:
    """All masks with at most so many bits set."""
    return [signed(sum(1 << b for b in chosen)) for n in range(bits + 1) for chosen in combinations(range(64), n)]


def links(distinct: DataFrame, k: int, wide: int) -> DataFrame:
    """Links (a, b) with a < b between distinct fingerprints ``fp`` that connect all pairs within k bits."""
    masks = F.array(*[F.lit(signed(m)) for m in block_masks(k)])
    keyed = distinct.select("fp", F.posexplode(masks).alias("block", "mask")).select("fp", "block", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
    keyed = settle(keyed, "blocks")
    sizes = keyed.groupBy("block", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = settle(keyed.join(sizes, ["block", "key"]), "shared")
    narrow = shared.where(F.col("n") <= wide)
    one, two = narrow.select("block", "key", F.col("fp").alias("a")), narrow.select("block", "key", F.col("fp").alias("b"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= k
    pairs = one.join(two, ["block", "key"]).where((F.col("a") < F.col("b")) & close).select("a", "b")
    return pairs.union(wide_links(shared.where(F.col("n") > wide), k)).distinct()


def wide_links(shared: DataFrame, k: int) -> DataFrame:
    """Links among the fingerprints of wide buckets, through the values between them."""
    flips = F.array(*[F.lit(v) for v in variants((k + 1) // 2)])
    listed = shared.select("fp").distinct().select(F.col("fp"), F.explode(flips).alias("flip"))
    near = listed.select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("value"), (F.bit_count("flip") <= k // 2).alias("inner"))
    least = near.groupBy("value").agg(F.min(F.when(F.col("inner"), F.col("fp"))).alias("a"), F.count("*").alias("n"))
    least = least.where("n > 1 and a is not null").select("value", "a")
    found = near.join(least, "value").where("fp <> a")
    return found.select(F.least("a", "fp").alias("a"), F.greatest("a", "fp").alias("b"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for all nodes of the links, root the smallest node reachable.

    Each round links every node's larger neighbours to its smallest one and then all
    neighbours to it, which halves the paths; every round is written, so a lost executor
    costs one round.  It ends when a round changes nothing.  Links are few beside the
    fingerprints, so a round runs in as many tasks as its counted links ask for.
    """
    current, before = settle(edges.select("a", "b"), "edges"), None
    n = current.count()
    while True:
        tasks = 1 + 2 * n // LINKS_PER_TASK
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(near, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a <> b")
        stored = settle(large.coalesce(tasks), "large")
        low = stored.groupBy("b").agg(F.min("a").alias("m"))
        small = stored.join(low, "b").select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b")).where("a <> b")
        current = settle(small.coalesce(tasks).distinct().coalesce(tasks), "small")
        told = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if told == before:
            return current.select(F.col("b").alias("node"), F.col("a").alias("root"))
        n, before = told[0], told


def grouped(
    df: DataFrame, shingle: int = 3, k: int = 2, *, id_col: str = "doc_id", text_col: str = "text", wide: int = 256
) -> DataFrame:
    """Per row: doc_id, its fingerprint ``fp``, the ``root`` fingerprint of its group, and the group's smallest doc_id.

    Null ids are never the smallest; a group with no other has a null component_id.  Rows
    without words have fingerprint 0 and are linked like any other.  Repeated rows share
    a fingerprint.  Only ids and fingerprints are shuffled.
    """
    own = df.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text"))
    rows = settle(with_fingerprints(own, shingle).select("doc_id", "fp"), "fingerprints")
    firsts = settle(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(links(firsts.select("fp"), k, wide))
    labelled = firsts.join(roots, firsts["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    lowest = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    groups = settle(labelled.join(lowest, "root").select("fp", "root", "component_id"), "groups")
    return rows.join(groups, "fp").select("doc_id", "fp", "root", "component_id")


def one_of_each(df: DataFrame, shingle: int = 3, k: int = 2, *, id_col: str = "doc_id", text_col: str = "text", wide: int = 256) -> DataFrame:
    """One row of each group, in the input's columns: that with the smallest id, then the smallest hash of its columns.

    Rows that can't be told apart stay one.
    """
    plain, names = numbered(df)
    stored = settle(with_fingerprints(plain, shingle, names[text_col], "_fp").withColumn("_row", F.monotonically_increasing_id()), "marked")
    rows = stored.select("_row", "_fp", F.col(names[id_col]).alias("_id"))
    roots = components(links(rows.select(F.col("_fp").alias("fp")).distinct(), k, wide))
    labelled = rows.join(roots, rows["_fp"] == roots["node"], "left").select("_row", "_id", F.coalesce("root", "_fp").alias("root"))
    smallest = labelled.groupBy("root").agg(F.min(F.struct(F.col("_id").isNull().alias("n"), "_id", "_row")).alias("best"))
    chosen = smallest.select(F.col("best._row").alias("_row"))
    return restored(stored.join(chosen, "_row", "left_semi"), df, names)

