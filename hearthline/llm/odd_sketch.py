"""MinHash near-duplicates, verified by odd sketches and then on full sets.

1. Every text becomes the set of its distinct word shingles.  ``BANDS * ROWS`` MinHash
   samples are taken of it; each band of ``ROWS`` samples is hashed to a key, and all
   samples are folded into an odd sketch: a bitmap that holds, for each bit, whether an
   odd number of samples falls on it.  Texts of equal sets are one class, and everything
   after works on classes.
2. Classes that share a band's key are candidates.  Of two sketches, the number of
   differing bits (population count of their XOR) tells how many samples differ, and so
   how similar the sets are, most precisely where they are similar.  A pair is left out
   when it has more differing bits than a pair of the asked similarity has with
   probability 1 - ``MISS``.
3. What is left is verified on the full sets, as hashes of 64 bits.

A bucket isn't joined with itself.  First each class is compared to one hub: of the
smallest members of its buckets, that of most of them.  This links most near copies.
Then only members that don't have the most frequent label of their bucket are compared to
the rest, in blocks of about ``WIDE`` against blocks of ``WIDE``, twice: on sketches alone,
which leaves the members that have a near partner of another label, and for these on
sketches and full sets.  Only links leave a task.  A pair is verified in the first band
it shares, and not at all when its labels are already linked in that task.  So no pair
that could join two groups is left out, however wide the bucket, and what is shuffled
grows with the members and not with their pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import Batches, col, mapped, sliced
from hearthline.llm.simhash import FOLD, components
from hearthline.llm.words import Words, fits, gram_hashes, mixed, text_bytes
from hearthline.session import settle

BANDS, ROWS = 40, 5  # a pair of similarity 0.8 shares no band with probability 1.3e-7
BITS = 1024
MISS = 1e-6
WIDE = 64
SET_UNIT = 4096  # so many shingles count as much as a member when members are dealt to blocks
SINGLE = np.uint64(0xC2B2AE3D27D4EB4F)  # sets a lone word apart from longer shingles
LONGS = BITS // 64
TOP = np.uint64(1 << 63)  # flipped, unsigned numbers are in the same order as signed ones


def shingle_sets(column: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of all texts, and where those of each text begin (one entry more than texts).

    A text of fewer words than a shingle is one shingle, and one without words has none.
    """
    content, begin = text_bytes(column)
    folded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin) - 1, [None, pa.py_buffer(np.ascontiguousarray(begin)), pa.py_buffer(FOLD[content])])
    words = Words.of(folded)
    hashes, counts = words.hashes(), words.counts()
    grams = gram_hashes(hashes, shingle)
    own = np.flatnonzero(fits(words.first, shingle, len(grams)))
    owner, values = words.owner()[own], grams[own]
    for n in range(1, shingle):
        # Of n words only: the hash of all of them, told apart by n.
        short = np.flatnonzero(counts == n)
        owner = np.concatenate([owner, short])
        values = np.concatenate([values, mixed(gram_hashes(hashes, n)[words.first[short]] ^ (SINGLE * np.uint64(n)))])
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    owner, values = owner[fresh], values[fresh]
    return values, np.searchsorted(owner, np.arange(len(counts) + 1))


@cache
def multipliers() -> np.ndarray:
    """An odd number for each sample."""
    return mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * SINGLE) | np.uint64(1)


def samples(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The MinHash samples (columns) of the sets that aren't empty (rows)."""
    filled = np.flatnonzero(np.diff(begin))
    out = np.empty((len(filled), BANDS * ROWS), np.uint64)
    for i, m in enumerate(multipliers() if len(filled) else ()):
        # The high bits of the product depend on all bits of the value.
        out[:, i] = np.minimum.reduceat(values * m, begin[filled])
    return out


def band_keys(found: np.ndarray) -> np.ndarray:
    """The key of each band (columns) of each set."""
    total = np.tile(np.arange(BANDS, dtype=np.uint64), (len(found), 1))
    for r in range(ROWS):
        total = mixed(total ^ found[:, r::ROWS])
    return total.view(np.int64)


def odd_sketches(found: np.ndarray) -> np.ndarray:
    """The parities of the bits that each set's samples fall on, as signed 64-bit numbers (columns)."""
    n, k = found.shape
    places = (mixed(found ^ multipliers()) % np.uint64(BITS)).astype(np.int64) + (np.arange(n) * BITS)[:, None]
    odd = np.bincount(places.ravel(), minlength=n * BITS).astype(np.uint8) & 1
    return np.packbits(odd.reshape(n, BITS), axis=1, bitorder="little").view(np.int64).reshape(n, LONGS)


@cache
def most_bits(similarity: float) -> int:
    """The most differing bits that a pair of this similarity has, but with probability ``MISS``.

    The samples that differ are binomial, and each puts two bits at random places.
    """
    k = BANDS * ROWS
    state = np.zeros(BITS + 1)
    state[0] = 1.0
    at = np.arange(BITS + 1)
    total = np.zeros(BITS + 1)
    for differ in range(k + 1):
        total += math.comb(k, differ) * (1 - similarity) ** differ * similarity ** (k - differ) * state
        for _ in range(2):
            up, down = state * (BITS - at) / BITS, state * at / BITS
            state = np.zeros(BITS + 1)
            state[1:] += up[:-1]
            state[:-1] += down[1:]
    return int(np.flatnonzero(np.cumsum(total[::-1])[::-1] > MISS)[-1])


def sketched(df: DataFrame, shingle: int) -> DataFrame:
    """Per row of ``df`` (id, text): id, n_shingles, the digest of its set, its band keys and odd sketch; the last three null for empty sets."""

    def run(batches: Batches) -> Batches:
        for rows in sliced(batches, "text"):
            values, begin = shingle_sets(rows.column("text"), shingle)
            counts = np.diff(begin)
            found = samples(values, begin)
            data, places = values.astype("<u8").tobytes(), (begin * 8).tolist()
            digests = [xxhash.xxh3_128_digest(data[a:b]) if b > a else None for a, b in zip(places, places[1:], strict=False)]
            lists = [listed(x, counts > 0) for x in (band_keys(found), odd_sketches(found))]
            yield pa.RecordBatch.from_arrays(
                [rows.column("id"), pa.array(counts), pa.array(digests, pa.binary()), *lists], ["id", "n_shingles", "digest", "keys", "sketch"]
            )

    return mapped(df, run, ["id"], "n_shingles long, digest binary, keys array<long>, sketch array<long>")


def listed(matrix: np.ndarray, present: np.ndarray) -> pa.Array:
    """The matrix's rows as lists, in the places that are present; null in others."""
    width = matrix.shape[1]
    offsets = np.concatenate(([0], np.cumsum(present * width))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel()), mask=pa.array(~present))


def differing(a: Column, b: Column) -> Column:
    """The population count of the XOR of two odd sketches."""
    return sum((F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(LONGS)), F.lit(0))


def alike(n_a: Column, n_b: Column, percent: int) -> Column:
    """Whether sets of these sizes can be as similar."""
    return 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)


class Verifier:
    """Exact similarities of pairs of classes; the sets of the classes asked for are worked out once, and written."""

    def __init__(self, docs: DataFrame, classes: DataFrame, shingle: int, percent: int) -> None:
        self.docs, self.classes, self.shingle, self.percent = docs, classes, shingle, percent
        self.sets: DataFrame | None = None

    def known(self, needed: DataFrame) -> DataFrame:
        """Sets (c, members) of the classes ``c`` needed and of those before."""
        if self.sets is not None:
            needed = needed.join(self.sets.select("c"), "c", "left_anti")
        wanted = settle(self.classes.join(needed, "c", "left_semi").select("c", "digest", "first"), "wanted")
        shingle = self.shingle

        def run(batches: Batches) -> Batches:
            for rows in sliced(batches, "text"):
                values, begin = shingle_sets(rows.column("text"), shingle)
                data, places = values.astype("<u8").tobytes(), (begin * 8).tolist()
                digests = [xxhash.xxh3_128_digest(data[a:b]) for a, b in zip(places, places[1:], strict=False)]
                members = pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array((values ^ TOP).view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), members], ["digest", "members"])

        texts = self.docs.join(wanted.select("first"), F.col("id").eqNullSafe(F.col("first")), "left_semi").select("text")
        found = mapped(texts, run, [], "digest binary, members array<long>").join(wanted.select("c", "digest"), "digest")
        # Rows of one id and text, and those of null ids, may come more than once.
        fresh = settle(found.groupBy("c").agg(F.first("members").alias("members")), "sets")
        self.sets = fresh if self.sets is None else self.sets.union(fresh)
        return self.sets

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose sets are as similar."""
        needed = pairs.select(F.col("a").alias("c")).union(pairs.select(F.col("b").alias("c"))).distinct()
        sets = self.known(needed)
        one, two = sets.select(F.col("c").alias("a"), F.col("members").alias("x")), sets.select(F.col("c").alias("b"), F.col("members").alias("y"))
        both = pairs.select("a", "b").join(two, "b").join(one, "a")
        shared = F.size(F.array_intersect("x", "y"))
        whole = F.size("x") + F.size("y") - shared
        return settle(both.where(100 * shared >= self.percent * whole).select("a", "b"), "verified")


def hub_pairs(keyed: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Each class with a hub whose sketch is near: that smallest member of its buckets that it shares most of them with."""
    least = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("c").alias("a")).where("n > 1").select("key", "a")
    shared = keyed.join(least, "key").where("a <> c").groupBy("c", "a").agg(F.count("*").alias("n"))
    hubs = shared.groupBy(F.col("c").alias("b")).agg(F.max_by("a", "n").alias("a"))
    one = classes.select(F.col("c").alias("a"), F.col("n_shingles").alias("n_a"), F.col("sketch").alias("x"))
    two = classes.select(F.col("c").alias("b"), F.col("n_shingles").alias("n_b"), F.col("sketch").alias("y"))
    compared = settle(hubs, "hubs").join(two, "b").join(one, "a").where(alike(F.col("n_a"), F.col("n_b"), percent))
    return settle(compared.where(differing(F.col("x"), F.col("y")) <= most_bits(percent / 100)).select("a", "b"), "near-hubs")


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels (c, label) after links (a, b) of classes: each the smallest label that links reach."""
    one, two = (labels.select(F.col("c").alias(x), F.col("label").alias(f"of_{x}")) for x in "ab")
    between = links.join(one, "a").join(two, "b").select(F.least("of_a", "of_b").alias("a"), F.greatest("of_a", "of_b").alias("b"))
    roots = components(between.where("a < b").distinct())
    return settle(labels.join(roots, F.col("label") == F.col("node"), "left").select("c", F.coalesce("root", "label").alias("label")), "labels")


def open_blocks(keyed: DataFrame, labels: DataFrame, members: DataFrame, sets: DataFrame | None = None) -> DataFrame:
    """Blocks of members of buckets with several labels: key, block, held, and ``rest``, whether none has the bucket's most frequent label.

    A block holds about ``WIDE`` members, fewer if their sets are large.
    """
    marked = keyed.join(labels, "c")
    # A member counts for more than one where its set is large.
    load = F.sum(1 + F.col("n_shingles") / F.lit(SET_UNIT))
    sizes = marked.groupBy("key", "label").agg(F.count("*").alias("n"), load.alias("load"))
    sizes = sizes.groupBy("key").agg(
        F.count("*").alias("labels"), F.sum("load").alias("load"), F.max_by("label", "n").alias("most"), F.max_by("load", "n").alias("load_most")
    )
    open_ = marked.join(sizes.where("labels > 1"), "key")
    rest = F.col("label") != F.col("most")
    size = F.when(rest, F.col("load") - F.col("load_most")).otherwise(F.col("load_most"))
    block = F.pmod(F.xxhash64("c"), F.ceil(size / F.lit(WIDE)))
    placed = open_.select("key", "c", "label", "n_shingles", rest.alias("rest"), block.alias("block")).join(members, "c")
    held = ["c", "label", "n_shingles", "sketch", "keys"]
    if sets is not None:
        placed, held = placed.join(sets, "c"), [*held, "members"]
    return placed.groupBy("key", "rest", "block").agg(F.collect_list(F.struct(*held)).alias("held"))


class Side(NamedTuple):
    """A block's members, by column."""

    c: np.ndarray
    label: np.ndarray
    n: np.ndarray
    sketch: np.ndarray  # a row for each
    keys: np.ndarray
    sets: list[np.ndarray]


def unpacked(column: pa.Array) -> Iterator[Side]:
    for row in column:
        held = row.values
        plain = [held.field(f).to_numpy(zero_copy_only=False) for f in ("c", "label", "n_shingles")]
        # Unsigned, as numpy counts the bits of a negative number's size.
        sketch = held.field("sketch").flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, LONGS)
        keys = held.field("keys").flatten().to_numpy(zero_copy_only=False).reshape(-1, BANDS)
        sets = [x.values.to_numpy(zero_copy_only=False) for x in held.field("members")] if held.type.get_field_index("members") >= 0 else []
        yield Side(*plain, sketch, keys, sets)


def near_pairs(key: int, one: Side, two: Side, percent: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (places in one, in two) of other labels whose sketches are near and whose first shared band has this key, nearest first."""
    differ = np.bitwise_count(one.sketch[:, None, :] ^ two.sketch[None, :, :]).sum(axis=2, dtype=np.int64)
    fit = (one.label[:, None] != two.label[None, :]) & (differ <= most)
    fit &= 100 * np.minimum.outer(one.n, two.n) >= percent * np.maximum.outer(one.n, two.n)
    x, y = np.nonzero(fit)
    shared = one.keys[x] == two.keys[y]
    first = one.keys[x, shared.argmax(axis=1)] == key
    x, y = x[first], y[first]
    order = np.argsort(differ[x, y], kind="stable")
    return x[order], y[order]


def met(blocks: DataFrame) -> DataFrame:
    """Each block of rest members beside each block of its bucket."""
    own = blocks.where("rest").select("key", F.col("block").alias("_one"), F.col("held").alias("one"))
    all_ = blocks.select("key", "rest", F.col("block").alias("_two"), F.col("held").alias("two"))
    return own.join(all_, "key").where("not rest or _one <= _two").select("key", "one", "two")


def with_partners(blocks: DataFrame, percent: int) -> DataFrame:
    """The members (key, c) of blocks that have a partner of another label with a near sketch."""
    most = most_bits(percent / 100)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            found: set[tuple[int, int]] = set()
            for key, one, two in zip(batch.column("key").to_pylist(), unpacked(batch.column("one")), unpacked(batch.column("two")), strict=True):
                x, y = near_pairs(key, one, two, percent, most)
                found.update((key, c) for c in np.unique(np.concatenate([one.c[x], two.c[y]])).tolist())
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.int64()), pa.array([c for _, c in found], pa.int64())], ["key", "c"])

    return mapped(met(blocks), run, [], "key long, c long").distinct()


def linked_labels(blocks: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between classes of different labels, which connect all labels that a pair with similar sets connects."""
    most = most_bits(percent / 100)

    def run(batches: Batches) -> Batches:
        parent: dict[int, int] = {}

        def root(label: int) -> int:
            while (above := parent.get(label, label)) != label:
                parent[label] = parent.get(above, above)
                label = above
            return label

        for batch in batches:
            links = []
            for key, one, two in zip(batch.column("key").to_pylist(), unpacked(batch.column("one")), unpacked(batch.column("two")), strict=True):
                for i, j in zip(*(p.tolist() for p in near_pairs(key, one, two, percent, most)), strict=True):
                    p, q = root(int(one.label[i])), root(int(two.label[j]))
                    if p == q:
                        continue
                    shared = common(one.sets[i], two.sets[j])
                    if 100 * shared >= percent * (len(one.sets[i]) + len(two.sets[j]) - shared):
                        parent[max(p, q)] = min(p, q)
                        links.append((int(one.c[i]), int(two.c[j])))
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], ["a", "b"])

    return mapped(met(blocks), run, [], "a long, b long")


def common(one: np.ndarray, two: np.ndarray) -> int:
    """How many numbers two sorted arrays without repeats share."""
    small, large = (one, two) if len(one) <= len(two) else (two, one)
    at = np.searchsorted(large, small)
    return int((large[np.minimum(at, len(large) - 1)] == small).sum())


def class_links(docs: DataFrame, classes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The label of each class, from links that connect all classes whose sets are as similar."""
    keyed = classes.select("c", "n_shingles", F.explode("keys").alias("key"))
    verifier = Verifier(docs, classes, shingle, percent)
    labels = merged(classes.select("c", F.col("c").alias("label")), verifier.verified(hub_pairs(keyed, classes, percent)))
    light = settle(open_blocks(keyed, labels, classes.select("c", "sketch", "keys")), "light")
    partners = settle(with_partners(light, percent), "partners")
    asked = partners.select("c").distinct()
    some = classes.join(asked, "c", "left_semi").select("c", "n_shingles", "sketch", "keys")
    sets = verifier.known(asked).join(asked, "c", "left_semi")
    left = partners.join(some.select("c", "n_shingles"), "c")
    heavy = open_blocks(left, labels.join(asked, "c", "left_semi"), some.select("c", "sketch", "keys"), sets)
    return merged(labels, settle(linked_labels(heavy, percent), "links"))


def grouped(
    df: DataFrame, shingle: int = 2, percent: int = 80, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest id of its group), and kept (whether that is its own).

    Rows whose sets have a similarity of ``percent`` or more are linked.  Those without
    words or text are linked with nothing.  Null ids are never the smallest; a group of
    null ids alone has a null component_id and is kept.  Repeated rows are equal and each
    is kept if its id is the smallest.  Other columns aren't passed on; they are joined
    back by id.
    """
    docs = df.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    rows = settle(sketched(docs, shingle), "sketches")
    held = rows.where("digest is not null")
    sizes = held.groupBy("digest").agg(
        F.min("id").alias("first"), F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch")
    )
    classes = settle(sizes.withColumn("c", F.monotonically_increasing_id()), "classes")
    labels = class_links(docs, classes, shingle, percent)
    named = settle(classes.select("c", "digest", "first").join(labels, "c"), "named")
    lowest = settle(named.groupBy("label").agg(F.min("first").alias("component_id")), "lowest")
    groups = settle(named.join(lowest, "label").select(F.col("digest").alias("_digest"), F.col("component_id").alias("_lowest")), "groups")
    out = rows.select("id", "n_shingles", "digest").join(groups, F.col("digest") == F.col("_digest"), "left")
    component = F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("_lowest"))
    out = out.select("id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id"))).withColumnRenamed("id", id_col)
