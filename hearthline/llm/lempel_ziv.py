"""Substring duplicates by parsing each document against the text before it.

The corpus, in the order of its ids, is the reference.  It is numbered through word by
word and cut into blocks (range partitions); a place in it is one number.

Index.  From every run of ``reach`` grams of ``gram`` words the smallest hash is an
anchor, and ``reach + gram - 1`` is the shortest factor, so equal stretches of that many
words have an anchor in common.  Anchors that occur once in all blocks are dropped; of the
others, the index has the first place.

Parse.  The anchors of a document that lie at one distance from their places in one source
are a chain.  The source's block hands out its words around the chain, as far as windows with
its anchors reach, where the next chain begins if the text goes on as in another source.  The
document is matched with them word by word, to the left and to the right of the anchors as
far as the words are equal.  Of the matches of at least the shortest factor's length, each next
factor is that which reaches furthest; it is told by its source's place.

Borders.  An anchor's first place need not be that of the longest match.  So the windows
of the shortest factor's length that lie around repeated anchors and in no match, across
the borders of factors above all, are looked up among each other by hash: one that lies
earlier in any block is a duplicate as well.  The earliest window of its kind is in no
match, so none is missed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearthline.llm.common import mapped, numbered, restored, returned, sliced
from hearthline.llm.words import Words, fits, gram_hashes, lowest_of, mixed
from hearthline.session import release, settle

GRAM = 8
SEED = 11
OTHER = np.uint64(0xD6E8FEB86659FD93)  # for a second hash of the same words
FAR = 200  # words between anchors of one chain at most


def anchors(words: Words, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first word of each window in a text, the word its anchor begins at, and the hash of each gram."""
    grams = gram_hashes(hashes, GRAM)
    n = max(0, len(hashes) - length + 1)
    window = np.flatnonzero(fits(words.first, length, n))
    return window, lowest_of(grams, length - GRAM + 1)[window] if len(window) else window, grams


def reference(df: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    """The documents in order with their ``_place`` (words before, in all blocks), words, and anchors.

    Null ids come first; equal ids are ordered by a hash of their text.  Documents without
    words share a place, and have no anchors.
    """
    kept = df.columns
    keys = (F.col(id_col).asc_nulls_first(), F.xxhash64(text_col))
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for rows in sliced(batches, text_col):
            words = Words.of(rows.column(text_col))
            _, at, grams = anchors(words, words.hashes(SEED), length)
            at = at[np.flatnonzero(np.diff(at, prepend=-1))]
            edges = pa.array(np.searchsorted(at, words.first), pa.int32())
            inner = at - words.first[np.searchsorted(words.first, at, "right") - 1]
            counts = words.counts()
            yield pa.RecordBatch.from_arrays(
                [
                    *(rows.column(c) for c in kept), pa.array(np.full(rows.num_rows, part, np.int32)),
                    pa.array(before + np.cumsum(counts) - counts), pa.array(counts),
                    pa.ListArray.from_arrays(edges, pa.array(inner, pa.int32())),
                    pa.ListArray.from_arrays(edges, pa.array(grams[at].view(np.int64))),
                ],
                [*kept, "_part", "_place", "_words", "_anchors", "_hashes"],
            )
            before += int(counts.sum())

    stored = settle(mapped(ordered, returned(run), kept, "_part int, _place long, _words long, _anchors array<int>, _hashes array<long>"), "reference")
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = stored.groupBy(F.col("_part").alias("_block")).agg(F.sum("_words").alias("_n"))
    # One row per block; their number is that of Spark's partitions.
    bases = blocks.select("_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    placed = stored.join(F.broadcast(bases), F.col("_part") == F.col("_block"))
    return placed.withColumn("_place", F.col("_place") + F.col("_base")).drop("_part", "_block", "_base")


def repeated_anchors(corpus: DataFrame) -> DataFrame:
    """(_place, _repeated): the anchors of each document that occur elsewhere too, each with its first place, as a document and a word of it."""
    listed = corpus.select("_place", F.explode(F.arrays_zip("_anchors", "_hashes")).alias("a")).select(
        "_place", F.col("a._anchors").alias("at"), F.col("a._hashes").alias("hash")
    )
    # Documents are in the order of their places, so the smallest of each belong together.
    firsts = listed.groupBy("hash").agg(F.count("*").alias("n"), F.min(F.col("_place") + F.col("at")).alias("first"), F.min("_place").alias("source"))
    # Written, so that the join's shuffles are its own and a hot anchor's rows can be split among tasks.
    shared = settle(firsts.where("n > 1").select("hash", "source", (F.col("first") - F.col("source")).cast("int").alias("source_at")), "shared")
    out = settle(listed.join(shared, "hash").groupBy("_place").agg(F.collect_list(F.struct("at", "source", "source_at")).alias("_repeated")), "repeated")
    release(shared)
    return out


def chains(repeated: DataFrame) -> DataFrame:
    """Anchors of a document at one distance from one source: _place, and ``at``, where ``source_at`` of ``source`` lies in it.

    The source's words from ``source_at`` to ``source_until`` hold the chain; in long chains
    they reach further, and ``at`` may lie before the document.
    Chains with many anchors come first, and one that lies within those before isn't asked
    for: its words are most likely theirs as well, and if not, they are looked up as windows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            lists = rows.column("_repeated")
            doc = np.repeat(np.arange(rows.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            at, source, source_at = (lists.flatten().field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("at", "source", "source_at"))
            place = rows.column("_place").to_numpy()[doc]
            later = (source != place) | (source_at != at)
            doc, at, source, place, distance = (x[later] for x in (doc, at, source, place, source_at - at))
            order = np.lexsort((at, distance, source, doc))
            doc, at, source, place, distance = (x[order] for x in (doc, at, source, place, distance))
            fresh = np.ones(len(doc), bool)
            fresh[1:] = (np.diff(doc) != 0) | (np.diff(source) != 0) | (np.diff(distance) != 0) | (np.diff(at) > FAR)
            first = np.flatnonzero(fresh)
            last = np.append(first[1:], len(doc)) - 1 if len(first) else first
            kept = outermost(doc[first], at[first], at[last], last - first)
            first, last = first[kept], last[kept]
            # Ends are rounded outwards, the more the longer a chain, so that few different passages are asked of a source.
            step = 1 << np.maximum(3, np.log2(np.maximum(at[last] - at[first], 1)).astype(np.int64) - 2)
            begin, until = at[first] + distance[first], at[last] + distance[first]
            more = begin % step
            columns = [place[first], at[first] - more, source[first], begin - more, -(-until // step) * step]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], CHAIN)

    return mapped(repeated, returned(run), [], ", ".join(f"{c} long" for c in CHAIN))


def outermost(doc: np.ndarray, first: np.ndarray, last: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The stretches that aren't within heavier ones of their document."""
    kept = []
    covered, current = np.zeros(0, bool), -1
    until = np.zeros(int(doc.max(initial=-1)) + 1, np.int64)
    np.maximum.at(until, doc, last + 1)
    order = np.lexsort((first, -weight, doc))
    for k, d, a, b in zip(order.tolist(), doc[order].tolist(), first[order].tolist(), last[order].tolist(), strict=True):
        if d != current:
            covered, current = np.zeros(int(until[d]), bool), d
        if not covered[a : b + 1].all():
            covered[a : b + 1] = True
            kept.append(k)
    return np.array(kept, np.int64)


CHAIN = ["_place", "at", "source", "source_at", "source_until"]


def handed_out(corpus: DataFrame, found: DataFrame, text_col: str, length: int) -> DataFrame:
    """(_place, _given): of each document, its chains with the hashes of the source's words around them.

    A passage that many documents ask for is cut out of its source once.
    """
    asked = found.select("source", "source_at", "source_until").distinct()
    asked = asked.groupBy("source").agg(F.collect_list(F.struct("source_at", "source_until")).alias("_asked"))
    texts = corpus.where(F.col("_words") >= length).select("_place", F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sliced(batches, "text"):
            words = Words.of(rows.column("text"))
            hashes, lists = words.hashes(SEED), rows.column("_asked")
            doc = np.repeat(np.arange(rows.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            first, last = (lists.flatten().field(f).to_numpy(zero_copy_only=False) for f in ("source_at", "source_until"))
            # A window around an anchor has so many words beside it at most.
            beside = length - GRAM
            begin = words.first[doc] + np.maximum(first - beside, 0)
            end = np.minimum(words.first[doc] + last + GRAM + beside, words.first[doc + 1])
            passages = [hashes[a:b].tobytes() for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
            lead = words.first[doc] + first - begin
            columns = [pa.array(rows.column("_place").to_numpy()[doc]), pa.array(first), pa.array(last), pa.array(lead), pa.array(passages, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["source", "source_at", "source_until", "lead", "passage"])

    sources = texts.join(asked, F.col("_place") == F.col("source")).select("_place", "text", "_asked")
    shape = "source long, source_at long, source_until long, lead long, passage binary"
    passages = settle(mapped(sources, returned(run), [], shape), "passages")
    given = found.join(passages, ["source", "source_at", "source_until"])
    entry = F.struct("at", (F.col("source") + F.col("source_at")).alias("from"), "lead", "passage")
    out = settle(given.groupBy("_place").agg(F.collect_list(entry).alias("_given")), "given")
    release(passages)
    return out


def matches(words: Words, hashes: np.ndarray, given: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, end, and the source's place of all matches of at least ``length`` words with the passages handed out, by first word."""
    lists = given.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    entries = given.flatten()
    doc = np.repeat(np.arange(len(lists)), lists)
    at, source, lead = (entries.field(f).to_numpy(zero_copy_only=False) for f in ("at", "from", "lead"))
    begin, end = words.first[doc], words.first[doc + 1]
    # Where the passage's first word would lie in the document.
    origin = begin + at - lead
    found: list[tuple[int, int, int]] = []
    for o, lo, hi, s, n, passage in zip(origin.tolist(), begin.tolist(), end.tolist(), source.tolist(), lead.tolist(), entries.field("passage"), strict=True):
        theirs = np.frombuffer(passage.as_buffer(), np.uint64)
        a, b = max(o, lo), min(o + len(theirs), hi)
        equal = np.zeros(b - a + 2, bool)
        equal[1:-1] = hashes[a:b] == theirs[a - o : b - o]
        edges = np.flatnonzero(equal[1:] != equal[:-1]).tolist()
        for x, y in zip(edges[::2], edges[1::2], strict=True):
            if y - x >= length:
                found.append((a + x, a + y, s - n + a + x - o))
    found.sort()
    return tuple(np.array([m[i] for m in found], np.int64) for i in range(3))


def inside(first: np.ndarray, end: np.ndarray, n: int, length: int) -> np.ndarray:
    """For each of n + 1 words, whether the window from it on lies in a match."""
    edges = np.zeros(n + 2, np.int64)
    np.add.at(edges, first, 1)
    np.add.at(edges, end - length + 1, -1)
    return np.cumsum(edges)[: n + 1] > 0


def greedy(first: np.ndarray, end: np.ndarray) -> list[int]:
    """The matches that are factors: from each place on that which reaches furthest, for matches ordered by first word."""
    out: list[int] = []
    firsts, ends = first.tolist(), end.tolist()
    k, at = 0, -1
    while k < len(ends):
        at, best = max(at, firsts[k]), -1
        while k < len(ends) and firsts[k] <= at:
            if ends[k] > (ends[best] if best >= 0 else at):
                best = k
            k += 1
        if best >= 0:
            out.append(best)
            at = ends[best]
    return out


def candidates(words: Words, repeated: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The first words of the windows whose anchor is repeated, and the hashes of all words.

    ``repeated`` lists, per text, the words its repeated anchors begin at.
    """
    hashes = words.hashes(SEED)
    window, at, _ = anchors(words, hashes, length)
    flags = np.zeros(len(hashes) + 1, bool)
    sizes = repeated.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flags[np.repeat(words.first[:-1], sizes) + repeated.flatten().to_numpy(zero_copy_only=False)] = True
    return window[flags[at]], hashes


def first_windows(corpus: DataFrame, lists: DataFrame, text_col: str, length: int) -> DataFrame:
    """(_place, firsts): of each document, the windows around repeated anchors that lie in no match and nowhere before.

    The windows are compared by 96 bits of hash.
    """
    own = corpus.select("_place", "_words", F.col(text_col).alias("text")).where(F.col("_words") >= length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sliced(batches, "text"):
            words = Words.of(rows.column("text"))
            found, hashes = candidates(words, rows.column("_repeated"), length)
            first, end, _ = matches(words, hashes, rows.column("_given"), length)
            found = found[~inside(first, end, len(hashes), length)[found]]
            doc = np.searchsorted(words.first, found, "right") - 1
            place = rows.column("_place").to_numpy()[doc]
            one, two = (gram_hashes(h, length)[found] for h in (hashes, mixed(hashes ^ OTHER)))
            codes = pa.array(one.view(np.int64)), pa.array((two >> np.uint64(32)).astype(np.uint32).view(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*codes, pa.array(place), pa.array(place + found - words.first[doc])], ["one", "two", "doc", "at"]
            )

    windows = own.join(lists, "_place").select("text", "_place", "_repeated", "_given").mapInArrow(returned(run), "one long, two int, doc long, at long")
    firsts = windows.groupBy("one", "two").agg(F.min("at").alias("at"), F.min("doc").alias("doc"))
    return firsts.groupBy(F.col("doc").alias("_place")).agg(F.collect_list((F.col("at") - F.col("doc")).cast("int")).alias("_firsts"))


class Parse(NamedTuple):
    """Words of a batch, which of them are duplicates, the spans of these, and the factors."""

    words: Words
    gone: np.ndarray
    opens: np.ndarray
    closes: np.ndarray
    first: np.ndarray  # of each factor, as its end and its source's place (-1: found at a border)
    end: np.ndarray
    source: np.ndarray


def parsed(rows: pa.RecordBatch, text_col: str, length: int) -> Parse:
    words = Words.of(rows.column(text_col))
    found, hashes = candidates(words, rows.column("_repeated"), length)
    first, end, source = matches(words, hashes, rows.column("_given"), length)
    covered = inside(first, end, len(hashes), length)
    firsts = rows.column("_firsts")
    sizes = firsts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    border = np.zeros(len(hashes) + 1, bool)
    border[found] = True
    border[covered] = False
    border[np.repeat(words.first[:-1], sizes) + firsts.flatten().to_numpy(zero_copy_only=False)] = False
    opens, closes = spans(covered | border, length)
    at_borders = spans(border, length)
    chosen = greedy(first, end)
    first, end = np.concatenate([first[chosen], at_borders[0]]), np.concatenate([end[chosen], at_borders[1]])
    source = np.concatenate([source[chosen], np.full(len(at_borders[0]), -1)])
    order = np.argsort(first, kind="stable")
    edges = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edges, opens, 1)
    np.add.at(edges, closes, -1)
    return Parse(words, np.cumsum(edges)[:-1] > 0, opens, closes, first[order], end[order], source[order])


def spans(windows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First words and ends of the stretches that consecutive windows cover; none reaches into the next text."""
    window = np.flatnonzero(windows)
    opens = window[np.flatnonzero(np.diff(window, prepend=-2) > 1)]
    closes = window[np.flatnonzero(np.diff(window, append=len(windows) + 1) > 1)] + length
    return opens, closes


RESULTS = ["n_words", "n_removed", "kept_sha256", "factors", "clean_text"]
TYPES = "n_words long, n_removed long, kept_sha256 string, factors array<struct<first:int,last:int,source:long>>"


def parse(df: DataFrame, length: int = 20, *, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """All rows with their duplicate spans.

    Adds n_words, n_removed, kept_sha256 (of the kept words joined by a space), factors
    (first word, end and the place of the source in the corpus, null for those found at
    borders; together they are the duplicate spans) and clean_text: the text without the
    spans, each cut up to the next kept word.  Null texts have no words and stay null.
    Of repeated rows the first in order is the source of the others.  Columns named like
    a result are replaced.
    """
    plain, names = numbered(df)
    found = parsed_rows(plain, length, names[id_col], names[text_col], with_text)
    return restored(found, df, names, *RESULTS[: 4 + with_text])


def parsed_rows(df: DataFrame, length: int, id_col: str, text_col: str, with_text: bool) -> DataFrame:
    if length <= GRAM:
        raise ValueError(f"factors have more than {GRAM} words")
    corpus = reference(df, id_col, text_col, length)
    repeated = repeated_anchors(corpus)
    found = settle(chains(repeated), "chains")
    given = handed_out(corpus, found, text_col, length)
    release(found)
    lists = repeated.select("_place", F.col("_repeated.at").alias("_repeated")).join(given, "_place", "left")
    firsts = settle(first_windows(corpus, lists, text_col, length), "firsts")
    kept = df.columns
    # Documents without a window may share their place with others and have no entry in either list;
    # they get keys of their own, which no place has, so that they don't meet in one task.
    listed = F.when(F.col("_words") >= length, F.col("_place")).otherwise(F.least(F.lit(-1), F.xxhash64(id_col, text_col)))
    own = corpus.select(*kept, listed.alias("_listed"))
    lists = lists.join(firsts, "_place", "left")
    joined = own.join(lists, F.col("_listed") == F.col("_place"), "left").drop("_listed", "_place")
    added = TYPES + ", clean_text string" * with_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sliced(batches, text_col):
            found = parsed(rows, text_col, length)
            words, gone = found.words, found.gone
            counts = words.counts()
            total = np.concatenate(([0], np.cumsum(gone)))
            removed = total[words.first[1:]] - total[words.first[:-1]]
            doc = np.searchsorted(words.first, found.first, "right") - 1
            factors = pa.StructArray.from_arrays(
                [
                    pa.array(found.first - words.first[doc], pa.int32()), pa.array(found.end - words.first[doc], pa.int32()),
                    pa.array(found.source, pa.int64(), mask=found.source < 0),
                ],
                ["first", "last", "source"],
            )
            edges = pa.array(np.searchsorted(found.first, words.first), pa.int32())
            columns = [
                *(rows.column(c) for c in kept), pa.array(counts), pa.array(removed), pa.array(digests(words, gone)),
                pa.ListArray.from_arrays(edges, factors),
            ]
            if with_text:
                columns.append(pa.array(cleaned(words, removed, found.opens, found.closes, rows.column(text_col)), pa.string()))
            yield pa.RecordBatch.from_arrays(columns, [*kept, *RESULTS[: 4 + with_text]])

    return mapped(joined, returned(run), kept, added)


def digests(words: Words, gone: np.ndarray) -> list[str]:
    """SHA-256 of each text's kept words, joined by a space."""
    data = words.content.tobytes()
    starts, ends = words.starts.tolist(), words.ends.tolist()
    found, keep = [], ~gone
    for k in range(len(words.first) - 1):
        a, b = int(words.first[k]), int(words.first[k + 1])
        if keep[a:b].all():
            joined = b" ".join(data[words.begin[k] : words.begin[k + 1]].split())
        else:
            joined = b" ".join([data[starts[w] : ends[w]] for w in (np.flatnonzero(keep[a:b]) + a).tolist()])
        found.append(hashlib.sha256(joined).hexdigest())
    return found


def cleaned(words: Words, removed: np.ndarray, opens: np.ndarray, closes: np.ndarray, texts: pa.Array) -> list[str | None]:
    """The texts without the words from each open to its close, up to the next kept word."""
    out: list[str | None] = []
    data, n_words = words.content.tobytes(), len(words.starts)
    at = np.searchsorted(opens, words.first)
    for k, present in enumerate(texts.is_valid().to_pylist()):
        begin, end = int(words.begin[k]), int(words.begin[k + 1])
        if not present:
            out.append(None)
        elif not removed[k]:
            out.append(data[begin:end].decode())
        else:
            parts, last = [], begin
            for a, b in zip(opens[at[k] : at[k + 1]].tolist(), closes[at[k] : at[k + 1]].tolist(), strict=True):
                if (cut := int(words.starts[a])) > last:
                    parts.append(data[last:cut])
                last = max(last, int(words.starts[b]) if b < n_words and b < words.first[k + 1] else end)
            out.append(b"".join([*parts, data[last:end]]).decode())
    return out


def without_duplicates(df: DataFrame, length: int = 20, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows in their own columns, with the duplicate spans cut out of the text."""
    plain, names = numbered(df)
    found = parsed_rows(plain, length, names[id_col], names[text_col], True)
    return restored(found.withColumn(names[text_col], F.col("clean_text")), df, names)
