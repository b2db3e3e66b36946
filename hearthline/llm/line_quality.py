"""Quality rules: document statistics, and lines that too many documents of a host share.

1. Every line is normalised (ASCII letters lowered, digits as 0, blanks at its ends cut)
   and hashed; per host, the distinct documents that hold it are counted.  A document is
   its text, so exact copies count once and can't make their own lines frequent.
2. A line in more than ``share`` of a host's documents, and in more than ``least`` of
   them, is over the limit.  A document has few of its lines over the limit, so a host
   has at most (lines of a document / share) such lines, and they travel as one array.
3. These lines are removed; a document is rejected as depleted when less than
   ``min_left`` of its words are left.

Near copies can be counted as one too (``near_once``).  Steps 1 and 2 then give
candidates only.  A document is a near copy of others when less than ``min_left`` of its
words are outside lines that reach half the limit, and all such documents of a host with
the same rarest candidate line count as one when the candidates are counted again: lines that only near copies share are not over the limit,
and those that other documents or many groups of near copies hold still are.

With a ``share`` of 0 the limit is ``least`` alone, the same at every size of a host.  A
host's lines over the limit are then as many as its texts allow, so use ``near_once``,
under which every text carries its own such lines only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import col, mapped, numbered, restored, returned, sliced
from hearthline.llm.words import SPACE, Words, fits, gram_hashes, mixed
from hearthline.session import settle

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", "abcdefghijklmnopqrstuvwxyz000000000"
FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
WINDOW = 8
SEED = 42  # of Spark's xxhash64

STATISTICS = {
    "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long",
    "base_failed": "boolean", "n_lines_removed": "long", "n_words_left": "long", "kept": "boolean",
}


@dataclass(frozen=True)
class Limits:
    """Production limits; the base rules are those of the statistics' contract."""

    share: float = 0.1
    least: int = 20
    min_words: int = 20
    min_left: float = 0.3
    max_repeat_pct: int = 30


def normalised(line: Column) -> Column:
    return F.trim(F.translate(line, UPPER, LOWER), F.lit(BLANKS))


def line_key(line: bytes) -> int:
    """The hash of a normalised line as Spark's xxhash64 gives it."""
    return np.int64(np.uint64(xxhash.xxh64_intdigest(line.translate(FOLD).strip(BLANKS.encode()), SEED))).item()


def frequent_lines(df: DataFrame, host_col: str = "source", text_col: str = "text", limits: Limits = Limits()) -> DataFrame:
    """Per host, the hashes of the lines over the limit: host, lines.

    Distinct (host, line, document) rows are counted in two steps, each combined before
    its shuffle, so that neither a hot host nor a line in every document meets in a task.
    """
    over = counted_lines(hashed(df, host_col, text_col), limits)
    return over.groupBy("host").agg(F.collect_list("line").alias("lines"))


def hashed(df: DataFrame, host_col: str, text_col: str) -> DataFrame:
    """The texts with their host and hash: host, text, doc."""
    docs = df.select(col(host_col).cast("string").alias("host"), col(text_col).cast("string").alias("text")).where(F.col("text").isNotNull())
    return docs.withColumn("doc", F.xxhash64("text"))


def counted_lines(docs: DataFrame, limits: Limits) -> DataFrame:
    """The lines over the limit, one row each: host, line, and the number of distinct texts n that hold it."""
    lines = docs.select("host", "doc", F.explode(F.split("text", "\n")).alias("line")).select("host", "doc", normalised(F.col("line")).alias("line"))
    counts = (
        lines.where("line <> ''").select("host", "doc", F.xxhash64("line").alias("line")).distinct()
        .groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") > limits.least)
    )
    if not limits.share:
        return counts
    sizes = docs.groupBy("host", "doc").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count("*").alias("n_docs"))
    sized = counts.join(sizes, counts["host"].eqNullSafe(sizes["host"]))
    return sized.where(F.col("n") > limits.share * F.col("n_docs")).select(counts["host"], "line", "n")


def held_lines(docs: DataFrame, limits: Limits) -> DataFrame:
    """Per text that holds lines over the limit, near copies counted as one: host, doc and these lines.

    Candidates are joined to the lines of the texts one by one, so a text carries only its
    own.  Near copies differ in few lines, so nearly all of a group have one rarest candidate.
    """
    # In a group just over the limit, some lines have changed so often that they are under it.
    half = replace(limits, share=limits.share / 2, least=limits.least // 2)
    candidates = settle(counted_lines(docs, half), "candidates").withColumnRenamed("host", "_host")
    lines = docs.select("host", "doc", F.regexp_count("text", F.lit(WORD)).alias("words"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = lines.select(
        "host", "doc", "words", "pos", F.xxhash64(normalised(F.col("line"))).alias("_line"), F.regexp_count("line", F.lit(WORD)).alias("own"),
        F.substring(F.md5(normalised(F.col("line")).cast("binary")), 1, 16).alias("name"),
    )
    found = lines.join(candidates, F.col("host").eqNullSafe(F.col("_host")) & (F.col("_line") == F.col("line")))
    # Exact copies are one text, which holds a line once at each place.
    once = found.groupBy("host", "doc", "pos").agg(*[F.first(c).alias(c) for c in ("words", "own", "line", "n", "name")])
    candidate = F.col("n") > limits.least
    texts = once.groupBy("host", "doc").agg(
        F.first("words").alias("words"), F.sum("own").alias("common"),
        F.min(F.when(candidate, F.struct("n", "name"))).alias("rarest"), F.collect_set(F.when(candidate, F.col("line"))).alias("lines"),
    ).where("rarest is not null")
    near = F.col("words") - F.col("common") < limits.min_left * F.col("words")
    held = settle(texts.select("host", "doc", near.alias("near"), F.when(near, F.col("rarest.name")).otherwise(F.hex("doc")).alias("mark"), "lines"), "held")
    each = held.select("host", "doc", "near", "mark", F.explode("lines").alias("line"))
    over = each.groupBy("host", "line", "near", "mark").agg(F.lit(1).alias("one")).groupBy("host", "line").agg(F.count("*").alias("n"))
    over = over.where(F.col("n") > limits.least)
    if limits.share:
        # Near copies are one document of their host's size as well.
        copies = held.where("near").groupBy("host", "mark").agg(F.count("*").alias("n")).groupBy("host").agg(F.sum(F.col("n") - 1).alias("fewer"))
        sizes = docs.groupBy("host", "doc").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count("*").alias("n_docs"))
        sizes = sizes.join(copies.withColumnRenamed("host", "_host"), F.col("host").eqNullSafe(F.col("_host")), "left")
        sizes = sizes.select(F.col("host").alias("_host"), (F.col("n_docs") - F.coalesce("fewer", F.lit(0))).alias("n_docs"))
        over = over.join(sizes, F.col("host").eqNullSafe(F.col("_host"))).where(F.col("n") > limits.share * F.col("n_docs")).drop("_host")
    over = settle(over.select(F.col("host").alias("_host"), F.col("line").alias("_line")), "over")
    left = each.join(over, F.col("host").eqNullSafe(F.col("_host")) & (F.col("line") == F.col("_line")))
    return left.groupBy("host", "doc").agg(F.collect_list("line").alias("lines"))


def repeat_words(words: Words, window: int = WINDOW) -> np.ndarray:
    """Per text, the words in windows that its words hold twice or more."""
    hashes = words.hashes()
    grams = gram_hashes(hashes, window)
    own = np.flatnonzero(fits(words.first, window, len(grams)))
    owner = words.owner()
    if not len(own):
        return np.zeros(len(words.first) - 1, np.int64)
    keys = mixed(grams[own] + owner[own].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    again = np.zeros(len(own), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edges = np.zeros(len(hashes) + window + 1, np.int64)
    np.add.at(edges, own[again], 1)
    np.add.at(edges, own[again] + window, -1)
    covered = np.cumsum(edges)[: len(hashes)] > 0
    return np.bincount(owner[covered], minlength=len(words.first) - 1)


def per_text(mask: np.ndarray, begin: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(mask)))
    return total[begin[1:]] - total[begin[:-1]]


def judged(rows: pa.RecordBatch, limits: Limits) -> tuple[dict[str, np.ndarray], list[str | None]]:
    """Statistics and verdict of each row's ``text`` against the ``_lines`` of its host, and the texts without them."""
    column = rows.column("text")
    words = Words.of(column)
    content, begin, n_words = words.content, words.begin, words.counts()
    solid = ~SPACE[content]
    n = rows.num_rows
    dups, removed, left = np.zeros(n, np.int64), np.zeros(n, np.int64), n_words.copy()
    texts: list[str | None] = []
    data, places = content.tobytes(), begin.tolist()
    for k, (present, frequent) in enumerate(zip(column.is_valid().to_pylist(), rows.column("_lines").to_pylist(), strict=True)):
        if not present:
            texts.append(None)
            continue
        raw = data[places[k] : places[k + 1]]
        lines = raw.split(b"\n")
        if len(lines) > 1:
            filled = [x for x in lines if x.strip(BLANKS.encode())]
            dups[k] = len(filled) - len(set(filled))
        if frequent:
            over = set(frequent)
            stay = [x for x in lines if line_key(x) not in over]
            removed[k] = len(lines) - len(stay)
            if removed[k]:
                raw = b"\n".join(stay)
                left[k] = len(raw.split())
        texts.append(raw.decode())
    repeats = repeat_words(words)
    failed = (n_words < limits.min_words) | (100 * repeats > limits.max_repeat_pct * n_words)
    depleted = (removed > 0) & (left < limits.min_left * n_words)
    found = {
        "n_words": n_words, "word_chars": per_text(solid & ((content & 0xC0) != 0x80), begin),
        "n_symbols": per_text(SYMBOLS[content], begin), "n_dup_lines": dups, "n_repeat_words": repeats,
        "base_failed": failed, "n_lines_removed": removed, "n_words_left": left, "kept": ~failed & ~depleted,
    }
    return found, texts


def judge(df: DataFrame, host_col: str = "source", text_col: str = "text", limits: Limits = Limits(), near_once: bool = False) -> DataFrame:
    """All rows with their statistics and verdict, and ``clean_text``, the text without the lines over the limit.

    Rejected rows are marked, not dropped.  A null text has no words, fails the base rules
    and stays null.  Rows of a null host belong to one host.  Repeated rows are judged
    alike.  Input columns named like a result are replaced; others pass through.  The
    lines over the limit are written first, so Spark knows their size when it chooses
    how to join them to the documents.  ``near_once``: near copies count as one document.
    """
    plain, names = numbered(df)
    return restored(judged_rows(plain, names[host_col], names[text_col], limits, near_once), df, names, *STATISTICS, "clean_text")


def judged_rows(df: DataFrame, host_col: str, text_col: str, limits: Limits, near_once: bool = False) -> DataFrame:
    names = {"host": "_host", "doc": "_doc", "lines": "_lines"}
    kept = df.columns
    same = F.col(host_col).cast("string").eqNullSafe(F.col("_host"))
    if near_once:
        # Hashed, as sorting whole documents takes the memory that Python needs beside it.
        frequent = settle(held_lines(hashed(df, host_col, text_col), limits), "lines").withColumnsRenamed(names).hint("shuffle_hash")
        same = same & (F.xxhash64(F.col(text_col).cast("string")) == F.col("_doc"))
    else:
        frequent = settle(frequent_lines(df, host_col, text_col, limits), "lines").withColumnsRenamed(names)
    joined = df.join(frequent, same, "left").drop("_host", "_doc")
    added = ", ".join([*(f"{n} {t}" for n, t in STATISTICS.items()), "clean_text string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sliced(batches, text_col):
            found, texts = judged(rows.select([text_col, "_lines"]).rename_columns(["text", "_lines"]), limits)
            columns = [rows.column(c) for c in kept] + [pa.array(v) for v in found.values()]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], [*kept, *found, "clean_text"])

    return mapped(joined, returned(run), kept, added)


def accepted(df: DataFrame, host_col: str = "source", text_col: str = "text", limits: Limits = Limits(), near_once: bool = False) -> DataFrame:
    """The rows that are kept, in their own columns, with the lines over the limit removed from the text.

    ``near_once``: near copies count as one document, so a group of them doesn't reject itself.
    """
    plain, names = numbered(df)
    found = judged_rows(plain, names[host_col], names[text_col], limits, near_once).where("kept")
    return restored(found.withColumn(names[text_col], F.col("clean_text")), df, names)
