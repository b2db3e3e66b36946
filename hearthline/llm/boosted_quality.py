"""A quality classifier: gradient-boosted trees over document statistics.

Statistics of all texts are computed in Spark and written once.  The trees are fitted on
the driver to at most ``max_rows`` labelled rows (a bounded sample: those with the
smallest hashes of their id), on histograms of at most ``BINS`` bins per statistic.  A
fitted model is a few arrays, one entry per node of complete binary trees, and a batch
walks down all trees at once with numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import col, sliced
from hearthline.llm.line_quality import repeat_words
from hearthline.llm.words import SPACE, Words
from hearthline.session import settle

BINS = 64


def of_bytes(*chars: bytes) -> np.ndarray:
    mask = np.zeros(256, bool)
    for c in chars:
        mask[list(c)] = True
    return mask


MARKS = {
    "symbols": of_bytes(b"#*$%&|<>{}[]\\^~_=+@"), "digits": of_bytes(b"0123456789"), "capitals": of_bytes(bytes(range(65, 91))),
    "points": of_bytes(b".,;:?"), "calls": of_bytes(b"!"), "blanks": SPACE, "lines": of_bytes(b"\n"), "wide": of_bytes(bytes(range(128, 256))),
}
FEATURES = (
    "words", "bytes", "word_mean", "word_longest", "word_short", *MARKS, "distinct", "adjacent", "commonest", "windows", "line_words", "ends", "opens"
)


def statistics(column: pa.Array) -> np.ndarray:
    """One row of numbers per text, in the order of FEATURES; all 0 for a text without words."""
    words = Words.of(column)
    content, begin, counts, owner = words.content, words.begin, words.counts(), words.owner()
    n = len(counts)
    sizes = words.ends - words.starts
    length = np.diff(begin)
    many, much = np.maximum(counts, 1), np.maximum(length, 1)

    def share(flags: np.ndarray, over: np.ndarray = many) -> np.ndarray:
        return np.bincount(owner, weights=flags, minlength=n) / over

    out = [np.log1p(counts), np.log1p(length), share(sizes)]
    longest = np.zeros(n)
    np.maximum.at(longest, owner, sizes)
    out += [np.minimum(longest, 200), share(sizes == 1)]
    for mark in MARKS.values():
        total = np.concatenate(([0], np.cumsum(mark[content])))
        out.append((total[begin[1:]] - total[begin[:-1]]) / much)
    codes, distinct = words.coded()
    keys, times = np.unique(owner * np.int64(max(1, len(distinct))) + codes, return_counts=True)
    of = keys // max(1, len(distinct))
    out.append(np.bincount(of, minlength=n) / many)
    same = np.zeros(len(codes), bool)
    same[1:] = (codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1])
    out.append(share(same))
    most = np.zeros(n)
    np.maximum.at(most, of, times)
    out += [most / many, repeat_words(words) / many]
    total = np.concatenate(([0], np.cumsum(MARKS["lines"][content])))
    out.append(np.log1p(counts / (1 + total[begin[1:]] - total[begin[:-1]])))
    out.append(share(MARKS["points"][content[words.ends - 1]] if len(sizes) else sizes))
    out.append(share(MARKS["capitals"][content[words.starts]] if len(sizes) else sizes))
    found = np.stack(out, axis=1)
    found[counts == 0] = 0
    return found


@dataclass
class Forest:
    """Flattened trees: per tree and node (children of i are 2i + 1 and 2i + 2) the statistic, its limit, and the leaf's value."""

    base: float
    depth: int
    feature: np.ndarray
    limit: np.ndarray
    value: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each row."""
        trees = np.arange(len(self.feature))
        node = np.zeros((len(x), len(trees)), np.int64)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[rows, self.feature[trees, node]] > self.limit[trees, node])
        return 1 / (1 + np.exp(-(self.base + self.value[trees, node].sum(axis=1))))


def fit(x: np.ndarray, y: np.ndarray, *, trees: int = 60, depth: int = 4, rate: float = 0.2, least: float = 5.0, smooth: float = 1.0) -> Forest:
    """Boosted trees for labels 0 and 1 by second-order steps on the logistic loss.

    Without rows, the score is 0.5 for all; with one label only, that label's smoothed share.
    """
    nodes = 2 ** (depth + 1) - 1
    share = (y.sum() + 0.5) / (len(y) + 1)
    forest = Forest(float(np.log(share / (1 - share))), depth, np.zeros((trees, nodes), np.int32), np.full((trees, nodes), np.inf), np.zeros((trees, nodes)))
    if len(np.unique(y)) < 2:
        return forest
    limits = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(limits[f], x[:, f], "left") for f in range(x.shape[1])], axis=1)
    raw = np.full(len(y), forest.base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            own = node - first
            g_all, h_all = np.bincount(own, grad, width), np.bincount(own, hess, width)
            best = np.full(width, 1e-6)
            for f in range(x.shape[1]):
                key = own * BINS + binned[:, f]
                g = np.bincount(key, grad, width * BINS).reshape(width, BINS).cumsum(axis=1)[:, :-1]
                h = np.bincount(key, hess, width * BINS).reshape(width, BINS).cumsum(axis=1)[:, :-1]
                g_right, h_right = g_all[:, None] - g, h_all[:, None] - h
                gain = g**2 / (h + smooth) + g_right**2 / (h_right + smooth) - (g_all**2 / (h_all + smooth))[:, None]
                gain[(h < least) | (h_right < least)] = 0
                gain[:, len(limits[f]) :] = 0
                at = gain.argmax(axis=1)
                top = gain[np.arange(width), at]
                better = np.flatnonzero(top > best)
                best[better] = top[better]
                forest.feature[t, first + better] = f
                forest.limit[t, first + better] = limits[f][at[better]]
            right = x[np.arange(len(y)), forest.feature[t, node]] > forest.limit[t, node]
            node = 2 * node + 1 + right
        first = 2**depth - 1
        g, h = np.bincount(node - first, grad, first + 1), np.bincount(node - first, hess, first + 1)
        forest.value[t, first:] = rate * g / (h + smooth)
        raw += forest.value[t, node]
    return forest


def remainder(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % 3


def classify(
    df: DataFrame, labels: DataFrame, *, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", max_rows: int = 30_000
) -> DataFrame:
    """Per row: doc_id, held_out, score and predicted.

    Labels are learned only from ids whose crc32 as text leaves another remainder by 3 than
    1; the others are held out.  An id with several labels counts as 1 where their mean is
    0.5 or more; null labels and labels of null ids don't count.  Without usable labels all
    scores are 0.5.  A null text has the statistics of an empty one; a null id is not held
    out.  Repeated rows have the same score.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sliced(batches, "text"):
            found = statistics(rows.column("text")).astype(np.float32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1) * found.shape[1], pa.int32()), pa.array(found.reshape(-1)))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), lists], ["doc_id", "stats"])

    own = df.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text"))
    measured = settle(own.mapInArrow(measure, f"doc_id {kind}, stats array<float>"), "statistics")
    mean = labels.select(col(id_col).alias("_id"), col(label_col).cast("double").alias("_y")).groupBy("_id").agg(F.avg("_y").alias("_y"))
    usable = mean.where(F.col("_y").isNotNull() & (remainder(F.col("_id")) != 1))
    known = measured.join(usable, measured["doc_id"] == usable["_id"]).select("doc_id", "stats", (F.col("_y") >= 0.5).cast("double").alias("y"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows).toPandas()
    x = np.array(sample["stats"].tolist(), np.float32).reshape(len(sample), len(FEATURES)).astype(np.float64)
    forest = fit(x, sample["y"].to_numpy(np.float64))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            x = rows.column("stats").flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1).astype(np.float64)
            parts = [forest.scores(x[at : at + 4096]) for at in range(0, len(x), 4096)]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(np.concatenate(parts or [np.zeros(0)]))], ["doc_id", "score"])

    held = F.coalesce(remainder(F.col("doc_id")) == 1, F.lit(False))
    scored = measured.mapInArrow(score, f"doc_id {kind}, score double")
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
