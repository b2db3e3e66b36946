"""Importance resampling towards a target distribution.

Documents are drawn by their log-likelihood ratio under two bags of hashed word runs,
that of the target texts and that of the documents, plus seeded Gumbel noise.

1. Each text is read once: its features' buckets are written as an array beside its id.
2. Both sides' bucket counts (``buckets`` numbers each) give an integer gain per bucket,
   and a document's weight is the sum of its buckets' gains, worked out array by array.
3. The draw takes the highest scores.  A quantile sketch (KLL, merged in two steps) names
   a bracket of scores around the cutoff.  The documents above and within the bracket are
   counted exactly; if the cutoff isn't inside, the bracket is widened and counted again.
   Then only the bracket is sorted, and the row that fills the draw is the cutoff.
4. Rows before the cutoff are drawn; their ranks come from ranges of scores.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import Batches, col, mapped, others, placed, sliced
from hearthline.llm.words import Words, slices, text_bytes
from hearthline.session import settle

FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A") : ord("Z") + 1] += 32
# What no word holds: ASCII other than digits and small letters.
APART = np.ones(256, bool)
APART[0x30:0x3A] = APART[0x61:0x7B] = APART[0x80:] = False
SKETCH = 4096  # size of the quantile sketch; its ranks are right to about 0.1 % of the rows
GROUPS = 64  # sketches that are merged at last
MARGIN = 0.004  # the bracket's first half width, as a share of the rows


def features(column: pa.Array, runs: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text the number of words and of features, and of all features in order their buckets.

    Features are all runs of 1 to ``runs`` consecutive words of a text, joined by a space.
    """
    content, begin = text_bytes(column)
    content = FOLD[content]
    words = Words.parted(content, begin, APART)
    counts, sizes = words.counts(), words.ends - words.starts
    codes, distinct = words.coded(APART)
    found, owners = [], []
    for n in range(1, runs + 1):
        first = np.flatnonzero(np.arange(len(codes)) + n <= np.repeat(words.first[1:], counts)) if len(codes) else np.zeros(0, np.int64)
        if n == 1:
            spelled, numbers = distinct, codes
        else:
            spelled, numbers = joined_runs(words, sizes, first, n)
        table = np.fromiter((zlib.crc32(w) % buckets for w in spelled.to_pylist()), np.int64, len(spelled))
        found.append(table[numbers] if len(numbers) else np.zeros(0, np.int64))
        owners.append(words.owner()[first])
    owner, bucket = np.concatenate(owners), np.concatenate(found)
    order = np.argsort(owner, kind="stable")
    return counts, np.bincount(owner, minlength=len(counts)), bucket[order]


def joined_runs(words: Words, sizes: np.ndarray, first: np.ndarray, n: int) -> tuple[pa.Array, np.ndarray]:
    """The distinct runs of n words, and the number of the run from each first word on."""
    begin = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes + 1, out=begin[1:])
    spaced = np.full(int(begin[-1]), 0x20, np.uint8)
    spaced[np.arange(int(sizes.sum())) + np.repeat(np.arange(len(sizes)), sizes)] = words.content[~APART[words.content]]
    data = memoryview(spaced)
    spelled = pa.array([bytes(data[a:b]) for a, b in zip(begin[first].tolist(), (begin[first + n] - 1).tolist(), strict=True)], pa.binary())
    coded = spelled.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)


def bucketed(df: DataFrame, kept: list[str], text_col: str, runs: int, buckets: int) -> DataFrame:
    """The rows' ``kept`` columns with n_words, n_features, and the buckets of all features as an array of bytes."""
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def run(batches: Batches) -> Batches:
        for rows in sliced(batches, text_col):
            n_words, n_features, found = features(rows.column(text_col), runs, buckets)
            packed = slices(found.astype(kind).view(np.uint8), n_features * kind.itemsize).cast(pa.binary())
            columns = [*(rows.column(c) for c in kept), pa.array(n_words), pa.array(n_features), packed]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "n_words", "n_features", "buckets"])

    return mapped(df, run, kept, "n_words long, n_features long, buckets binary")


def bucket_counts(coded: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs; every task adds up its own, so the driver gets one row per bucket."""
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def run(batches: Batches) -> Batches:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            content, _ = text_bytes(batch.column("buckets"))
            total += np.bincount(np.ascontiguousarray(content).view(kind), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in mapped(coded.select("buckets"), run, [], "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket floor(1000 * ln of the ratio of its smoothed shares of the target and of the source)."""
    n = len(source)
    above = (target + 1).astype(float) * float(source.sum() + n)
    below = (source + 1).astype(float) * float(target.sum() + n)
    return np.floor(1000 * np.log(above / below)).astype(np.int64)


def weighted(coded: DataFrame, kept: list[str], gain: np.ndarray) -> DataFrame:
    """The rows' ``kept`` columns with ``weight``, the sum of their buckets' gains."""
    kind = np.dtype("<u2" if len(gain) <= 1 << 16 else "<u4")

    def run(batches: Batches) -> Batches:
        for rows in sliced(batches, "buckets"):
            content, begin = text_bytes(rows.column("buckets"))
            total = np.concatenate(([0], np.cumsum(gain[np.ascontiguousarray(content).view(kind)])))
            ends = begin // kind.itemsize
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in kept), pa.array(total[ends[1:]] - total[ends[:-1]])], [*kept, "weight"])

    return mapped(coded, run, kept, "weight long")


def noise(key: Column, seed: int) -> Column:
    """floor(1000 * Gumbel noise) from a hash of the key; a null key is an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def score_quantiles(scores: DataFrame, shares: list[float]) -> list[int]:
    """Scores at about these shares of the rows in ascending order, from sketches merged in two steps."""
    parts = scores.groupBy((F.spark_partition_id() % GROUPS).alias("part")).agg(F.kll_sketch_agg_bigint("score", F.lit(SKETCH)).alias("sketch"))
    whole = parts.agg(F.kll_merge_agg_bigint("sketch", F.lit(SKETCH)).alias("sketch"))
    found = whole.select(*[F.kll_sketch_get_quantile_bigint("sketch", F.lit(s)).alias(f"q{i}") for i, s in enumerate(shares)])
    return list(found.first())


def bracket(scores: DataFrame, n: int, k: int) -> tuple[int | None, int | None, int]:
    """Scores (low, high) between which the k-th highest of n lies, None where there is no bound, and the rows above high.

    The sketch only proposes: the counts outside are exact, and a bracket that misses is widened.
    """
    margin = MARGIN
    while True:
        shares = [1 - k / n - margin, 1 - k / n + margin]
        inner = [s for s in shares if 0 < s < 1]
        found = iter(score_quantiles(scores, inner) if inner else [])
        low, high = (next(found) if 0 < s < 1 else None for s in shares)
        above = F.lit(False) if high is None else F.col("score") > high
        below = F.lit(False) if low is None else F.col("score") < low
        n_above, n_below = scores.agg(F.count_if(above), F.count_if(below)).first()
        if n_above < k <= n - n_below:
            return low, high, n_above
        margin *= 4


def cutoff(scores: DataFrame, share: int) -> tuple | None:
    """The last drawn row (score, id, row) of ``scores`` (score, id, row), None if nothing is drawn."""
    n = scores.count()
    k = share * n // 100
    if not k:
        return None
    low, high, above = bracket(scores, n, k)
    inside = scores
    if low is not None:
        inside = inside.where(F.col("score") >= low)
    if high is not None:
        inside = inside.where(F.col("score") <= high)
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("row")]
    last = placed(inside, [], order, "bracket").where(F.col("place") == k - above - 1).first()
    return last["score"], last["id"], last["row"]


def draw(scored: DataFrame, eligible: Column, share: int) -> DataFrame:
    """The rows of ``scored`` (with score, id and a row number) with ``rank``: from 1 for the drawn ones, else null.

    ``share`` percent of the eligible rows, rounded down, are drawn: the highest scores,
    ties to the smaller id (null ids last), then to the smaller row number.
    """
    last = cutoff(scored.where(eligible).select("score", "id", "row"), share)
    none = F.lit(None).cast("long")
    if last is None:
        return scored.withColumn("rank", none)
    score, key, row = last
    score, row = F.lit(score), F.lit(row)
    if key is None:
        before = F.col("id").isNotNull() | (F.col("row") <= row)
    else:
        # A null id is after any other.
        before = F.coalesce(F.col("id") < F.lit(key), F.lit(False)) | (F.col("id").eqNullSafe(F.lit(key)) & (F.col("row") <= row))
    drawn = F.coalesce(eligible, F.lit(False)) & ((F.col("score") > score) | ((F.col("score") == score) & before))
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("row")]
    ranked = placed(scored.where(drawn), [], order, "drawn").withColumn("rank", F.col("place") + 1).drop("place")
    return ranked.unionByName(scored.where(~drawn).withColumn("rank", none))


def resample(
    df: DataFrame, target: DataFrame, share: int = 10, *, runs: int = 1, buckets: int = 10_000, min_words: int = 20, seed: int = 2024,
    id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
) -> DataFrame:
    """All rows with n_features, weight, score and rank; ``rank is not null`` marks the drawn ones.

    ``share`` percent, a whole number, of the rows with at least ``min_words`` words are
    drawn.  A null text has no words, weight 0 and is never drawn with a positive
    ``min_words``.  Repeated rows are drawn one by one; a null id has the noise of an empty
    one and loses ties.  Without target texts all gains come from the documents alone.
    Other columns aren't passed on; they are joined back by id.
    """
    own = df.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    coded = settle(bucketed(own, ["id"], "text", runs, buckets).withColumn("row", F.monotonically_increasing_id()), "buckets")
    wanted = bucketed(target.select(col(target_col).cast("string").alias("text")), [], "text", runs, buckets)
    gain = gains(bucket_counts(coded, buckets), bucket_counts(wanted, buckets))
    kept = ["id", "row", "n_words", "n_features"]
    scored = weighted(coded, kept, gain).withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    found = draw(settle(scored, "scores"), F.col("n_words") >= min_words, share)
    return found.select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")
