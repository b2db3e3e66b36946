"""Left lookups and gap filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.operators.dedupe import latest_per_key
from hearthline.session import settle

FILTER_WORDS = 1 << 17  # 8 million bits: a broadcast of a few MB


def lookup(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]] | str) -> DataFrame:
    """Left join to a ``right`` that has at most one row per key; right key columns are dropped.

    Spark broadcasts a right side that it knows to be small.  Otherwise both sides are
    shuffled, and adaptive execution splits the rows of a hot or NULL key among tasks.
    """
    pairs = [(on, on)] if isinstance(on, str) else list(on)
    renamed = {r: f"_right_{r}" for _, r in pairs}
    match = [F.col(f"`{a}`") == F.col(f"`{renamed[b]}`") for a, b in pairs]
    return left.join(right.withColumnsRenamed(renamed), match, "left").drop(*renamed.values())


def among(df: DataFrame, key: str, wanted: DataFrame, words: int = FILTER_WORDS) -> DataFrame:
    """The rows whose ``key`` is one of the keys ``wanted`` (a table of one column), with few others shuffled.

    The wanted keys are hashed into a bitmap of at most ``words`` words of 64 bits, which
    every task of the scan can hold, so most rows of other keys go before the shuffle; the
    left-semi join that follows is exact.  A bitmap that many keys have filled lets more
    rows through and costs nothing else.
    """
    place = F.pmod(F.xxhash64(key), F.lit(64 * words))
    (name,) = wanted.columns
    hashed = F.pmod(F.xxhash64(name), F.lit(64 * words))
    bitmap = (
        wanted.select(hashed.alias("_hash"))
        .select(F.shiftright("_hash", 6).alias("_word"), F.expr("shiftleft(1L, cast(_hash & 63 as int))").alias("_bit"))
        .groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    )
    placed = df.withColumn("_hash", place)
    near = placed.join(F.broadcast(bitmap), F.shiftright("_hash", 6) == F.col("_word"))
    near = near.where(F.expr("shiftright(_bits, cast(_hash & 63 as int)) & 1L = 1L")).select(*[F.col(f"`{c}`") for c in df.columns])
    return near.join(wanted, F.col(f"`{key}`") == F.col(f"`{name}`"), "left_semi")


def backfill_nulls(df: DataFrame, patch: DataFrame, key: str, columns: Sequence[str], newest: str | None = None) -> DataFrame:
    """Fill NULL or blank text in ``columns`` from the ``patch`` row of the same key.

    Keys are compared as text.  Of several patch rows of a key the one with the largest
    ``newest`` counts (any fixed one without it), so rows are never doubled.  Only rows with
    a gap take part in the join; complete rows are passed through without a shuffle.  The
    patch is reduced to the keys that have a gap before its newest rows are looked for.
    """
    absent = [(side, c) for side, have in (("input", df), ("patch", patch)) for c in (key, *columns) if c not in have.columns]
    if absent:
        raise ValueError(f"no such columns: {absent}")
    texts = df.withColumns({c: F.col(c).cast("string") for c in columns})
    gap = F.exists(F.array(*columns), lambda v: F.trim(F.coalesce(v, F.lit(""))) == "")
    versions = patch.select(
        F.col(key).cast("string").alias("_patch_key"),
        *([F.col(newest).alias("_newest")] if newest else []),
        *[F.col(c).cast("string").alias(f"_patch_{c}") for c in columns],
    ).filter("_patch_key is not null")
    gaps = texts.filter(gap).withColumn("_key", F.col(key).cast("string"))
    asked = settle(gaps.select(F.col("_key").alias("_asked")).filter("_asked is not null").distinct(), "gap-keys")
    fixes = latest_per_key(among(versions, "_patch_key", asked), "_patch_key", "_newest" if newest else None).drop("_newest")
    filled = lookup(gaps, fixes, [("_key", "_patch_key")]).withColumns(
        {c: F.when(F.trim(F.col(c)) != "", F.col(c)).otherwise(F.col(f"_patch_{c}")) for c in columns}
    )
    return texts.filter(~gap).unionByName(filled.select(*df.columns))
