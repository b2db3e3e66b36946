"""Mixing sources to target weights by Poisson replication.

A document of a source whose target repetition rate is r is repeated K times, K drawn
from the Poisson distribution of mean r by inverting its distribution function at a
uniform number that is a hash of the document's id and a seed.  A draw needs no other
row, so documents are independent, a rerun task repeats its choices, and a hot source
needs no counting besides its size.

The rate of a source is  weight share * epochs * total size / its size.  Rates above
``STEP`` are drawn as sums of draws of equal mean at most ``STEP`` (a sum of independent
Poisson numbers is one of the summed mean), so the table of distribution functions has
at most ``TERMS`` numbers a source and no term underflows.

Only Spark's own functions run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import numbered, restored
from hearthline.session import settle

STEP = 8.0
TERMS = 64  # the mass beyond is below 1e-30 for a mean of STEP
DIGITS = 13  # of a hexadecimal hash: 52 bits, exact in a double
DECADES = (6, 9, 12, 15, 18, 21, 24, 27)  # decimals that a rate is held to, the more the smaller it is


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) from the MD5 of the parts joined by a colon."""
    text = F.concat_ws(":", *parts)
    drawn = F.conv(F.substring(F.md5(text.cast("binary")), 1, DIGITS), 16, 10).cast("double")
    return (drawn + F.lit(0.5)) / F.lit(float(16**DIGITS))


def poisson_cdf(mean: Column) -> Column:
    """The distribution function at 0, 1, ... as an array of TERMS numbers."""
    start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("c"), F.array(F.exp(-mean)).alias("all"))

    def add(state: Column, k: Column) -> Column:
        p = state["p"] * mean / k.cast("double")
        c = state["c"] + p
        return F.struct(p.alias("p"), c.alias("c"), F.concat(state["all"], F.array(c)).alias("all"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS - 1)), start, add, lambda state: state["all"])


def rounded(rate: Column) -> Column:
    """The rate with six significant digits at least, so that it doesn't depend on the order of a sum; down to 1e-27, then 0."""
    scale = F.lit(float(f"1e{DECADES[-1]}"))
    out = F.floor(rate * scale).cast("double") / scale
    for digits in reversed(DECADES[:-1]):
        scale = F.lit(float(f"1e{digits}"))
        cut = F.floor(rate * scale).cast("double") / scale
        out = F.when(rate >= F.lit(float(f"1e{6 - digits}")), cut).otherwise(out)
    return out


def source_rates(docs: DataFrame, weights: dict[str, float] | None, temperature: float, epochs: float) -> DataFrame:
    """One row per source of ``docs`` (_source, _size): its rate, the number of draws and the distribution function of one draw.

    Weights are given per source (others get none), or follow from sizes as size^(1 / temperature).
    """
    sizes = docs.groupBy("_source").agg(F.sum("_size").alias("_size"))
    if weights is None:
        weight = F.pow(F.col("_size").cast("double"), F.lit(1.0 / temperature))
    else:
        given = [part for name, w in weights.items() for part in (F.lit(name), F.lit(float(w)))]
        weight = F.coalesce(F.create_map(*given)[F.col("_source")], F.lit(0.0)) if given else F.lit(0.0)
    weighted = sizes.withColumn("_weight", weight)
    weighted = settle(weighted, "sizes")
    # Two numbers; a source of a null size can't be, as every document counts one at least.
    total = weighted.agg(F.sum("_size").alias("size"), F.sum("_weight").alias("weight")).first()
    if not total["weight"]:
        weighted, total = weighted.where(F.lit(False)), {"size": 0, "weight": 1.0}
    rate = F.col("_weight") / F.lit(total["weight"]) * F.lit(float(epochs)) * F.lit(total["size"]).cast("double") / F.col("_size").cast("double")
    rated = weighted.withColumn("_rate", rounded(rate))
    rated = rated.withColumn("_draws", F.greatest(F.lit(1), F.ceil(F.col("_rate") / STEP).cast("int")))
    return rated.select("_source", "_rate", "_draws", poisson_cdf(F.col("_rate") / F.col("_draws")).alias("_cdf"))


def mix(
    df: DataFrame, weights: dict[str, float] | None = None, *, temperature: float = 2.0, epochs: float = 1.0, seed: int = 17,
    id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
) -> DataFrame:
    """Each row as often as drawn, in random order: all columns, ``copy`` from 0, ``rate`` and ``shuffle_key``.

    Sizes are code points of text plus one, so that empty documents have a rate too; a null
    text counts as empty.  A null source is a source of its own, and can't be named in
    ``weights``; a null id is drawn as the empty string.  Rows with equal ids are drawn
    alike.  A table without rows gives none.  Input columns named copy, rate or
    shuffle_key are replaced.

    Rows are dealt to partitions by a hash of id, copy and seed and sorted by it within
    each, which is a random order over all files.
    """
    plain, names = numbered(df)
    source = F.col(names[source_col]).cast("string")
    size = F.length(F.coalesce(F.col(names[text_col]).cast("string"), F.lit(""))).cast("long") + 1
    rates = settle(source_rates(plain.select(source.alias("_source"), size.alias("_size")), weights, temperature, epochs), "rates")
    name = F.coalesce(F.col(names[id_col]).cast("string"), F.lit(""))
    joined = plain.join(rates, source.eqNullSafe(F.col("_source")))

    def drawn(k: Column) -> Column:
        return F.size(F.filter(F.col("_cdf"), lambda c: c < uniform(name, F.lit(str(seed)), k.cast("string"))))

    count = F.aggregate(F.sequence(F.lit(1), F.col("_draws")), F.lit(0), lambda n, k: n + drawn(k))
    counted = joined.select(*plain.columns, F.col("_rate").alias("rate"), count.alias("_copies")).where("_copies > 0")
    copies = counted.select(*plain.columns, "rate", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)).alias("copy"))
    key = F.substring(F.md5(F.concat_ws(":", name, F.lit(str(seed)), F.lit("copy"), F.col("copy").cast("string")).cast("binary")), 1, 16)
    shuffled = copies.withColumn("shuffle_key", key).repartition("shuffle_key").sortWithinPartitions("shuffle_key")
    return restored(shuffled, df, names, "copy", "rate", "shuffle_key")
