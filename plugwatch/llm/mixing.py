"""Mixing sources to target weights by Poisson replication.

A document of source ``s`` is repeated ``k`` times, where ``k`` has a Poisson distribution whose
mean is the rate at which ``s`` must be repeated to get its share. ``k`` comes from inverting the
distribution at a point of (0, 1) that is a hash of the seed and the document's identity, so a
task that runs again gives the same copies. Only column expressions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plugwatch.llm.common import packed

SALTS = 64
# Rates of at most so many sources, with names of at most so many bytes in all, are broadcast.
FEW_SOURCES, FEW_BYTES = 100_000, 1 << 23
# Above this mean the distribution is drawn as a sum of several, as exp(-mean) would underflow.
MEAN_AT_ONCE = 256.0


def source_sizes(df: DataFrame, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Characters by source, one more for each document so that none has size zero."""
    size = F.coalesce(F.length(f"`{text_col}`"), F.lit(0)) + 1
    return df.groupBy(F.col(f"`{source_col}`").alias("source")).agg(
        F.sum(size.cast("long")).alias("size"))


def tempered_weights(sizes: DataFrame, power: float) -> DataFrame:
    """Target shares in proportion to ``size ** power``: (source, weight), summing to 1."""
    weight = F.pow(F.col("size").cast("double"), F.lit(float(power)))
    norm = sizes.agg(F.sum(weight)).first()[0] or 1.0
    return sizes.select("source", (weight / F.lit(float(norm))).alias("weight"))


def rates(sizes: DataFrame, weights: DataFrame, total: float | None = None) -> DataFrame:
    """Mean repetitions by source for ``weights`` (source, weight; any positive scale).

    ``total`` is the wanted size of the mixture in characters, that of the input if None.
    A source without a weight, or with a null or negative one, has rate 0.
    """
    both = sizes.join(
        weights.groupBy(F.col("source").alias("s")).agg(F.max("weight").alias("weight")),
        F.col("source").eqNullSafe(F.col("s")), "left")
    weight = F.greatest(F.coalesce(F.col("weight"), F.lit(0.0)), F.lit(0.0))
    sums = both.agg(F.sum("size"), F.sum(weight)).first()
    total = float(sums[0] or 0) if total is None else float(total)
    norm = float(sums[1] or 0) or 1.0
    return both.select("source", (weight / F.lit(norm) * F.lit(total) / F.col("size")).alias("rate"))


def unit_hash(*parts: Column) -> Column:
    """A point of (0, 1) from the first 48 bits of an MD5 digest."""
    digest = F.substring(F.md5(F.concat_ws(":", *parts)), 1, 12)
    return (F.conv(digest, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2**48))


def poisson(mean: Column, u: Column) -> Column:
    """The least k with P(Poisson(mean) <= k) >= u, for a mean of at most ``MEAN_AT_ONCE``.

    The sum runs to mean + 12 sqrt(mean) + 30, beyond which less than 2^-53 is left.
    """
    steps = F.sequence(F.lit(1), F.ceil(mean + 12 * F.sqrt(mean) + 30).cast("int"))
    first = F.exp(-mean)
    start = F.struct(F.lit(0).alias("k"), first.alias("p"), first.alias("cdf"))

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * mean / k
        return F.when(acc["cdf"] >= u, acc).otherwise(
            F.struct(k.cast("int").alias("k"), p.alias("p"), (acc["cdf"] + p).alias("cdf")))

    return F.aggregate(steps, start, step, lambda acc: acc["k"])


def repetitions(mean: Column, seed: int, key: Column) -> Column:
    """The number of copies of the document ``key``."""
    parts = F.greatest(F.ceil(mean / F.lit(MEAN_AT_ONCE)), F.lit(1)).cast("int")
    each = F.transform(F.sequence(F.lit(1), parts), lambda i: poisson(
        mean / parts, unit_hash(F.lit(str(seed)), key, i.cast("string"))))
    return F.aggregate(each, F.lit(0), lambda a, b: a + b)


def mix(df: DataFrame, rate: DataFrame, seed: int = 0, id_col: str = "doc_id",
        source_col: str = "source", text_col: str = "text", extra: bool = True,
        few_sources: int = FEW_SOURCES) -> DataFrame:
    """The mixture in random order: the rows of ``df``, each as often as drawn.

    ``rate`` has (source, rate). A null source is a source of its own; one that ``rate`` lacks
    is left out. A document without identity is drawn by a digest of its text. Rows that repeat an
    identity are drawn alike. ``extra`` adds ``copy`` (from 1) and ``shuffle_key``, unless the
    table has such columns. An empty table gives an empty one.

    The rates are counted first. Those of up to ``few_sources`` sources are broadcast, so that a
    text is shuffled only for the order; more are joined on the salted source, which spreads a hot
    one. Both give the same rows. Rows are dealt out by a hash of the copy and sorted
    by it within each partition, which is a random order of the whole without a sampling pass.
    """
    key = F.coalesce(F.col(f"`{id_col}`").cast("string"),
                     F.concat(F.lit("text:"), F.md5(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))))
    rows = df.select(packed(df).alias("row"), F.col(f"`{source_col}`").alias("source"),
                     key.alias("key"))
    rate = rate.select(F.col("source").alias("s"), "rate")
    sources, named = rate.agg(F.count(F.lit(1)), F.sum(F.octet_length("s"))).first()
    same = F.col("source").eqNullSafe(F.col("s"))
    if sources <= few_sources and (named or 0) <= FEW_BYTES:
        joined = rows.join(F.broadcast(rate), same)
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        joined = rows.withColumn("salt", F.pmod(F.hash("key"), F.lit(SALTS))).join(
            rate.withColumn("salt_s", salts), same & (F.col("salt") == F.col("salt_s")))
    drawn = (
        joined
        .withColumn("n", repetitions(F.col("rate"), seed, F.col("key")))
        .filter(F.col("n") > 0)
        .select("row", "key", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
        .withColumn("shuffle_key", F.md5(F.concat_ws(":", F.lit(f"order {seed}"), "key", "copy")))
        .repartition("shuffle_key").sortWithinPartitions("shuffle_key", "copy")
    )
    added = [c for c in ("copy", "shuffle_key") if extra and c not in df.columns]
    return drawn.select("row.*", *added)
