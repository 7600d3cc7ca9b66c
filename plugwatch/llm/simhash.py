"""SimHash near-dedup with deletion-variant signatures.

A fingerprint of 64 bits is cut into two segments. Of two fingerprints at most three bits apart,
one segment differs by at most one bit. So each segment is indexed whole, and once per bit with
that bit taken out (a wildcard). Equality joins of these variants find every pair, each in one
bucket only per segment, because a wildcard bucket joins the fingerprints that have the bit with
those that lack it. Whole distances are then verified.

Texts from one template can share a segment by the thousand. In a bucket that is large on both
sides, the other segments differ by at most three bits, so three of their six blocks are equal:
there a fingerprint stands once for each choice of three blocks, which finds the same pairs.

Documents with equal fingerprints are one node, so copies are never paired up. Nodes with no
partner need no further work; the others are grouped by ``components``.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plugwatch.llm.common import packed
from plugwatch.session import stored

BITS, SEGMENT = 64, 32
SHINGLE, DISTANCE = 3, 3
# A bucket with more fingerprints than this on both sides is split. Random halves don't get there
# before there are some 10^11 distinct fingerprints.
HOT = 64
# Shingles whose bits are counted at once: bounds a task's memory for a very long text.
BLOCK = 1 << 16


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit number.

    A-Z in lower case; words are runs without ASCII white space; a bit is one if it is set in the
    XXH64 (seed 42) of over half of the shingles, repeats included. A text of fewer words is one
    shingle; a null or empty one has fingerprint zero.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    ones, total = np.zeros(BITS, dtype=np.int64), max(1, len(words) - shingle + 1)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[:total].tolist()
    ends = (ends[shingle - 1:] if len(words) >= shingle else ends[-1:]).tolist()
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, BLOCK):
        hashes = np.array([digest(line[a:b - 1], 42) for a, b in zip(
            starts[at:at + BLOCK], ends[at:at + BLOCK])], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8)).reshape(-1, BITS).sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total).view(">i8")[0])


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """``simhash`` of a column, as long."""
    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, shingle) for t in texts], dtype="int64")

    return fp(text)


def hex_text(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), BITS // 4, "0"))


def _choices(blocks: int = 6, kept: int = 3) -> list[int]:
    """Masks of a segment that leave ``kept`` of its ``blocks`` blocks."""
    ends = [SEGMENT * i // blocks for i in range(blocks + 1)]
    each = [(1 << b) - (1 << a) for a, b in zip(ends, ends[1:])]
    return [sum(some) for some in combinations(each, kept)]


LOW_HALF, HIGH_HALF = f"(fp & {(1 << SEGMENT) - 1})", f"shiftrightunsigned(fp, {SEGMENT})"


def variants(nodes: DataFrame, side: int) -> DataFrame:
    """Index keys of the fingerprints in ``fp``: (slot, key, fp). ``side`` 0 has the wildcard
    variants of segments whose bit is 0, side 1 of those whose bit is 1; both have the whole ones.
    ``slot`` names the segment and the bit; 32 stands for the whole segment."""
    one = (
        f"transform(filter(sequence(0, {SEGMENT - 1}), b -> (shiftright(%s, b) & 1) = {side}),"
        f" b -> struct(%d + b as slot, %s & ~shiftleft(1L, b) as key))"
    )
    each = [one % (seg, at, seg) for seg, at in ((LOW_HALF, 0), (HIGH_HALF, 64))]
    whole = [f"array(struct({at + SEGMENT} as slot, {seg} as key))"
             for seg, at in ((LOW_HALF, 0), (HIGH_HALF, 64))]
    return nodes.select("fp", F.explode(F.expr(f"concat({', '.join(each + whole)})")).alias("v")) \
        .select("fp", "v.slot", "v.key")


def hot_buckets(nodes: DataFrame, hot: int = HOT) -> DataFrame:
    """The (slot, key) with more than ``hot`` fingerprints on each side.

    A side of a bucket is all fingerprints with one value of one segment, so the values are
    counted, and only the frequent ones are looked up among their neighbours."""
    values = nodes.select(F.explode(F.expr(
        f"array(struct(0 as at, {LOW_HALF} as key), struct(64 as at, {HIGH_HALF} as key))")).alias("v"))
    often = stored(values.groupBy("v.at", "v.key").count().filter(F.col("count") > hot).select("at", "key"))
    bits = F.sequence(F.lit(0), F.lit(SEGMENT - 1))
    each = often.select("at", "key", F.explode(bits).alias("bit")).selectExpr(
        "at + bit as slot", "key & ~shiftleft(1L, bit) as key",
        "cast(shiftright(key, bit) & 1 as int) as side")
    both = each.groupBy("slot", "key").agg(F.countDistinct("side").alias("sides")).filter("sides = 2")
    return stored(both.select("slot", "key").union(
        often.select((F.col("at") + SEGMENT).alias("slot"), "key")))


def candidates(nodes: DataFrame, hot: int = HOT) -> DataFrame:
    """The pairs of the buckets, before their distance is verified: (a, b, slot, part).

    ``part`` numbers the choice of blocks; it is -1 in a bucket that is not split. Spark takes the
    variants for no larger than the fingerprints they come from, some 34 times too small, so they
    are kept from being broadcast."""
    split = hot_buckets(nodes, hot).withColumn("split", F.lit(True))
    other = f"(CASE WHEN slot < 64 THEN {HIGH_HALF} ELSE {LOW_HALF} END)"
    parts = ", ".join(f"struct({i} as part, {other} & {mask}L as rest)" for i, mask in enumerate(_choices()))
    dealt = f"inline(CASE WHEN split THEN array({parts}) ELSE array(struct(-1 as part, 0L as rest)) END)"
    a, b = (
        variants(nodes, side).join(split, ["slot", "key"], "left")
        .selectExpr("fp", "slot", "key", dealt).withColumnRenamed("fp", "ab"[side])
        for side in (0, 1))
    return a.join(b.hint("merge"), ["slot", "key", "part", "rest"]).select("a", "b", "slot", "part")


def links(nodes: DataFrame, distance: int = DISTANCE, hot: int = HOT) -> DataFrame:
    """The pairs (a, b) of distinct fingerprints in ``fp`` at most ``distance`` bits apart.

    Complete for distances up to 3 (two segments, one of which differs by one bit at most). A
    pair may come once for each segment. Buckets with more than ``hot`` fingerprints on both
    sides are split; a pair that meets in several of their parts counts in the first.
    """
    if not 0 <= distance <= 3:
        raise ValueError("two segments find pairs up to three bits apart")
    apart = F.col("a").bitwiseXOR(F.col("b"))
    whole = F.col("slot").isin(SEGMENT, 64 + SEGMENT)
    rest = F.when(F.col("slot") < 64, F.shiftrightunsigned(apart, SEGMENT)).otherwise(
        apart.bitwiseAND(F.lit((1 << SEGMENT) - 1)))
    first = F.array_position(F.array(*[
        rest.bitwiseAND(F.lit(mask)) == 0 for mask in _choices()]), True) - 1
    return candidates(nodes, hot).filter(
        (F.bit_count(apart) <= distance) & (~whole | (F.col("a") < F.col("b")))
        & ((F.col("part") < 0) | (F.col("part") == first))).select("a", "b")


def components(pairs: DataFrame) -> DataFrame:
    """Connected components of the pairs (a, b): (node, root), root the least node reachable.

    Alternates large-star and small-star steps, which end in about log n rounds with a star around
    each root. Each round is a written table. The minimum of a node's neighbours is a partial
    aggregate, and the way back a join whose hot keys Spark can split.
    """
    edges = stored(pairs.filter("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if not state[0] or state == before:
            break
        before = state
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m")).select(
            "n", F.least("n", "m").alias("m"))
        # Large star: greater neighbours move to the least neighbour.
        large = both.join(least, both["u"] == least["n"]).filter("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # Small star: smaller neighbours, and the node itself, move to the least one.
        root = large.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
        small = large.join(root, large["u"] == root["n"]).select(
            F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        edges = stored(small.union(root.select(F.col("n").alias("u"), F.col("m").alias("v"))).distinct())
    roots = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return roots.union(roots.select("root", "root")).distinct()


def _rooted(df: DataFrame, id_col: str, text_col: str, shingle: int,
            distance: int) -> tuple[DataFrame, DataFrame]:
    """The rows as (id, mark, fp), stored, ``mark`` a hash that tells the texts of one identity
    apart, and the distinct fingerprints as (fp, first, root): the least identity that has it, and
    the one that names its component."""
    text = F.col(f"`{text_col}`")
    fps = stored(df.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("mark"),
                           fingerprint(text, shingle).alias("fp")))
    nodes = fps.groupBy("fp").agg(F.min("id").alias("first"))
    grouped = components(links(nodes.select("fp"), distance))
    return fps, nodes.join(grouped, nodes["fp"] == grouped["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))


def group(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row per row of ``df``: (id, fingerprint, component_id).

    ``component_id`` is the smallest identity reachable over links of ``distance`` bits or fewer,
    the document's own included. Null identities are passed over; a component that has no
    other has a null one. Rows that repeat an identity are in the components of each of their texts.
    Other columns are not looked at; an empty table gives an empty one.
    """
    fps, named = _rooted(df, id_col, text_col, shingle, distance)
    ends = named.groupBy("root").agg(F.min("first").alias("component_id"))
    # ``fps`` has a row per document and few bytes on disk for equal texts, so it isn't broadcast.
    return (
        fps.hint("merge").join(named.select("fp", "root").join(ends, "root").select("fp", "component_id"), "fp")
        .select(F.col("id").alias(id_col), hex_text(F.col("fp")).alias("fingerprint"), "component_id")
    )


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of ``df`` per group: the one with the smallest identity, null ones last, and of
    those the one with the smallest fingerprint. Of rows alike in both the one with the smallest
    hash of its text stays. An identity that leads several groups, by rows with different texts,
    stays once for each. Texts are fingerprinted once, and found again by identity and hash."""
    fps, named = _rooted(df, id_col, text_col, shingle, distance)
    lead = F.min(F.struct(F.col("first").isNull().alias("none"), "first", "fp"))
    ends = named.groupBy("root").agg(lead.alias("lead")).select("lead.first", "lead.fp")
    # Grouped before the join, as many rows may have one identity or none, and one fingerprint.
    texts = fps.groupBy("id", "fp").agg(F.min("mark").alias("mark")).join(
        ends.withColumnRenamed("fp", "lead"),
        (F.col("fp") == F.col("lead")) & F.col("id").eqNullSafe(F.col("first")), "left_semi")
    stay = texts.select(F.col("id").alias("stay"), F.col("mark").alias("stay_mark"))
    rows = df.select(F.col(f"`{id_col}`").alias("id"), packed(df).alias("row"),
                     F.xxhash64(F.col(f"`{text_col}`")).alias("mark"))
    same = (F.col("mark") == F.col("stay_mark")) & F.col("id").eqNullSafe(F.col("stay"))
    one = rows.join(stay, same, "left_semi").groupBy("id", "mark").agg(F.any_value("row").alias("row"))
    return one.select("row.*")
