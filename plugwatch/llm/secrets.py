r"""Secret scans by linking the parts of a credential.

Strong parts (a keyword with a value, an access key identifier, a long hexadecimal string) are
reported on their own. Weak ones (a user or client name, an unnamed token, an endpoint) are
candidates; one is reported only if a complementary part lies within the same scope, that is
with at most ``SCOPE`` characters between the two in the same text, however long they are. The
interval join takes the parts of a text by start: of those that began before, how far the ones of each
other role reach (a running maximum of ends), and of those that begin later, whether one of another
role does so within the scope of the end (the next start of each role). Both are linear, without
pairs. Only column expressions:
``split`` gives the gaps between matches and ``regexp_extract_all`` the matches, and a running sum of
their lengths gives positions in code points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCOPE = 300


@dataclass(frozen=True)
class Part:
    """``role`` is access, secret or endpoint. A match must have ``least`` characters in group
    ``group``, and match all of ``needs``."""

    kind: str
    role: str
    pattern: str
    least: int
    group: int = 0
    weak: bool = False
    needs: tuple[str, ...] = ()


# The base patterns, in the order in which kinds are listed, then the weak ones.
PARTS = (
    Part("assign", "secret", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),  # noqa: E501
    Part("access", "access", r"AKIA[A-Z0-9]+", 16),
    Part("hex", "secret", r"[0-9a-f]{32,}", 32),
    Part("name", "access", r"""(?i)(user_?name|user_?id|login|account|client_?id|key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@_.-]+)""", 3, 2, weak=True),  # noqa: E501
    Part("token", "secret", r"[A-Za-z0-9+/_-]{40,}", 40, weak=True, needs=("[0-9]", "[a-z]", "[A-Z]")),  # noqa: E501
    Part("endpoint", "endpoint", r"[a-z][a-z0-9+.]{1,15}://[A-Za-z0-9._~:/?#@%&=+-]+", 8, weak=True),  # noqa: E501
)


def _matches(text: Column, rank: int, part: Part) -> Column:
    """What ``part`` matches in ``text``: (rank, gap before it, length, whether it passes)."""
    found = F.regexp_extract_all(text, F.lit(part.pattern), F.lit(0))
    pairs = F.arrays_zip(F.split(text, part.pattern, -1).alias("gap"), found.alias("hit"))

    def passes(hit: Column) -> Column:
        value = F.regexp_extract(hit, part.pattern, part.group) if part.group else hit
        ok = F.length(value) >= part.least
        for need in part.needs:
            ok = ok & value.rlike(need)
        return ok

    listed = F.transform(pairs, lambda p: F.struct(
        F.lit(rank).alias("rank"), F.length(p["gap"]).cast("long").alias("gap"),
        F.length(p["hit"]).cast("long").alias("size"), passes(p["hit"]).alias("ok")))
    kept = F.filter(listed, lambda p: p["size"].isNotNull())  # the gap after the last match
    empty = F.array().cast("array<struct<rank:int,gap:bigint,size:bigint,ok:boolean>>")
    return F.when(text.rlike(part.pattern), kept).otherwise(empty)


def parts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The passing parts of every text, one row each: (row_id, rank, start, end), and one row
    with nulls for a text without any. ``row_id`` tells the rows of ``df`` apart."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    found = F.concat(*[_matches(text, i, p) for i, p in enumerate(PARTS)])
    rows = (
        df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != text_col]).alias("row"),
                  found.alias("found"))
        .withColumn("row_id", F.monotonically_increasing_id())
        .select("row", "row_id", F.posexplode_outer("found").alias("pos", "part"))
        .select("row", "row_id", "pos", "part.*")
        # All that follows groups by the text: one small shuffle.
        .repartition("row_id")
    )
    before = Window.partitionBy("row_id", "rank").orderBy("pos").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.col("size")).over(before)
    placed = rows.withColumn("end", end).withColumn("start", F.col("end") - F.col("size"))
    # A failing match moves those after it, but is no part; the first row of a text stays to
    # stand for the text.
    return placed.withColumn("ok", F.coalesce("ok", F.lit(False))).filter(
        F.col("ok") | F.coalesce(F.col("pos") == 0, F.lit(True)))


def scan(df: DataFrame, text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """Adds ``spans`` to the rows of ``df`` (without its text): an array of
    (start, rank, end, kind, weak), sorted by start and kind.

    Base kinds come first in ``PARTS`` and are always reported, also where they overlap. A weak
    part is left out where it overlaps a strong one, and unless a part of another role, strong or
    weak, overlaps it or has at most ``scope`` characters between itself and it. A null text is
    empty and has no spans. Rows that are repeated are scanned and returned once for each. The
    caller's columns keep their names and values; where one is called ``spans``, the added column is
    ``spans_``, with as many ``_`` as make it a new one.
    """
    out = "spans"
    while out in df.columns and out != text_col:
        out += "_"
    found = parts(df, text_col)
    role = F.element_at(F.array(*[F.lit(p.role) for p in PARTS]), F.col("rank") + 1)
    weak = F.element_at(F.array(*[F.lit(p.weak) for p in PARTS]), F.col("rank") + 1)
    found = found.withColumn("role", F.when(F.col("ok"), role)).withColumn("weak", weak)
    # Parts that begin at one place overlap, so both windows, which include those, may see them.
    until = Window.partitionBy("row_id").orderBy("start").rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    after = Window.partitionBy("row_id").orderBy("start").rangeBetween(
        Window.currentRow, Window.unboundedFollowing)
    linked = F.lit(False)
    for r in ("access", "secret", "endpoint"):
        of_role = F.col("role") == r
        reach = F.max(F.when(of_role, F.col("end"))).over(until)
        begin = F.min(F.when(of_role, F.col("start"))).over(after)
        close = (F.col("start") - reach <= scope) | (begin - F.col("end") <= scope)
        linked = linked | ((F.col("role") != r) & F.coalesce(close, F.lit(False)))
    # Strong parts that began no later reach to ...; those that begin later begin at ...
    strong = F.col("ok") & ~F.col("weak")
    overlapped = (F.coalesce(F.max(F.when(strong, F.col("end"))).over(until), F.lit(-1))
                  > F.col("start")) | (F.coalesce(
                      F.min(F.when(strong, F.col("start"))).over(after), F.lit(2**62))
                      < F.col("end"))
    told = found.withColumn("linked", linked).withColumn("overlapped", overlapped)
    reported = F.col("ok") & (~F.col("weak") | (F.col("linked") & ~F.col("overlapped")))
    kind = F.element_at(F.array(*[F.lit(p.kind) for p in PARTS]), F.col("rank") + 1)
    span = F.struct("start", "rank", "end", kind.alias("kind"), "weak")
    return told.groupBy("row_id").agg(
        F.any_value("row").alias("row"),
        F.sort_array(F.collect_list(F.when(reported, span))).alias("spans"),
    ).select("row.*", F.col("spans").alias(out))


def joined(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
