"""Exact dedup by skew-safe combining.

Equal texts meet in three stages, and each compares full content, not only digests:

1. within a map task, by the partial aggregation below the first shuffle;
2. within a salted digest group ``(digest, salt)``, so that the copies of one text that fill a
   third of the table meet in ``SALTS`` tasks rather than one;
3. across salts, where a group has at most ``SALTS`` rows left.

Each document then looks up the winner of its own ``(digest, salt)``, so the way back is salted
too. It joins on SHA-256, a second hash and the length, not on the text again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plugwatch.llm.common import lower_ascii, packed

SALTS = 32


def _keyed(df: DataFrame, id_col: str, text_col: str, salts: int) -> DataFrame:
    norm = lower_ascii(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    return (
        df.select(F.col(f"`{id_col}`").alias("id"), norm.alias("norm"), packed(df).alias("row"))
        .withColumn("digest", F.unhex(F.sha2("norm", 256)))
        .withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))
    )


def winners(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            salts: int = SALTS) -> DataFrame:
    """One row per distinct text: digest, h2, keep_id, group_size, salts (a bit per salt used)."""
    rows = _keyed(df, id_col, text_col, salts)
    salted = rows.groupBy("digest", "salt", "norm").agg(
        F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    return salted.groupBy("digest", "norm").agg(
        F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"),
        F.expr("bit_or(shiftleft(1L, salt))").alias("salts"),
    ).select("digest", F.xxhash64("norm").alias("h2"), F.octet_length("norm").alias("size"),
             "keep_id", "group_size", "salts")


def decide(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           salts: int = SALTS) -> DataFrame:
    """What becomes of each row: ``(id, keep_id, group_size, kept, text_sha256)``.

    Texts are equal if identical after lower-casing A-Z; a null text counts as empty, and empty
    texts equal each other. Of equal texts the row with the largest identity stays; null
    identities are smaller than any other, and a group of nulls keeps a null. Rows that repeat
    identity and text are one document: all carry the same decision (``dedup`` returns one of
    them). Other columns are not looked at; an empty table gives an empty one.
    """
    if not 1 <= salts <= 63:
        raise ValueError("salts must be 1 to 63")
    rows = _keyed(df, id_col, text_col, salts).select(
        "id", "salt", "digest", F.xxhash64("norm").alias("h2"), F.octet_length("norm").alias("size"))
    used = F.expr(f"filter(sequence(0, {salts - 1}), s -> (salts & shiftleft(1L, s)) != 0)")
    ends = winners(df, id_col, text_col, salts).withColumn("salt", F.explode(used)).drop("salts")
    return rows.join(ends, ["digest", "h2", "size", "salt"]).select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          salts: int = SALTS) -> DataFrame:
    """The rows that stay, with the columns of ``df``. Of rows that repeat identity and text,
    one stays (any: a row's other columns come from one and the same row)."""
    # As a struct, which is never null, the identity is one key of both the grouping and the join,
    # so that the grouped rows aren't shuffled again to be joined.
    key = F.struct("id").alias("key")
    rows = _keyed(df, id_col, text_col, salts).select(key, "digest", "row")
    one = rows.groupBy("key", "digest").agg(F.any_value("row").alias("row"))
    ends = winners(df, id_col, text_col, salts).select(
        F.struct(F.col("keep_id").alias("id")).alias("key"), "digest")
    return one.join(ends, ["key", "digest"], "left_semi").select("row.*")
