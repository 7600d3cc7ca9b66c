"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What an ASCII-only lower-casing maps.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z in lower case and nothing else changed.

    ``lower`` does just that to a text of ASCII only, and is several times faster.
    """
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def packed(df: DataFrame) -> Column:
    """All columns as one struct, so that no name an operator adds can clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def id_text(doc_id: str) -> Column:
    """The identity as text; empty if null, so that hashes of it are never null."""
    return F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))
