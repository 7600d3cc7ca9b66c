"""Text cleaning as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plugwatch.settings import MAX_TEXT_CHARS

# --- Fixed values: characters and patterns -------------------------------------------
# All Unicode whitespace, also the four separators that Java's \s leaves out.
WHITESPACE = "".join(map(chr, (
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)))
_SPACES = r"\t\n\x0b\f\r \x1c\x1d\x1e\x1f\x85\xa0\p{Z}"
SPACE, NO_SPACE = f"[{_SPACES}]", f"[^{_SPACES}]"
ZERO_WIDTH = r"[\x{200B}-\x{200F}\x{FEFF}]"
DASHES = "\N{EN DASH}\N{EM DASH}\N{MINUS SIGN}"
SEPARATORS = "\N{LINE SEPARATOR}\N{PARAGRAPH SEPARATOR}"
LISTING_CONTROLS = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
ALL_CONTROLS = r"[\x00-\x1F\x7F-\x9F]+"
MAY_CHANGE = r"[^\x00-\x7F\xC0-\x{0131}]"
CHUNK_BREAK = rf"(?<=[.!?;]){SPACE}+|{SPACE}*[•\-–—]{SPACE}+"


def strip(c: Column) -> Column:
    """Remove all Unicode whitespace at both ends."""
    return F.btrim(c, F.lit(WHITESPACE))


def normalise_text(c: Column) -> Column:
    """Drop zero-width characters and turn long dashes and minus signs into ``-``."""
    text = F.coalesce(c.cast("string"), F.lit(""))
    return F.translate(F.regexp_replace(text, ZERO_WIDTH, ""), DASHES, "-" * len(DASHES))


def join_text(df: DataFrame, *names: str, sep: str = "||", ignore_missing: bool = True,
              normalise: Callable[[Column], Column] = normalise_text) -> Column:
    """Normalise and concatenate columns; an absent column counts as empty or is an error.

    Nested columns enter as their JSON text.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    missing = [n for n in names if n not in types]
    if missing and not ignore_missing:
        raise KeyError(f"columns not found: {missing}")
    nested = (T.ArrayType, T.MapType, T.StructType)

    def part(name: str) -> Column:
        if name not in types:
            return F.lit("")
        c = F.col(name)
        c = F.to_json(c) if isinstance(types[name], nested) else c.cast("string")
        return F.coalesce(normalise(F.coalesce(c, F.lit(""))), F.lit(""))

    return F.concat_ws(sep, *[part(n) for n in names])


def clean_listing_text(c: Column) -> Column:
    """Drop control characters, flatten line breaks and tabs, squeeze runs of whitespace.

    A single inner whitespace character stays as it is; null stays null.
    """
    c = F.regexp_replace(c, LISTING_CONTROLS, "")
    c = F.regexp_replace(c, r"[\r\n\t]+", " ")
    return strip(F.regexp_replace(c, SPACE + "{2,}", " "))


@F.arrow_udf(T.StringType())
def _nfkc(texts):
    import unicodedata

    import pyarrow as pa

    # Arrow's own normalisation cuts long texts off, so Python's is used.
    return pa.array([None if t is None else unicodedata.normalize("NFKC", t)
                     for t in texts.to_pylist()], pa.string())


def nfkc(c: Column) -> Column:
    """Unicode compatibility normalisation, which Spark has no function for.

    Only values with characters that it can change leave the JVM. ASCII and the common
    accented Latin letters are in this form already.
    """
    return F.coalesce(_nfkc(F.when(c.rlike(MAY_CHANGE), c)), c)


def clean_encoding(c: Column) -> Column:
    """Compatibility form, without separators and control characters, single spaces."""
    c = F.translate(nfkc(c), SEPARATORS, "  ")
    c = F.regexp_replace(c, ALL_CONTROLS, " ")
    return strip(F.regexp_replace(c, SPACE + "+", " "))


def clean_string_columns(df: DataFrame) -> DataFrame:
    """Apply :func:`clean_encoding` to every string column, in one projection."""
    return df.select([
        clean_encoding(F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def truncate(c: Column, limit: int = MAX_TEXT_CHARS) -> Column:
    """The first ``limit`` characters."""
    return F.substring(c, 1, limit)


def chunks(c: Column) -> Column:
    """Sentences and bullet items, stripped, without blanks; the whole text if there are none."""
    parts = F.filter(F.transform(F.split(c, CHUNK_BREAK, -1), strip), lambda x: x != "")
    return F.when(F.size(parts) > 0, parts).otherwise(F.array(c))


def word_count(c: Column) -> Column:
    """Number of whitespace-separated words, at least 1."""
    return F.size(F.split(strip(c), SPACE + "+"))


def any_of(words) -> str:
    """A regular expression that matches any of the given literal strings."""
    return "|".join(rf"\Q{w}\E" for w in words)
