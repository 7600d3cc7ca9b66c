"""Product flags from text, category, recall lists and curated pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plugwatch.functions.text import any_of, strip
from plugwatch.operators.joins import join_unique
from plugwatch.operators.phrases import kinds_in_texts, text_key
from plugwatch.operators.rules import in_irrelevant_category, known_groups, rule_flag
from plugwatch.session import stored
from plugwatch.settings import GROUP_RULES, IP_MOISTURE_MIN, NO_RECALLS, GroupRule, RecallLists

# --- Fixed values: patterns ----------------------------------------------------------------
ADAPTER = "adapter"
INDUSTRIAL = "industrial|commercial"
WATERPROOF = (
    r"(?iU)\b(?:water\s*(?:proof(?:ed)?|resistant)|splash\s*(?:proof|resistant)"
    r"|sealed\s*(?:against)?\s*water|moisture\s*(?:sealed|resistant)"
    r"|weather\s*(?:proof|resistant))\b"
)
ACCESSORY = "filter|bag|backpacks|case"
USB = "usb"
# The look-ahead spares the test for a word boundary at most places.
IP_RATING = r"(?iU)(?=IP)\bIP[0-9X][0-9]\b"


def _mentions(text: Column, pattern: str, any_case: bool = False) -> Column:
    if not pattern:
        return F.lit(False)
    return F.coalesce(text.rlike(f"(?iu){pattern}" if any_case else pattern), F.lit(False))


def with_text_flags(df: DataFrame, text_col: str = "text", any_case: bool = False) -> DataFrame:
    """Add ``adapter_flag``, ``industrial_flag`` and ``waterproof_flag``.

    The first two look for lower-case words unless ``any_case`` is set.
    """
    text = F.col(text_col)
    return df.withColumns({
        "adapter_flag": _mentions(text, ADAPTER, any_case),
        "industrial_flag": _mentions(text, INDUSTRIAL, any_case),
        "waterproof_flag": _mentions(text, WATERPROOF),
    })


def listed(df: DataFrame, listing: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """Add a boolean: is the row's key in ``listing``? Rows are neither dropped nor repeated.

    No broadcast is forced: Spark broadcasts the distinct keys only when their measured size
    allows, and otherwise splits a hot key of ``df`` at run time.
    """
    marks = listing.select(*keys).dropna().distinct().withColumn(flag, F.lit(True))
    return join_unique(df, marks, keys).withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def with_irrelevance(df: DataFrame, pairs: DataFrame | None = None,
                     rules: tuple[GroupRule, ...] = GROUP_RULES,
                     any_case: bool = False) -> DataFrame:
    """Add ``is_irrelevant``; rows of groups without a rule drop out.

    Irrelevant are: listed categories, accessories without any spec, USB products in the
    groups that want mains voltage only, and curated (product, group) pairs.
    """
    text = F.col("text")
    no_specs = F.col("voltage_info").isNull() & F.col("amperage_info").isNull() \
        & F.col("wattage_info").isNull()
    irrelevant = (
        in_irrelevant_category(rules)
        | (_mentions(text, ACCESSORY, any_case) & no_specs)
        | (rule_flag("high_volts_only", rules) & _mentions(text, USB, any_case))
    )
    out = df.where(known_groups(rules)).withColumn("is_irrelevant", irrelevant)
    if pairs is None:
        return out
    out = listed(out, pairs, ["product_id", "product_group"], "_listed")
    return out.withColumn(
        "is_irrelevant", F.col("is_irrelevant") | F.col("_listed")).drop("_listed")


# Characters of the recalled models and brands up to which one automaton looks for them; it
# takes some 40 bytes for each.
PHRASE_CHARS = 2_000_000
_MODEL, _BRAND = 1, 2


def _kinds_found(text: Column, phrases: Sequence[tuple[str, int]]) -> Column:
    """The kinds of the phrases that a text holds, as bits; all are looked for in one reading."""
    built = []

    @F.arrow_udf(T.IntegerType())
    def found(texts):
        import ahocorasick
        import pyarrow as pa

        if not built:
            built.append(ahocorasick.Automaton())
            for phrase, kinds in phrases:
                built[0].add_word(phrase, kinds)
            built[0].make_automaton()

        def kinds_in(value):
            seen = 0
            for _, kinds in built[0].iter(value or ""):
                seen |= kinds
                if seen == _MODEL | _BRAND:
                    break
            return seen

        return pa.array(map(kinds_in, texts.to_pylist()), pa.int32())

    return found(text)


def with_recall_table(df: DataFrame, recalls: DataFrame, phrase_chars: int = PHRASE_CHARS) -> DataFrame:
    """:func:`with_recalls` for a table (kind, value) of any length; kinds are ``id``, ``model``
    and ``brand``.

    Ids and manufacturers are joined. Models and brands inside a text are found by an automaton if they
    have less than ``phrase_chars`` characters; more of them by a filter and a join
    (:mod:`plugwatch.operators.phrases`), which read each text once, whatever the number of phrases.
    Null and empty values match nothing, other kinds are not looked at.
    """
    wanted = stored(recalls.select("kind", F.col("value").cast("string").alias("value")).where(
        "kind IN ('id', 'model', 'brand') AND value <> ''").distinct())
    of = lambda kind, c: wanted.where(F.col("kind") == kind).select(c)
    out = df.withColumn("manufacturer", strip(F.coalesce(F.col("manufacturer"), F.lit(""))))
    out = listed(out, of("id", F.col("value").alias("product_id")), ["product_id"], "_listed_id")
    out = listed(out.withColumn("_maker", F.lower("manufacturer")),
                 of("brand", F.lower("value").alias("_maker")), ["_maker"], "_listed_maker")
    bit = F.when(F.col("kind") == "model", _MODEL).otherwise(_BRAND)
    phrases = wanted.where("kind <> 'id'").groupBy("value").agg(F.bit_or(bit).alias("kinds"))
    chars = phrases.agg(F.sum(F.length("value").cast("long"))).first()[0] or 0
    if chars < phrase_chars:
        rows = [(r["value"], r["kinds"]) for r in phrases.collect()]
        out = out.withColumn("_kinds", _kinds_found(F.col("text"), rows) if rows else F.lit(0))
    else:
        found = kinds_in_texts(df.select("text"), phrases, (_MODEL, _BRAND))
        out = join_unique(out.withColumn("_text", text_key(F.col("text"))),
                          found.select(F.col("text_key").alias("_text"), F.col("kinds").alias("_kinds")),
                          ["_text"]).drop("_text").withColumn("_kinds", F.coalesce("_kinds", F.lit(0)))
    holds = lambda kind: F.col("_kinds").bitwiseAND(F.lit(kind)) != 0
    return out.withColumns({
        "recalled_flag": F.col("_listed_id") | holds(_MODEL),
        "is_recall_brand": F.col("_listed_maker") | holds(_BRAND),
    }).drop("_listed_id", "_listed_maker", "_maker", "_kinds")


def with_recalls(df: DataFrame, recalls: RecallLists | DataFrame = NO_RECALLS) -> DataFrame:
    """Add ``recalled_flag`` and ``is_recall_brand``; ``manufacturer`` is stripped.

    An empty list matches nothing. Short lists become literals of the plan; give long ones as a
    table (:func:`with_recall_table`).
    """
    if isinstance(recalls, DataFrame):
        return with_recall_table(df, recalls)
    text = F.col("text")

    def member(c: Column, values) -> Column:
        return F.coalesce(c.isin(list(values)), F.lit(False)) if values else F.lit(False)

    maker = strip(F.coalesce(F.col("manufacturer"), F.lit("")))
    return df.withColumns({
        "manufacturer": maker,
        "recalled_flag": _mentions(text, any_of(recalls.models))
        | member(F.col("product_id"), recalls.ids),
        "is_recall_brand": member(F.lower(maker), [b.lower() for b in recalls.brands])
        | _mentions(text, any_of(recalls.brands)),
    })


def with_ip_rating(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Add the first IP rating, its two digits and whether the second is too low.

    All four are null without a rating; an ``X`` digit is null.
    """
    # One search per row; the digits come from the short match.
    rated = df.withColumn(
        "ip_rating", F.nullif(F.regexp_extract(F.col(text_col), IP_RATING, 0), F.lit("")))
    rating = F.col("ip_rating")
    moisture = F.substring(rating, 4, 1).try_cast("bigint")
    return rated.withColumns({
        "ip_ingress": F.substring(rating, 3, 1).try_cast("bigint"),
        "ip_moisture": moisture,
        "ip_incompliance": moisture < IP_MOISTURE_MIN,
    })
