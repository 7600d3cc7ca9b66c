"""Rule scores of the electrical specs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plugwatch.functions.numbers import limit_ok_sql, parse_range_sql, voltage_ok_sql
from plugwatch.operators.rules import known_groups, rule_flag
from plugwatch.settings import AMPERAGE_LIMIT, GROUP_RULES, WATTAGE_LIMIT, GroupRule

# --- Fixed values: context words and penalties ------------------------------------------
SIDE_WORDS = {
    "voltage": ("input",),
    "amperage": ("input", "output", "amperage", "current"),
    "wattage": ("input", "output", "wattage", "power"),
}
SKIPPED_VOLTAGE_WORDS = ("output",)
CLEAR_PENALTY, UNCLEAR_PENALTY = 1.0, 0.5


def score_specs(
    specs: str,
    check: str,
    clear_words: tuple[str, ...] = (),
    skipped_words: tuple[str, ...] = (),
    reset: bool = True,
    lenient: bool = True,
) -> Column:
    """Penalty of the contexts that come before the first context that passes.

    ``check`` is a SQL condition on ``n``, a value parsed to ``struct(first, second)``. A
    context passes if any value does (``lenient``) or if all do. Contexts with one of
    ``skipped_words`` do not count. A failing context costs more if its key has one of
    ``clear_words``. With ``reset`` one passing context makes the score 0. Null specs have a
    null score.
    """
    def has_word(words: tuple[str, ...]) -> str:
        return " OR ".join(f"contains(lower(s.context), '{w}')" for w in words) or "false"

    passes = (f"{'exists' if lenient else 'forall'}("
              f"transform(s.values, v -> {parse_range_sql('v')}), n -> {check})")
    # Per counted context: 0 when it passes, else its penalty.
    penalties = (
        f"transform(filter(`{specs}`, s -> NOT ({has_word(skipped_words)})), s -> CASE"
        f" WHEN {passes} THEN 0D WHEN {has_word(clear_words)} THEN {CLEAR_PENALTY}D"
        f" ELSE {UNCLEAR_PENALTY}D END)"
    )
    # Those that count: none after a pass with ``reset``, else the ones before the first pass.
    before = ("if(array_contains(p, 0D), filter(p, x -> false), p)" if reset else
              "if(array_contains(p, 0D), slice(p, 1, cast(array_position(p, 0D) AS int)), p)")
    # The one-element array binds the penalties, so that every value is parsed once.
    return F.expr(f"transform(array({penalties}), p -> aggregate({before}, 0D,"
                  f" (total, x) -> total + x))[0]")


def voltage_score(specs: str, exact: str) -> Column:
    return score_specs(specs, voltage_ok_sql("n", exact), SIDE_WORDS["voltage"],
                       SKIPPED_VOLTAGE_WORDS)


def amperage_score(specs: str, exact: str) -> Column:
    return score_specs(specs, limit_ok_sql("n", AMPERAGE_LIMIT, exact), SIDE_WORDS["amperage"])


def wattage_score(specs: str) -> Column:
    return score_specs(specs, limit_ok_sql("n", WATTAGE_LIMIT, "false"), SIDE_WORDS["wattage"],
                       reset=False, lenient=False)


def with_spec_scores(df: DataFrame, rules: tuple[GroupRule, ...] = GROUP_RULES) -> DataFrame:
    """Add the three scores by the rules of each row's group; groups without a rule drop out."""
    exact = {f"_{s}": rule_flag(s, rules) for s in ("exact_voltage", "exact_amperage")}
    return df.where(known_groups(rules)).withColumns(exact).withColumns({
        "voltage_score": voltage_score("voltage_info", "_exact_voltage"),
        "amperage_score": amperage_score("amperage_info", "_exact_amperage"),
        "wattage_score": wattage_score("wattage_info"),
    }).drop(*exact)


def coverage(df: DataFrame) -> DataFrame:
    """How many rows have each spec, all three, each score, and how many are irrelevant.

    Counts only the columns that exist; one row, one pass.
    """
    specs = ["voltage_info", "amperage_info", "wattage_info"]
    scores = ["voltage_score", "amperage_score", "wattage_score"]
    counts = [F.count(c).alias(f"with_{c}") for c in specs + scores if c in df.columns]
    if all(c in df.columns for c in specs):
        complete = F.col(specs[0]).isNotNull() & F.col(specs[1]).isNotNull() \
            & F.col(specs[2]).isNotNull()
        counts.append(F.count_if(complete).alias("with_all_specs"))
    if "is_irrelevant" in df.columns:
        counts.append(F.count_if(F.col("is_irrelevant")).alias("irrelevant"))
    return df.agg(F.count(F.lit(1)).alias("products"), *counts)
