"""Group rules as column expressions.

The rules are configuration of a known small size, so they become literals of the plan:
no join, no shuffle, and the group filter reaches the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plugwatch.settings import GROUP_RULES, GroupRule


def _is_one_of(column: str, values) -> str:
    """SQL condition, false for null and for an empty list."""
    quoted = ", ".join("'{}'".format(v.replace("\\", "\\\\").replace("'", "\\'")) for v in values)
    return f"coalesce(`{column}` IN ({quoted}), false)" if quoted else "false"


def known_groups(rules: tuple[GroupRule, ...] = GROUP_RULES,
                 group: str = "product_group") -> Column:
    """True for rows whose group has a rule; other rows leave the flow."""
    return F.col(group).isin([r.product_group for r in rules])


def rule_flag(setting: str, rules: tuple[GroupRule, ...] = GROUP_RULES,
              group: str = "product_group") -> Column:
    """A boolean rule setting of the row's group."""
    return F.expr(_is_one_of(group, [r.product_group for r in rules if getattr(r, setting)]))


def in_irrelevant_category(rules: tuple[GroupRule, ...] = GROUP_RULES,
                           group: str = "product_group", category: str = "category") -> Column:
    """True where the category is on the irrelevant list of the row's group."""
    return F.expr(" OR ".join(
        f"({_is_one_of(group, [r.product_group])}"
        f" AND {_is_one_of(category, r.irrelevant_categories)})" for r in rules) or "false")


def rule_table(spark: SparkSession, rules: tuple[GroupRule, ...] = GROUP_RULES) -> DataFrame:
    """The rules as a table, one row per group."""
    rows = [(r.product_group, list(r.query_list), list(r.irrelevant_categories),
             r.required_image, r.exact_voltage, r.exact_amperage, r.high_volts_only)
            for r in rules]
    return spark.createDataFrame(rows, (
        "product_group string, query_list array<string>, irrelevant_categories array<string>,"
        " required_image boolean, exact_voltage boolean, exact_amperage boolean,"
        " high_volts_only boolean"
    ))
