"""Report tables over the decided products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plugwatch.settings import REPORT_COLUMNS, SOCKET_TAGS, TEXT_THRESHOLD, TOP_QUERIES


def _relevant(df: DataFrame) -> DataFrame:
    return df.where(~F.col("is_irrelevant"))


def _percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole) * 100


def _count_true(c: Column, name: str) -> Column:
    return F.count_if(F.coalesce(c.cast("boolean"), F.lit(False))).alias(name)


def summary_with_total(df: DataFrame, group: str, flags: dict[str, Column]) -> DataFrame:
    """Rows and true flags per group with percentages, and a ``TOTAL`` row.

    The roll-up runs over the finished group counts, so the data is not expanded for it.
    """
    counts = df.where(F.col(group).isNotNull()).groupBy(group).agg(
        F.count(F.lit(1)).alias("total_count"),
        *[_count_true(c, f"{n}_count") for n, c in flags.items()],
    )
    names = ["total_count", *[f"{n}_count" for n in flags]]
    rolled = counts.rollup(group).agg(
        F.grouping(group).alias("_is_total"), *[F.sum(n).alias(n) for n in names])
    # A roll-up of no groups still has a total row, with null sums.
    rolled = rolled.where(F.col("total_count").isNotNull())
    return rolled.select(
        F.when(F.col("_is_total") == 1, "TOTAL").otherwise(F.col(group)).alias(group),
        "total_count",
        *[c for n in flags for c in (
            F.col(f"{n}_count"),
            _percent(F.col(f"{n}_count"), F.col("total_count")).alias(f"{n}_%"),
        )],
    )


def group_summary(df: DataFrame, threshold: float = TEXT_THRESHOLD,
                  tags: tuple[str, ...] = SOCKET_TAGS) -> DataFrame:
    """Non-compliance of the relevant products per group, by kind of evidence."""
    socket = F.lit(False)
    for t in tags:
        socket = socket | F.coalesce(F.col(f"`{t}`").cast("boolean"), F.lit(False))
    return summary_with_total(_relevant(df), "product_group", {
        "non_compliant": F.col("final_non_compliant"),
        "ip_non_compliant": F.col("adjusted_ip_incompliance"),
        "recalled": F.col("recalled_flag"),
        "socket_non_compliant": socket,
        "text_non_compliant": F.col("text_nc_prob") > threshold,
    })


def score_summary(df: DataFrame) -> DataFrame:
    """Mean scores and number of recalled brands per group, for the columns that exist."""
    means = [c for c in ("voltage_score", "amperage_score", "wattage_score",
                         "adjusted_danger_score") if c in df.columns]
    aggs = [F.avg(c).alias(c) for c in means]
    if "is_recall_brand" in df.columns:
        aggs.append(_count_true(F.col("is_recall_brand"), "is_recall_brand"))
    return _relevant(df).where(F.col("product_group").isNotNull()) \
        .groupBy("product_group").agg(*aggs)


def _ratio_by(df: DataFrame, key: str) -> DataFrame:
    """Distinct products, non-compliant rows and their ratio per key. As it sets rows against
    distinct products, the ratio can exceed 100."""
    return _relevant(df).where(F.col(key).isNotNull()).groupBy(key).agg(
        F.countDistinct("product_id").alias("total_products"),
        _count_true(F.col("final_non_compliant"), "non_compliant_products"),
    ).withColumn("non_compliant_%",
                 _percent(F.col("non_compliant_products"), F.col("total_products")))


def query_summary(df: DataFrame, top: int = TOP_QUERIES) -> DataFrame:
    """The queries with the highest ratios; equal ratios by name."""
    return _ratio_by(df, "query").orderBy(F.desc("non_compliant_%"), "query").limit(top)


def marketplace_summary(df: DataFrame) -> DataFrame:
    """All marketplaces by falling ratio."""
    return _ratio_by(df, "marketplace").orderBy(F.desc("non_compliant_%"), "marketplace")


def non_compliant_list(df: DataFrame, columns: tuple[str, ...] = REPORT_COLUMNS) -> DataFrame:
    """The relevant products found non-compliant."""
    return _relevant(df).where(F.col("final_non_compliant")).select(
        *[F.col(f"`{c}`") for c in columns])
