"""Merge of products, images and reviews; score adjustments; logistic model; decision."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plugwatch.operators.joins import join_unique
from plugwatch.settings import (
    DROPPED_CLASSES, MODEL_CLASSES, MODEL_FEATURES, SOCKET_TAGS, TEXT_THRESHOLD,
)

# --- Fixed values: groups whose scores industrial use does not reset ----------------------
INDUSTRIAL_VOLTAGE_GROUPS = ("Group B",)
INDUSTRIAL_AMPERAGE_GROUPS = ("Group B", "Group E")


def merge_evidence(products: DataFrame, image_flags: DataFrame, reviews: DataFrame) -> DataFrame:
    """Products with the image flags of their id and the review scores of their id and
    marketplace, where known. Both right sides have one row per key.

    A null marketplace matches a null one.
    """
    by_image = join_unique(products, image_flags, ["product_id"])
    scores = reviews.withColumnsRenamed({"product_id": "_pid", "marketplace": "_market"})
    match = (by_image["product_id"] == scores["_pid"]) \
        & by_image["marketplace"].eqNullSafe(scores["_market"])
    return by_image.join(scores, match, "left").drop("_pid", "_market")


def adjust_industrial(df: DataFrame) -> DataFrame:
    """Industrial products get score 0 (voltage and amperage not in the groups that keep it),
    missing scores become 0, and the flag is dropped."""
    industrial = F.coalesce(F.col("industrial_flag"), F.lit(False))

    def unless(groups: tuple[str, ...]) -> Column:
        kept = F.coalesce(F.col("product_group").isin(list(groups)), F.lit(False))
        return industrial & ~kept

    resets = {
        "wattage_score": industrial,
        "voltage_score": unless(INDUSTRIAL_VOLTAGE_GROUPS),
        "amperage_score": unless(INDUSTRIAL_AMPERAGE_GROUPS),
    }
    return df.withColumns({
        c: F.when(reset, 0.0).otherwise(F.coalesce(F.col(c), F.lit(0.0)))
        for c, reset in resets.items() if c in df.columns
    }).drop("industrial_flag")


def adjust_ip(df: DataFrame) -> DataFrame:
    """Poor sealing counts only for products sold as waterproof; without a rating it is null."""
    waterproof = F.coalesce(F.col("waterproof_flag"), F.lit(False))
    return df.withColumn("adjusted_ip_incompliance",
                         F.when(waterproof, F.col("ip_incompliance")).otherwise(F.lit(False)))


def adjust_reviews(df: DataFrame) -> DataFrame:
    """Squared sum over count for both review scores; null without reviews."""
    return df.withColumns({
        f"adjusted_{c}": F.try_divide(F.col(c) * F.col(c), F.col("review_count"))
        for c in ("negativity_score", "danger_score")
    })


def adjust(df: DataFrame) -> DataFrame:
    return adjust_reviews(adjust_ip(adjust_industrial(df)))


def match_spot_checks(products: DataFrame, spot_checks: DataFrame,
                      scores: DataFrame | None = None) -> DataFrame:
    """Every spot-check with its product rows by (product_id, product_group), or with nulls;
    then with the review scores of the product, if given.

    Matched and unmatched spot-checks are found apart, by an inner and an anti join, because
    a right join could not split a product key that holds very many rows.
    """
    keys = ["product_id", "product_group"]
    matched = products.join(spot_checks, keys)
    unmatched = spot_checks.join(products.select(*keys).distinct(), keys, "left_anti")
    out = matched.unionByName(unmatched, allowMissingColumns=True)
    return out if scores is None else join_unique(out, scores, ["product_id"])


def training_rows(
    df: DataFrame,
    features: tuple[str, ...] = MODEL_FEATURES,
    classes: tuple[str, ...] = MODEL_CLASSES,
    dropped: tuple[str, ...] | None = DROPPED_CLASSES,
    label_prefix: str = "",
) -> tuple[DataFrame, DataFrame]:
    """Model rows ``product_id, features, classes`` without nulls, and their source rows.

    Scores are adjusted; irrelevant products and rows of the dropped classes leave. Labels
    come from the columns ``<prefix>compliant_flag``, ``<prefix>non_compliant_flag``,
    ``<prefix>ambiguous_flag`` and ``<prefix>irrelevant_product_flag``.
    """
    names = {"compliant_flag": "compliant", "non_compliant_flag": "non_compliant",
             "ambiguous_flag": "ambiguous", "irrelevant_product_flag": "irrelevant"}
    source = adjust(df).where(~F.coalesce(F.col("is_irrelevant"), F.lit(False)))
    source = source.withColumnsRenamed({label_prefix + k: v for k, v in names.items()})
    rows = source
    for c in dropped or ():
        rows = rows.where(~F.coalesce(F.col(c).cast("boolean"), F.lit(False)))
    rows = rows.select("product_id", *[
        F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in (*features, *classes)
    ])
    return rows, source


def logistic(df: DataFrame, weights: Mapping[str, float], intercept: float,
             out: str = "predicted_prob", fill_missing: float | None = None) -> DataFrame:
    """Add 1 / (1 + exp(-(intercept + sum of weight * feature))).

    A missing feature value makes the result null, or counts as ``fill_missing`` if given.
    """
    missing = [f for f in weights if f not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    logit = F.lit(float(intercept))
    for feature, weight in weights.items():
        value = F.col(feature).cast("double")
        if fill_missing is not None:
            value = F.coalesce(value, F.lit(fill_missing))
        logit = logit + value * F.lit(float(weight))
    return df.withColumn(out, F.lit(1.0) / (F.lit(1.0) + F.exp(-logit)))


def decide(df: DataFrame, tags: tuple[str, ...] = SOCKET_TAGS,
           threshold: float = TEXT_THRESHOLD) -> DataFrame:
    """Add ``final_non_compliant``: likely by text, poorly sealed, bad socket, or recalled.

    Unknown evidence counts as none.
    """
    def known(c: Column) -> Column:
        return F.coalesce(c.cast("boolean"), F.lit(False))

    df = df.withColumns({
        "adjusted_ip_incompliance": known(F.col("adjusted_ip_incompliance")),
        **{t: known(F.col(f"`{t}`")) for t in tags},
    })
    verdict = F.coalesce(F.col("text_nc_prob") > threshold, F.lit(False)) \
        | F.col("adjusted_ip_incompliance") | known(F.col("recalled_flag"))
    for t in tags:
        verdict = verdict | F.col(f"`{t}`")
    return df.withColumn("final_non_compliant", verdict)
