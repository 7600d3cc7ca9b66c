"""The whole jobs: products, reviews, model, decisions, reports.

Each flow is one lazy plan, except where a job stores its result for the next ones.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plugwatch.functions.specs import expand_specs
from plugwatch.functions.text import clean_string_columns, truncate
from plugwatch.operators import reports
from plugwatch.operators.decisions import (
    adjust, decide, logistic, match_spot_checks, merge_evidence, training_rows,
)
from plugwatch.operators.flags import (
    with_ip_rating, with_irrelevance, with_recalls, with_text_flags,
)
from plugwatch.operators.images import image_maxima, product_image_flags
from plugwatch.operators.model import TrainedModel, train
from plugwatch.operators.reviews import review_scores
from plugwatch.operators.scoring import with_spec_scores
from plugwatch.settings import GROUP_RULES, NO_RECALLS, TAG_THRESHOLD, GroupRule, RecallLists


def clean_products(
    products: DataFrame,
    pairs: DataFrame | None = None,
    recalls: RecallLists | DataFrame = NO_RECALLS,
    rules: tuple[GroupRule, ...] = GROUP_RULES,
    find_specs: bool = True,
    clean_encoding: bool = False,
    max_text_chars: int | None = None,
) -> DataFrame:
    """Standard products to scored and flagged products, without a shuffle except for the
    curated pairs when they are too many to broadcast. Texts are whole unless
    ``max_text_chars`` says otherwise.

    Store the result before filtering on its flags: Spark would push such a filter below the
    text search and run the search twice.
    """
    df = products.where(F.col("product_group").isin([r.product_group for r in rules]))
    if find_specs:
        df = expand_specs(df)
    df = with_spec_scores(df, rules)
    df = with_text_flags(df)
    df = with_irrelevance(df, pairs, rules)
    df = with_recalls(df, recalls)
    df = with_ip_rating(df)
    if max_text_chars is not None:
        df = df.withColumn("text", truncate(F.col("text"), max_text_chars))
    return clean_string_columns(df) if clean_encoding else df


def clean_reviews(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cleaned scored reviews, and their sums per product and marketplace."""
    reviews = clean_string_columns(scored.select(
        "product_id", "marketplace", "review_text", "negativity_score", "danger_score"))
    return reviews, review_scores(reviews)


def image_flags(predictions: DataFrame, min_probability: float = TAG_THRESHOLD) -> DataFrame:
    """Flags per product from nested predictions, one row per image."""
    return product_image_flags(image_maxima(predictions, min_probability), min_probability)


def evidence(products: DataFrame, flags: DataFrame, scores: DataFrame) -> DataFrame:
    """Cleaned products merged with image flags and review scores, with adjusted scores."""
    return adjust(merge_evidence(products, flags, scores))


def decisions(merged: DataFrame, weights: Mapping[str, float], intercept: float,
              fill_missing: float | None = None) -> DataFrame:
    """Probability by text and final decision of merged products."""
    return decide(logistic(merged, weights, intercept, "text_nc_prob", fill_missing))


def model_rows(products: DataFrame, spot_checks: DataFrame, reviews: DataFrame,
               label_prefix: str = "") -> DataFrame:
    """The spot-checks of cleaned products with their features; ``reviews`` are scored reviews."""
    per_product = review_scores(reviews, ["product_id"], keep_null_keys=False)
    return training_rows(
        match_spot_checks(products, spot_checks, per_product), label_prefix=label_prefix)[0]


def build_model(products: DataFrame, spot_checks: DataFrame, reviews: DataFrame,
                label_prefix: str = "", intercept: bool = True) -> TrainedModel:
    """Train on the rows of :func:`model_rows`."""
    return train(model_rows(products, spot_checks, reviews, label_prefix), intercept=intercept)


def all_reports(decided: DataFrame) -> dict[str, DataFrame]:
    """The five reports. Pass a stored table: each report reads it anew."""
    return {
        "main_summary": reports.group_summary(decided),
        "score_summary": reports.score_summary(decided),
        "query_summary": reports.query_summary(decided),
        "marketplace_summary": reports.marketplace_summary(decided),
        "non_compliant_list": reports.non_compliant_list(decided),
    }
