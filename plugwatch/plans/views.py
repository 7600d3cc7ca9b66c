"""The inputs of the registered queries, derived from the driver's tables.

The expressions are plain SQL that Spark and the checking engine read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plugwatch.functions.specs import expand_specs
from plugwatch.operators.images import image_maxima_flat, product_image_flags
from plugwatch.operators.reviews import danger, keyword_vectors, negativity, review_scores
from plugwatch.plans.flows import clean_products, decisions, evidence
from plugwatch.session import spread, stored
from plugwatch.settings import TAG_THRESHOLD, RecallLists

PRODUCTS = {
    "product_id": "concat('P', CAST(p_partkey AS STRING))",
    "marketplace": "CASE p_partkey % 3 WHEN 0 THEN 'mk_a' WHEN 1 THEN 'mk_b' ELSE 'mk_c' END",
    "product_group": (
        "CASE p_partkey % 6 WHEN 0 THEN 'Group A' WHEN 1 THEN 'Group B' WHEN 2 THEN 'Group C'"
        " WHEN 3 THEN 'Group D' WHEN 4 THEN 'Group E' ELSE 'Group Z' END"),
    "title": "p_name",
    "query": "p_type",
    "manufacturer": "p_brand",
    "category": ("CASE WHEN p_partkey % 17 = 0 THEN 'Radiators'"
                 " WHEN p_partkey % 13 = 0 THEN 'USB Cables' ELSE p_type END"),
    "url": "concat('https://shop.example/', CAST(p_partkey AS STRING))",
    "seller_id": "CAST(p_partkey % 100 AS STRING)",
    "text": (
        "concat(p_name,"
        " CASE p_partkey % 5 WHEN 0 THEN '. Input: AC 220-240V, 50/60Hz'"
        " WHEN 1 THEN '. Rated voltage: 110V' WHEN 2 THEN '. 230V mains supply'"
        " WHEN 3 THEN '. DC output 12V' ELSE '' END,"
        " CASE p_partkey % 4 WHEN 0 THEN '. Output USB-C 2.4A' WHEN 1 THEN '. 13A fuse'"
        " WHEN 2 THEN '. 500mA' ELSE '' END,"
        " CASE WHEN p_size > 25 THEN concat('. ', CAST(p_size * 100 AS STRING), 'W motor')"
        " WHEN p_size > 10 THEN '. 2kW' ELSE '' END,"
        " CASE p_partkey % 7 WHEN 0 THEN '. Waterproof, IP67 rated'"
        " WHEN 1 THEN '. Splash resistant IPX2' WHEN 2 THEN '. For industrial use'"
        " WHEN 3 THEN '. Comes with adapter and usb lead' WHEN 4 THEN '. Carry bag'"
        " ELSE '' END)"),
}
PAIRS = {"product_id": PRODUCTS["product_id"], "product_group": PRODUCTS["product_group"]}
PAIRS_WHERE = "p_size <= 2"
_DOC_PRODUCT = "concat('P', CAST(doc_id % 400 AS STRING))"
REVIEWS = {
    "review_id": "doc_id",
    "product_id": _DOC_PRODUCT,
    "marketplace": ("CASE (doc_id % 400) % 3 WHEN 0 THEN 'mk_a' WHEN 1 THEN 'mk_b'"
                    " ELSE 'mk_c' END"),
    "content": "text",
}
IMAGE_TAGS = {
    "product_id": "concat('P', CAST(user_id AS STRING))",
    "image_id": "event_id",
    "tag_name": (
        "CASE event_type WHEN 'purchase' THEN 'Socket section/UK-German non-compliant'"
        " WHEN 'error' THEN 'socket section/aus-north america non-compliant' ELSE 'Plug' END"),
    "probability": "CASE WHEN value > 200.0 THEN 0.95 ELSE value / 250.0 END",
}
SPOT_CHECKS = {
    "product_id": _DOC_PRODUCT,
    "product_group": PRODUCTS["product_group"].replace("p_partkey", "(doc_id % 400)"),
    "compliant_flag": "quality",
    "non_compliant_flag": "1 - quality",
    "ambiguous_flag": "toxic",
    "irrelevant_product_flag": "CASE WHEN doc_id % 31 = 0 THEN 1 ELSE 0 END",
}
LEXICON = {"worthless": -1.9, "stupid": -2.4, "idiot": -2.3, "trash": -1.5, "for": 1.9,
           "that": 2.7}
RECALLS = RecallLists(ids=("P7", "P1240"), models=("small ring",), brands=("Brand#7", "Brand#19"))
WEIGHTS = {"voltage_score": 1.1, "amperage_score": 0.7, "wattage_score": 0.4,
           "is_recall_brand": 0.9, "adjusted_danger_score": 25.0}
INTERCEPT = -0.8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows need much work each, spread over the cores."""
    return spread(table(spark, sf_dir, name))


def derived(df: DataFrame, view: dict[str, str], *names: str) -> DataFrame:
    return df.select(*[F.expr(view[n]).alias(n) for n in (names or view)])


def select_sql(view: dict[str, str], source: str, *names: str) -> str:
    return "SELECT " + ", ".join(f"{view[n]} AS {n}" for n in (names or view)) + f" FROM {source}"


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(texts(spark, sf_dir, "part"), PRODUCTS)


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(table(spark, sf_dir, "part").where(PAIRS_WHERE), PAIRS)


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(texts(spark, sf_dir, "documents"), REVIEWS)


def image_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(table(spark, sf_dir, "events"), IMAGE_TAGS)


def spot_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(table(spark, sf_dir, "labels"), SPOT_CHECKS)


def keywords(spark: SparkSession, sf_dir: str) -> list:
    """One keyword vector per label: its vector of lowest id."""
    vectors = table(spark, sf_dir, "embeddings").groupBy("label").agg(
        F.min_by("embedding", "vec_id").alias("embedding"))
    return keyword_vectors(vectors, "embedding", "label")


def scored_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews with both scores; the review's vector is the one of its id, if there is one."""
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("review_id"), "embedding")
    text = F.coalesce(F.col("content"), F.lit(""))
    return reviews(spark, sf_dir).join(vectors, "review_id", "left").select(
        "review_id", "product_id", "marketplace", text.alias("review_text"),
        negativity(text, LEXICON).alias("negativity_score"),
        danger(F.col("embedding"), text, keywords(spark, sf_dir)).alias("danger_score"),
    )


def image_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_image_flags(
        image_maxima_flat(image_tags(spark, sf_dir), TAG_THRESHOLD), TAG_THRESHOLD)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_products(products(spark, sf_dir), pairs(spark, sf_dir), RECALLS)


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned products with evidence. The cleaned products are stored first, as in a real
    run: a filter on a flag would otherwise be pushed below the text search and repeat it."""
    products = stored(cleaned(spark, sf_dir).drop("text"))
    return evidence(products, image_flags(spark, sf_dir),
                    review_scores(scored_reviews(spark, sf_dir)))


def decided(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decisions(merged(spark, sf_dir), WEIGHTS, INTERCEPT)


def with_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expand_specs(products(spark, sf_dir))
