"""Jobs from files to files: products, reviews, images, model, decisions, reports.

Tables between the jobs are Parquet below one folder; reports and coefficients are CSV.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plugwatch import schemas
from plugwatch.functions.specs import QUANTITIES, specs_json
from plugwatch.operators import images as im
from plugwatch.operators.decisions import match_spot_checks, training_rows
from plugwatch.operators.model import TrainedModel, evaluate, train
from plugwatch.operators.reviews import (
    negativity, review_scores, with_feedback_scores, with_vectors,
)
from plugwatch.plans import flows
from plugwatch.session import stored, work_dir
from plugwatch.settings import MODEL_FEATURES, NO_RECALLS, RecallLists
from plugwatch.sources import adapters as ad
from plugwatch.sources import files as fi


def process_products(spark: SparkSession, raw: str, out: str, adapters: Mapping[str, ad.Adapter],
                     pairs: DataFrame | None = None, recalls: RecallLists | DataFrame = NO_RECALLS,
                     for_model: bool = False, multi_line: bool = True) -> DataFrame:
    """Raw product files to ``products``, the sellers to ``sellers``, broken records to
    ``broken_products``, the files that gave nothing to ``unread_products``, and how each
    marketplace went to ``marketplaces``. The files are read once, whatever the number of
    marketplaces, and one that fails does not end the others."""
    rows = stored(fi.read_raw_products(spark, raw, multi_line=multi_line))
    stored(fi.split_broken(rows)[1], f"{out}/broken_products")
    stored(fi.unread_files(spark, raw, "product", rows), f"{out}/unread_products")
    products, sellers, outcomes = ad.standardise_each(spark, ad.from_rows(rows), adapters, for_model)
    stored(outcomes, f"{out}/marketplaces")
    stored(sellers, f"{out}/sellers")
    return stored(flows.clean_products(products, pairs, recalls), f"{out}/products")


def process_reviews(spark: SparkSession, raw: str, out: str,
                    adapters: Mapping[str, ad.Adapter] | None = None, *,
                    danger_of: Callable[[Column], Column],
                    negativity_of: Callable[[Column], Column] = negativity,
                    make_encoder: Callable[[], Callable] | None = None,
                    multi_line: bool = True) -> DataFrame:
    """Raw review files to ``reviews``, their sums to ``review_scores``, broken records to
    ``broken_reviews``, and the files that gave nothing to ``unread_reviews``. ``danger_of`` must be
    given, as danger is a feature of the model; with ``make_encoder`` it finds the vector of each
    text, made once per distinct text, in the column ``vector``."""
    records = stored(fi.read_review_records(
        spark, raw, ad.legacy_ids(adapters or {}), multi_line=multi_line))
    rows, broken = fi.split_broken(fi.each_review(records))
    stored(broken, f"{out}/broken_reviews")
    stored(fi.unread_files(spark, raw, "review", records), f"{out}/unread_reviews")
    if make_encoder:
        rows = with_vectors(rows, make_encoder)
    cleaned, _ = flows.clean_reviews(with_feedback_scores(rows, negativity_of, danger_of))
    reviews = stored(cleaned, f"{out}/reviews")
    stored(review_scores(reviews), f"{out}/review_scores")
    return reviews


def _opened_by_spark(spark: SparkSession, chosen: DataFrame, batch_files: int) -> Iterator[DataFrame]:
    """The chosen files batch by batch. The paths are written by batch, so that each is read once."""
    batches, path = 1 + chosen.count() // batch_files, work_dir(spark)
    batch = F.pmod(F.xxhash64("path"), F.lit(batches)).cast("int").alias("batch")
    chosen.select("path", batch).repartition("batch").write.partitionBy("batch").parquet(path)
    dealt = spark.read.schema("path string, batch int").parquet(path)
    for i in range(batches):
        paths = [r["path"] for r in dealt.where(F.col("batch") == i).collect()]
        if paths:
            yield fi.open_images(spark, paths)


def predict_images(spark: SparkSession, raw: str, out: str, make_detector: Callable,
                   marketplace: str | None = None, max_images: int | None = None,
                   batch_files: int = 50_000) -> DataFrame:
    """Image files to ``image_predictions``, and those on which the detector fails, or that can't be
    read, with the error, to ``image_failures``.

    Images are chosen by their listed paths alone. Of local files the tasks open the chosen ones, at most
    ``batch_files`` each; of another store they are opened in batches of some ``batch_files``, whose
    paths are all that the driver holds. Bytes go from the file to the detector in one task, and never
    through an exchange.
    """
    chosen = fi.list_images(spark, raw, marketplace)
    if max_images:
        chosen = im.cap_images(chosen, max_images)
    chosen, told_path = stored(chosen), work_dir(spark)
    if fi.is_local(spark, raw):
        opened = [fi.open_chosen(chosen, min(batch_files, 256))]
    else:
        opened = _opened_by_spark(spark, chosen, batch_files)
    for images in opened:
        im.detect_or_error(images, make_detector).write.mode("append").parquet(told_path)
    told = (spark.read.schema(im.DETECTED_DDL).parquet(told_path) if chosen.take(1)
            else spark.createDataFrame([], im.DETECTED_DDL))
    unread = chosen.join(told.select("path"), "path", "left_anti").select(
        "product_id", "path", F.lit("the file can't be read").alias("error"))
    failed = told.where("error IS NOT NULL").select("product_id", "path", "error")
    stored(failed.unionByName(unread), f"{out}/image_failures")
    return stored(told.where("error IS NULL").select("product_id", "path", "predictions"),
                  f"{out}/image_predictions")


def build_model(spark: SparkSession, out: str, spot_checks: str, label_prefix: str = "",
                features: tuple[str, ...] = MODEL_FEATURES) -> TrainedModel:
    """Train on the spot-check CSV; write coefficients, metrics, source rows and the rows the
    model gets wrong."""
    flags = ("compliant_flag", "non_compliant_flag", "ambiguous_flag", "irrelevant_product_flag")
    schema = "product_id string, product_group string, " + ", ".join(
        f"{label_prefix}{f} int" for f in flags)
    checks = fi.read_csv(spark, spot_checks, schema)
    products = spark.read.parquet(f"{out}/products")
    sums = review_scores(spark.read.schema(schemas.SCORED_REVIEWS).parquet(f"{out}/reviews"),
                         ["product_id"], keep_null_keys=False)
    rows, source = training_rows(
        match_spot_checks(products, checks, sums), features, label_prefix=label_prefix)
    rows = stored(rows)
    model = train(rows, features, intercept=True)
    metrics, wrong = evaluate(model, rows)
    fi.write_csv(model.coefficient_table(spark), f"{out}/model/coefficients")
    fi.write_csv(metrics, f"{out}/model/metrics")
    fi.write_csv(wrong, f"{out}/model/misclassified")
    stored(source, f"{out}/model/source")
    return model


def load_coefficients(spark: SparkSession, path: str,
                      schema: str = schemas.COEFFICIENTS) -> tuple[dict[str, float], float]:
    """Weights and intercept of a coefficient table with one row."""
    rows = fi.read_csv(spark, path, schema).limit(2).collect()
    if len(rows) != 1:
        raise ValueError("the coefficient table must have exactly one row")
    weights = rows[0].asDict()
    weights.pop("class")
    return weights, weights.pop("intercept")


def predict(spark: SparkSession, out: str, fill_missing: float | None = None) -> DataFrame:
    """Products, image predictions and review scores to ``decisions``."""
    predictions = spark.read.schema(schemas.IMAGE_PREDICTIONS).parquet(
        f"{out}/image_predictions")
    flags = stored(flows.image_flags(predictions), f"{out}/image_flags")
    merged = flows.evidence(
        spark.read.parquet(f"{out}/products"), flags,
        spark.read.schema(schemas.REVIEW_SCORES).parquet(f"{out}/review_scores"))
    weights, intercept = load_coefficients(spark, f"{out}/model/coefficients")
    return stored(flows.decisions(merged, weights, intercept, fill_missing), f"{out}/decisions")


def summarise(spark: SparkSession, out: str) -> None:
    """The five reports of ``decisions`` as CSV, specs as JSON text."""
    decided = spark.read.parquet(f"{out}/decisions")
    decided = decided.withColumns({q: specs_json(decided[q]) for q in QUANTITIES})
    for name, report in flows.all_reports(decided).items():
        fi.write_csv(report, f"{out}/reports/{name}")
