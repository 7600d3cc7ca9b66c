"""Image predictions, tag flags per product, and choice of images."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plugwatch.settings import SOCKET_TAGS, TAG_THRESHOLD

PREDICTION_DDL = "array<struct<tag:string,probability:double>>"
DETECTED_DDL = "product_id string, path string, predictions array<map<string,double>>, error string"


def parse_predictions(text: Column) -> Column:
    """Read ``[{tag: probability}, …]`` text, with single or double quotes."""
    return F.from_json(text, "array<map<string,double>>")


def sort_predictions(predictions: Column) -> Column:
    """Order tag/probability pairs by probability, highest first."""
    return F.array_sort(
        predictions,
        lambda a, b: F.when(a["probability"] > b["probability"], -1)
        .when(a["probability"] < b["probability"], 1).otherwise(0),
    )


def tag_maximum(predictions: Column, tag: str, min_probability: float) -> Column:
    """Largest probability of a tag in an array of one-entry maps, at least
    ``min_probability``, else 0. The case of the tag does not matter."""
    entries = F.flatten(F.transform(predictions, F.map_entries))
    hits = F.filter(entries, lambda e: (F.lower(e["key"]) == tag.lower())
                    & (e["value"] >= min_probability))
    return F.coalesce(F.array_max(F.transform(hits, lambda e: e["value"])), F.lit(0.0))


def image_maxima(df: DataFrame, min_probability: float = 0.5,
                 tags: tuple[str, ...] = SOCKET_TAGS) -> DataFrame:
    """Replace the nested ``predictions`` of each image by one column per tag, in the row."""
    maxima = {t: tag_maximum(F.col("predictions"), t, min_probability) for t in tags}
    return df.withColumns(maxima).drop("predictions")


def image_maxima_flat(df: DataFrame, min_probability: float = 0.5,
                      tags: tuple[str, ...] = SOCKET_TAGS) -> DataFrame:
    """The same from rows ``product_id, image_id, tag_name, probability``.

    Images without a wanted tag stay, with zeros.
    """
    def largest(tag: str) -> Column:
        hit = (F.lower("tag_name") == tag.lower()) & (F.col("probability") >= min_probability)
        return F.coalesce(F.max(F.when(hit, F.col("probability"))), F.lit(0.0)).alias(tag)

    return df.groupBy("product_id", "image_id").agg(*[largest(t) for t in tags])


def product_image_flags(maxima: DataFrame, min_probability: float = TAG_THRESHOLD,
                        tags: tuple[str, ...] = SOCKET_TAGS) -> DataFrame:
    """Image count per product and one 0/1 flag per tag: sum of the maxima above the limit.

    The sum must exceed the limit, so a single image exactly at the limit does not flag.
    """
    return maxima.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("image_count"),
        *[(F.sum(f"`{t}`") > min_probability).cast("int").alias(t) for t in tags],
    )


def image_id(path: Column) -> Column:
    """Product id from an image path: the file name up to ``_image``."""
    return F.substring_index(F.substring_index(path, "/", -1), "_image", 1)


def cap_images(df: DataFrame, max_images: int, key: str = "product_id",
               order: tuple[str, ...] = ("path",)) -> DataFrame:
    """The first ``max_images`` images of each product.

    Spark applies the limit before the shuffle too, so a product with very many images
    sends at most ``max_images`` rows per task.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= max_images).drop("_rank")


def image_urls(df: DataFrame, max_images: int | None = None) -> DataFrame:
    """``product_id, position, url`` of each product's first images; products without any
    drop out."""
    urls = F.col("images") if max_images is None else F.slice("images", 1, max_images)
    return df.select("product_id", F.posexplode(urls).alias("position", "url"))


def detect_or_error(images: DataFrame,
                    make_detector: Callable[[], Callable[[bytes], list]]) -> DataFrame:
    """A row per image, ``product_id, path, predictions, error``, by a caller's detector for
    ``path, content`` rows of a binary file scan.

    ``make_detector()`` runs once per task and returns a function from image bytes to
    ``[(tag, probability), …]``. Where it fails, ``predictions`` is null and ``error`` says why.
    """
    def run(batches):
        import pyarrow as pa

        detector = make_detector()
        for batch in batches:
            found, errors = [], []
            for content in batch.column("content").to_pylist():
                try:
                    tags = [{"tag": t, "probability": float(p)} for t, p in detector(content)]
                    error = None
                except Exception as err:  # one bad image must not end the job
                    tags, error = None, repr(err)
                found.append(tags)
                errors.append(error)
            yield pa.RecordBatch.from_pydict(
                {"path": batch.column("path"), "predictions": found, "error": errors},
                schema=pa.schema([
                    ("path", pa.string()),
                    ("predictions", pa.list_(pa.struct(
                        [("tag", pa.string()), ("probability", pa.float64())]))),
                    ("error", pa.string()),
                ]),
            )

    scored = images.select("path", "content").mapInArrow(
        run, f"path string, predictions {PREDICTION_DDL}, error string")
    pairs = sort_predictions(F.col("predictions"))
    return scored.select(
        image_id(F.col("path")).alias("product_id"), "path",
        F.transform(pairs, lambda p: F.create_map(p["tag"], p["probability"])).alias("predictions"),
        "error",
    )


def detect(images: DataFrame, make_detector: Callable[[], Callable[[bytes], list]]) -> DataFrame:
    """The predictions of :func:`detect_or_error`, without the images that failed."""
    return detect_or_error(images, make_detector).where("error IS NULL").select(
        "product_id", "predictions")


def rgb_jpeg(content: bytes) -> bytes:
    """Image bytes as an RGB JPEG of quality 95, for detectors that need it. Uses Pillow."""
    try:
        from io import BytesIO

        from PIL import Image
    except ImportError as err:
        raise ImportError("image conversion needs the optional package Pillow") from err
    with Image.open(BytesIO(content)) as img:
        out = BytesIO()
        (img if img.mode == "RGB" else img.convert("RGB")).save(out, "JPEG", quality=95)
        return out.getvalue()
