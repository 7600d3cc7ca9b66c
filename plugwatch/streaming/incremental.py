"""Scoring of newly arrived raw files.

The raw layout grows by dated folders. The row-wise operators run unchanged on a file stream,
so each file is read once over all runs instead of the whole layout at every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from plugwatch.functions.text import clean_listing_text
from plugwatch.plans.flows import clean_products
from plugwatch.schemas import RAW_PRODUCT
from plugwatch.settings import GROUP_RULES, NO_RECALLS, GroupRule, RecallLists
from plugwatch.sources.files import CORRUPT


def stream_products(spark: SparkSession, root: str, schema: str = RAW_PRODUCT,
                    files_per_batch: int = 1000) -> DataFrame:
    """Raw products of the partitioned layout as a stream of JSON lines, of the files with
    ``product`` in their name. A line that can't be read has only ``_corrupt_record``."""
    raw = (
        spark.readStream
        .schema(f"{schema}, date string, productgroup string, marketplace string, {CORRUPT} string")
        .option("maxFilesPerTrigger", files_per_batch)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", "*[pP][rR][oO][dD][uU][cC][tT]*.json")
        .json(root)
    )
    return raw.withColumnRenamed("productgroup", "product_group").withColumn(
        "text", clean_listing_text(F.col("text")))


def score_new_products(
    products: DataFrame, out: str, checkpoint: str, pairs: DataFrame | None = None,
    recalls: RecallLists = NO_RECALLS, rules: tuple[GroupRule, ...] = GROUP_RULES,
) -> StreamingQuery:
    """Clean, score and flag all files not seen yet, append them to ``out``, then stop. Broken
    lines are left out: see :func:`keep_broken`."""
    good = products.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return _append(clean_products(good, pairs, recalls, rules), out, checkpoint)


def keep_broken(products: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append the broken lines of all files not seen yet, with their folder and the id if it could be
    read, to ``out``, then stop."""
    broken = products.where(F.col(CORRUPT).isNotNull()).select(
        "date", "product_group", "marketplace", "product_id", CORRUPT)
    return _append(broken, out, checkpoint)


def _append(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    return (
        rows.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", checkpoint).outputMode("append")
        .trigger(availableNow=True).start()
    )
