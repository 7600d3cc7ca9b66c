"""Consecutive numbers over a whole table, without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plugwatch.settings import UPLOAD_BATCH


# Rows of a bucket, which one task sorts, and buckets of a block, whose sizes one task adds up.
BUCKET_ROWS, BLOCK = 10_000, 4096


def number_rows(df: DataFrame, key: list[str], out: str = "row_no",
                bucket_rows: int = BUCKET_ROWS, block: int = BLOCK) -> DataFrame:
    """Number the rows 1, 2, 3, … in the order of the MD5 of ``key``, then ``key``.

    ``key`` must be unique and without nulls. The leading 48 bits of the hash cut the rows into
    even ranges of some ``bucket_rows``, as many as the table needs; a row's number is its
    rank in its bucket plus the size of the buckets before. These are added up in two levels, within
    blocks of buckets and over the blocks, so that no task sees more than a bucket's rows,
    ``block`` buckets, or a row for each block.
    """
    digest = F.md5(F.concat_ws("\x1f", *[F.col(k).cast("string") for k in key]))
    buckets = 1 + df.count() // bucket_rows
    point = F.conv(F.substring("_md5", 1, 12), 16, 10).cast("long")
    # The hash as a share of its range: 30 bits of it times the buckets fit a long.
    bucket = F.shiftright(F.shiftright(point, 18) * F.lit(buckets).cast("long"), 30)
    keyed = df.withColumn("_md5", digest).withColumn("_bucket", bucket)
    sizes = keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size")).withColumn(
        "_block", F.expr(f"_bucket div {int(block)}"))
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(
        F.sum("_size").over(earlier(Window.partitionBy("_block").orderBy("_bucket"))), F.lit(0))
    blocks = sizes.groupBy("_block").agg(F.sum("_size").alias("_size"))
    above = F.coalesce(F.sum("_size").over(earlier(Window.orderBy("_block"))), F.lit(0))
    offsets = sizes.withColumn("_inside", inside).join(
        blocks.select("_block", above.alias("_above")), "_block").select(
        "_bucket", (F.col("_inside") + F.col("_above")).alias("_offset"))
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_md5", *key))
    return (
        keyed.withColumn("_rank", rank)
        .join(offsets, "_bucket")
        .withColumn(out, F.col("_offset") + F.col("_rank"))
        .drop("_md5", "_bucket", "_rank", "_offset")
    )


def with_batches(df: DataFrame, key: list[str], size: int = UPLOAD_BATCH,
                 out: str = "batch") -> DataFrame:
    """Cut the table into batches of ``size`` rows, numbered from 0."""
    numbered = number_rows(df, key, "_row_no")
    return numbered.withColumn(
        out, F.expr(f"(_row_no - 1) div {int(size)}")).drop("_row_no")


def batch_of_position(position: Column, size: int = UPLOAD_BATCH) -> Column:
    """Batch number of a row whose position (from 0) is known: no shuffle at all."""
    return F.floor(position / F.lit(size)).cast("bigint")
