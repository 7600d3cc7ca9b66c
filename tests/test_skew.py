"""One key holds a third of the rows: results stay whole and hot keys are split."""

import contextlib

from pyspark.sql import functions as F

from plugwatch.operators import decisions as de
from plugwatch.operators import numbering as nu
from plugwatch.operators import upsert as up
from plugwatch.operators.annotations import entries, latest_images, regions
from plugwatch.operators.attribution import attribute_queries, current_results
from plugwatch.operators.flags import listed
from plugwatch.operators.images import cap_images

HOT = "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('p', CAST(id % 4000 AS STRING)) END"
ROWS = 240_000


@contextlib.contextmanager
def small_limits(spark):
    """Runtime limits of a cluster, scaled down to test data."""
    values = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, value in values.items():
            spark.conf.set(k, value)
        yield
    finally:
        for k, value in old.items():
            spark.conf.unset(k) if value is None else spark.conf.set(k, value)


def rows(spark):
    return spark.range(0, ROWS, 1, 8).selectExpr("id", f"{HOT} AS product_id",
                                                 "'m' AS marketplace", "md5(string(id)) AS pad")


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_product_is_split_in_the_merge(spark):
    flags = rows(spark).groupBy("product_id").agg(F.count("id").alias("image_count"))
    scores = flags.selectExpr("product_id", "'m' AS marketplace", "image_count AS review_count")
    with small_limits(spark):
        out = de.merge_evidence(rows(spark), flags, scores)
        assert "skew=true" in executed(out.select("product_id", "image_count", "review_count",
                                                  "pad"))
        assert out.count() == ROWS
        assert out.where("image_count IS NULL OR review_count IS NULL").count() == 0


def test_hot_key_is_split_in_flags_attribution_and_append(spark):
    data = rows(spark).withColumn("query", F.col("pad"))
    listing = data.where("id % 7 = 0").select("product_id")
    found = data.selectExpr("product_id", "'q' AS query", "1 AS query_no")
    with small_limits(spark):
        assert "skew=true" in executed(listed(data, listing, ["product_id"], "f"))
        assert "skew=true" in executed(attribute_queries(data, found))
        out = up.checked_append(data.where("id < 10"), data,
                                up.Constraints(("product_id",)), ["id"])
        assert executed(out).count("skew=true") >= 2


def test_hot_image_is_split_in_the_regions(spark):
    boxes = rows(spark).selectExpr(
        "if(product_id = 'hot', 7, id % 4000) AS image_id", "id % 5 AS category_id", "id AS pos",
        "array(0.1D, 0.1D, 0.1D, 0.1D) AS bbox")
    listed_images = spark.range(0, 8000, 1, 4).selectExpr(
        "id % 4000 AS id", "id AS pos", "10 AS width", "10 AS height", "'u' AS url")
    categories = spark.createDataFrame([(1, "a"), (2, None)], "id long, name string")
    with small_limits(spark):
        out = regions(boxes, latest_images(listed_images), categories)
        assert executed(out).count("skew=true") >= 1
        assert out.count() == ROWS


def test_hot_product_is_split_in_the_spot_checks(spark):
    products = rows(spark).withColumn("product_group", F.lit("g"))
    checks = spark.createDataFrame([("hot", "g", 1), ("none", "g", 2)],
                                   "product_id string, product_group string, label int")
    with small_limits(spark):
        out = de.match_spot_checks(products, checks)
        assert dict(out.groupBy("label").count().collect()) == {1: ROWS // 3, 2: 1}


def test_first_rows_of_a_hot_key(spark):
    data = rows(spark)
    with small_limits(spark):
        capped = cap_images(data.withColumnRenamed("pad", "path"), 3)
        assert capped.groupBy("product_id").count().agg(F.max("count")).first()[0] == 3
        assert capped.where("product_id = 'hot'").count() == 3
        best = up.one_per_key(data, ["product_id"], ["id"])
        assert best.where("product_id = 'hot'").first().id == ROWS - 3


def test_append_with_a_hot_key(spark):
    data = rows(spark).select("id", "product_id")
    target = spark.createDataFrame([("p1",)], "product_id string")
    with small_limits(spark):
        out = up.checked_append(target, data, up.Constraints(("product_id",)), ["id"])
        kept = out.where("reason IS NULL")
        keys = data.select("product_id").distinct().count()
        assert kept.count() == keys - 1
        assert kept.where("product_id = 'hot'").first().id == 0
        assert out.count() == ROWS


def test_results_of_a_hot_query(spark):
    results = rows(spark).selectExpr("CAST(id % 2 AS INT) AS run", "product_id AS query",
                                     "CAST(id AS INT) AS position", "pad AS product_id")
    with small_limits(spark):
        got = current_results(results)
        last = results.groupBy("query").agg(F.max("run").alias("run"))
        assert got.count() == results.join(last, ["query", "run"], "left_semi").count()


def test_entries_of_a_hot_image(spark):
    images = spark.range(4000).selectExpr("id", "10 AS width", "10 AS height",
                                          "concat('u', id) AS url")
    flat = spark.range(0, ROWS, 1, 8).selectExpr(
        "if(id % 3 = 0, 7, id % 3000) AS image_id", "id AS pos", "'t' AS tag_name", "0D AS left",
        "0D AS top", "0D AS width", "0D AS height"
    ).withColumn("url", F.concat(F.lit("u"), F.col("image_id").cast("string")))
    with small_limits(spark):
        out = entries(images, flat).select("url", F.size("regions").alias("n")).cache()
        assert out.agg(F.sum("n")).first()[0] == ROWS
        assert out.count() == out.select("url").distinct().count() == 4000


def test_numbering_does_not_depend_on_order_or_partitions(spark):
    data = rows(spark).select("id")
    first = nu.number_rows(data, ["id"])
    again = nu.number_rows(data.repartition(5), ["id"])
    assert first.exceptAll(again).count() == 0
