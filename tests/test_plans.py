"""What the plans must look like to hold at scale."""

import pytest
from pyspark.sql import functions as F

from plugwatch.operators import decisions as de
from plugwatch.operators import images as im
from plugwatch.operators import reports as rp
from plugwatch.plans import catalog, flows, views


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


NO_STORE = [n for n in catalog.QUERIES if n not in (
    "train_model", "scan_raw_products", "scan_raw_reviews", "csv_round_trip")]


@pytest.mark.parametrize("name", NO_STORE)
def test_no_query_pairs_up_all_rows(spark, sf_dir, name):
    text = plan(catalog.QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text  # no row-at-a-time Python


def test_scoring_products_needs_no_shuffle_and_no_python(spark, sf_dir):
    products = views.derived(views.table(spark, sf_dir, "part"), views.PRODUCTS)
    text = plan(flows.clean_products(products, recalls=views.RECALLS))
    assert "Exchange" not in text and "Python" not in text


def test_scans_read_only_what_is_needed(spark, sf_dir):
    part = views.derived(views.table(spark, sf_dir, "part"), views.PRODUCTS)
    text = plan(flows.clean_products(part).select("product_id", "voltage_score"))
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_size:int>" in text
    pairs = plan(views.pairs(spark, sf_dir))
    assert "PushedFilters: [IsNotNull(p_size), LessThanOrEqual(p_size,2)]" in pairs


def test_image_cap_limits_before_the_shuffle(spark, sf_dir):
    paths = views.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("product_id"), F.col("event_id").alias("path"))
    text = plan(im.cap_images(paths, 5))
    assert text.count("WindowGroupLimit") == 2


def test_summary_expands_only_group_counts(spark):
    df = spark.range(10).selectExpr("string(id) AS g", "true AS f")
    text = plan(rp.summary_with_total(df, "g", {"f": F.col("f")}))
    lines = text.splitlines()
    expand = next(i for i, line in enumerate(lines) if "Expand" in line)
    # Below the expansion: the aggregated groups, not the rows.
    assert "HashAggregate" in lines[expand + 1] or "HashAggregate" in lines[expand + 2]


def test_specs_are_searched_once(spark, sf_dir):
    assert plan(views.cleaned(spark, sf_dir)).count("flatten(transform") == 3
    # Reports filter a stored table, so the search is not repeated in a pushed filter.
    text = plan(rp.group_summary(views.decided(spark, sf_dir)))
    assert "flatten(transform" not in text
    assert "PushedFilters: [IsNotNull(is_irrelevant), Not(EqualTo(is_irrelevant,true))" in text


def test_large_pair_lists_are_not_broadcast(spark, sf_dir):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = views.cleaned(spark, sf_dir).select("product_id", "is_irrelevant")
        assert "Broadcast" not in plan(df)
        irrelevant = df.where("is_irrelevant").count()
        merged = plan(de.merge_evidence(
            views.products(spark, sf_dir), views.image_flags(spark, sf_dir),
            views.image_flags(spark, sf_dir).selectExpr(
                "product_id", "'m' AS marketplace", "1D AS danger_score")))
        assert "Broadcast" not in merged
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert irrelevant == views.cleaned(spark, sf_dir).where("is_irrelevant").count()


# product_upsert: the target once, and the stored, reduced source for the join and for the union.
@pytest.mark.parametrize("name, most", [("image_entries", 6), ("product_upsert", 3), ("seller_upsert", 8)])
def test_merges_scan_their_tables_few_times(spark, sf_dir, name, most):
    """Base tables in the plan that is run; what is stored before counts as one table."""
    assert plan(catalog.QUERIES[name](spark, sf_dir)).count("FileScan") <= most
