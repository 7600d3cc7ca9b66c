from pyspark.sql import functions as F

from plugwatch.plans import flows, views
from plugwatch.schemas import RAW_PRODUCT
from plugwatch.session import stored
from plugwatch.sources import files as fi
from plugwatch.streaming import incremental


def test_whole_run(spark, sf_dir):
    """Train on the spot-checks, decide with the trained weights, write all reports."""
    cleaned = stored(views.cleaned(spark, sf_dir))
    reviews = views.scored_reviews(spark, sf_dir)
    model = flows.build_model(cleaned, views.spot_checks(spark, sf_dir), reviews)
    weights = model.coefficients()[0]
    assert weights.pop("class") == "non_compliant"
    intercept = weights.pop("intercept")
    _, scores = flows.clean_reviews(reviews)
    merged = flows.evidence(cleaned, views.image_flags(spark, sf_dir), scores)
    decided = stored(flows.decisions(merged, weights, intercept, fill_missing=0.0))
    assert decided.count() == cleaned.count()
    reports = {name: df.count() for name, df in flows.all_reports(decided).items()}
    assert reports["main_summary"] == 6
    assert set(reports) == {"main_summary", "score_summary", "query_summary",
                            "marketplace_summary", "non_compliant_list"}


def test_text_is_cut_after_the_flags(spark):
    from plugwatch.settings import PRODUCT_COLUMNS

    values = {c: None for c in PRODUCT_COLUMNS if not c.endswith("_info")}
    values |= {"product_id": "1", "product_group": "Group A", "text": "x " * 6000 + "adapter 230V"}
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"`{c}` string" for c in values))
    assert len(flows.clean_products(df).first().text) == 12_012
    row = flows.clean_products(df, clean_encoding=True, max_text_chars=10_000).first()
    assert row.adapter_flag and row.voltage_score == 0.0
    assert len(row.text) == 9999  # cut to 10000, then the last space is stripped


def test_new_files_are_scored_once(spark, sf_dir, tmp_path):
    products = views.products(spark, sf_dir).withColumns(
        {"date": F.lit("2024-01-01"), "productgroup": F.col("product_group")})
    columns = ["product_id", "title", "text", "url", "seller_id", "query", "category",
               "manufacturer", "date", "productgroup", "marketplace"]
    root, out, state = (str(tmp_path / n) for n in ("raw", "out", "state"))
    half = F.col("marketplace") == "mk_a"

    def run():
        stream = incremental.stream_products(spark, root, RAW_PRODUCT)
        query = incremental.score_new_products(stream, out, state, views.pairs(spark, sf_dir),
                                               views.RECALLS)
        query.awaitTermination(300)
        assert query.exception() is None
        return spark.read.parquet(out)

    fi.write_partitioned(products.where(half).select(*columns), root, kind="products")
    # Reviews beside the products are not taken for products, and broken lines are kept.
    fi.write_partitioned(products.limit(3).select(*columns), root, kind="reviews")
    folder = next((tmp_path / "raw").glob("date=*/productgroup=*/marketplace=*"))
    (folder / "more_Products.json").write_text('{"product_id": \n')
    first = run().count()
    query = incremental.keep_broken(incremental.stream_products(spark, root, RAW_PRODUCT),
                                    f"{out}-broken", f"{state}-broken")
    query.awaitTermination(300)
    broken = spark.read.parquet(f"{out}-broken").collect()
    assert [r[fi.CORRUPT].strip() for r in broken] == ['{"product_id":']
    fi.write_partitioned(products.where(~half).select(*columns), root, kind="products")
    both = run()
    want = views.cleaned(spark, sf_dir)
    assert 0 < first < both.count() == want.count()
    keys = ["product_id", "voltage_score", "is_irrelevant", "recalled_flag", "ip_rating"]
    assert both.select(*keys).exceptAll(want.select(*keys)).count() == 0
