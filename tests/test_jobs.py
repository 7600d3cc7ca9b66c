"""All jobs in a row, from raw files to reports."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from plugwatch import schemas
from plugwatch.functions import specs as sp
from plugwatch.plans import jobs
from plugwatch.sources import adapters as ad


def put(path, value):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(value if isinstance(value, str) else json.dumps(value))


def adapter(rows):
    none = {q: F.lit(None).cast(schemas.SPEC_DDL) for q in sp.QUANTITIES}
    sellers = rows.select(F.col("seller_id").alias("Name"), F.col("url").alias("URL"))
    return rows.drop("category").withColumns(none), sellers


@pytest.fixture
def raw(tmp_path):
    for market, group in (("alpha", "Group A"), ("beta", "Group B")):
        root = tmp_path / "raw" / "date=2024-01-01" / f"productgroup={group}" \
            / f"marketplace={market}"
        put(root / "products.json", [
            {"product_id": f"{market}{i}", "title": "t", "url": "u", "seller_id": "s",
             "query": "q", "manufacturer": "m",
             "text": f"Charger {i}. Input: {'230V' if i % 2 else '110V'}, 13A\nIP{i % 6}{i % 8}"}
            for i in range(20)])
        put(root / "reviews.json", [
            {"product_id": f"{market}{i}", "reviews": [
                {"content": "broken and dangerous" if i % 2 == 0 else "good"}]}
            for i in range(20)])
        for i in range(3):
            put(root / "images" / f"{market}1_image_{i}.jpg", "x" * (i + 1))
    lines = ["product_id,product_group,my_compliant_flag,my_non_compliant_flag,my_ambiguous_flag,"
             "my_irrelevant_product_flag"]
    lines += [f"{m}{i},{g},{i % 2},{1 - i % 2},0,0"
              for m, g in (("alpha", "Group A"), ("beta", "Group B")) for i in range(20)]
    put(tmp_path / "spot.csv", "\n".join(lines) + "\n")
    return tmp_path


def test_all_jobs(spark, raw):
    source, out = str(raw / "raw"), str(raw / "out")
    adapters = {"alpha": ad.Adapter(adapter), "beta": ad.Adapter(adapter)}

    with open(f"{source}/date=2024-01-01/broken_products.json", "w") as f:
        f.write('[{"product_id": "x", "title": }, 7]')
    products = jobs.process_products(spark, source, out, adapters)
    assert products.count() == 40
    told = spark.read.parquet(f"{out}/marketplaces").select("marketplace", "outcome", "products")
    assert sorted(map(tuple, told.collect())) == [("alpha", "rows", 20), ("beta", "rows", 20)]
    lost = spark.read.parquet(f"{out}/broken_products").collect()
    assert sorted((r._position, r._reason) for r in lost) == [(1, "broken")]
    assert spark.read.parquet(f"{out}/unread_products").count() == 0
    assert spark.read.parquet(f"{out}/sellers").count() == 40
    with pytest.raises(TypeError):
        jobs.process_reviews(spark, source, out, adapters)
    reviews = jobs.process_reviews(spark, source, out, adapters, danger_of=lambda t: F.lit(0.0))
    assert reviews.where("negativity_score > 0").count() == 20

    def encoder():
        return lambda texts: np.array([[len(t)] for t in texts], dtype="float32")

    told = jobs.process_reviews(
        spark, source, str(raw / "o3"), adapters, make_encoder=encoder,
        danger_of=lambda t: F.get(F.col("vector"), 0).cast("double"))
    assert {(r.review_text, r.danger_score) for r in told.collect()} == {
        ("broken and dangerous", 20.0), ("good", 4.0)}

    def make():
        def detect(content):
            return [("Socket section/UK-German non-compliant", 0.95 if len(content) == 2 else 0.1)]
        return detect

    found = jobs.predict_images(spark, source, out, make, max_images=2)
    assert found.count() == 4
    assert jobs.predict_images(spark, source, str(raw / "o2"), make, "alpha").count() == 3

    model = jobs.build_model(spark, out, str(raw / "spot.csv"), label_prefix="my_")
    weights, intercept = jobs.load_coefficients(spark, f"{out}/model/coefficients")
    assert weights["voltage_score"] > 0
    assert intercept == pytest.approx(model.coefficients()[0]["intercept"])

    decided = jobs.predict(spark, out, fill_missing=0.0)
    assert decided.count() == 40
    socket = decided.where("`Socket section/UK-German non-compliant`")
    assert sorted(r.product_id for r in socket.collect()) == ["alpha1", "beta1"]
    # Wrong voltage is what the spot-checks reject.
    by_text = decided.where("text_nc_prob > 0.5").select("product_id").collect()
    assert {int(r[0].lstrip("alphbet")) % 2 for r in by_text} == {0}

    jobs.summarise(spark, out)
    summary = spark.read.csv(f"{out}/reports/main_summary", header=True)
    assert sorted(r.product_group for r in summary.collect()) == ["Group A", "Group B", "TOTAL"]
    listed = spark.read.csv(f"{out}/reports/non_compliant_list", header=True, escape='"')
    assert json.loads(listed.first().voltage_info).keys() <= {"input", "unspecified"}


def test_images_that_fail_are_kept(spark, raw):
    def make():
        def detect(content):
            if len(content) == 2:
                raise ValueError("broken")
            return [("x", 0.5)]
        return detect

    out = str(raw / "o3")
    found = jobs.predict_images(spark, str(raw / "raw"), out, make)
    failed = spark.read.parquet(f"{out}/image_failures").collect()
    images = spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
        "pathGlobFilter", "*.jpg").load(str(raw / "raw")).select("length", "path").collect()
    assert {r.path for r in failed} == {r.path for r in images if r.length == 2} != set()
    assert {r.error for r in failed} == {"ValueError('broken')"}
    assert found.count() + len(failed) == len(images)
