import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from plugwatch import schemas
from plugwatch.functions import specs as sp
from plugwatch.operators import annotations as an
from plugwatch.plans import jobs
from plugwatch.session import work_dir
from plugwatch.sources import adapters as ad
from plugwatch.sources import files as fi
from plugwatch.sources import tolerant
from plugwatch.sources.buckets import BucketTable


def put(path, value):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(value if isinstance(value, str) else json.dumps(value))


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.fixture
def raw(tmp_path):
    a = tmp_path / "date=2024-01-01" / "productgroup=Group A" / "marketplace=alpha"
    b = tmp_path / "date=2024-01-02" / "productgroup=group b" / "marketplace=beta"
    put(a / "products.json", [{"product_id": "1", "title": "x", "images": ["u"]},
                              {"product_id": "2", "title": "y"}])
    put(b / "My_PRODUCT.json", [{"product_id": "3", "title": "z"}])
    put(b / "broken_product.json", "{not json")
    put(b / "other.json", [{"product_id": "9"}])
    put(a / "reviews.json", [
        {"product_id": "1", "reviews": [
            {"content": "a", "rating": 1}, {"content": "b", "rating": "4 stars"}]},
        {"product_id": "", "sku": "s7", "reviews": [{"content": "c"}]},
        {"product_id": None, "reviews": []}])
    put(a / "broken_review.json", "{no review")
    return str(tmp_path)


def test_raw_products(spark, raw):
    good, broken = fi.split_broken(fi.read_raw_products(spark, raw))
    assert rows(good, "product_id", "title", "product_group", "marketplace") == [
        ("1", "x", "Group A", "alpha"), ("2", "y", "Group A", "alpha"),
        ("3", "z", "group b", "beta")]
    assert [r[fi.CORRUPT] for r in broken.collect()] == ["{not json"]
    only, _ = fi.split_broken(fi.read_raw_products(spark, raw, marketplace="alpha"))
    assert rows(only, "product_id") == [("1",), ("2",)]


def test_raw_reviews(spark, raw):
    # A rating of the wrong type is null, and costs neither its review nor its file.
    good, broken = fi.split_broken(fi.read_raw_reviews(spark, raw, legacy_ids=("asin", "sku")))
    assert rows(good, "product_id", "marketplace", "content", "rating") == [
        ("1", "alpha", "a", 1), ("1", "alpha", "b", None), ("s7", "alpha", "c", None)]
    assert [r[fi.CORRUPT] for r in broken.collect()] == ["{no review"]


def test_records_of_broken_arrays():
    fields = frozenset({"product_id", "reviews"})

    def told(text):
        return [(text[at:at + len(part)] == part, part, why) for at, part, why in tolerant.split_records(
            text, fields)]

    good = '{"product_id": "1", "reviews": [{"content": "a, {}"}]}'
    for broken in ('{"product_id": "2", "reviews": [{"content": "b"}, {"content": "c"}',
                   '{"product_id": "2', '{"product_id": }', '{"product_id": "2"]', "{", "nonsense"):
        assert told(f"[{good}, {broken},\n {good}]") == [
            (True, good, None), (True, broken, "broken"), (True, good, None)], broken
    assert told(f"[{good} {good}") == [(True, good, None)] * 2
    assert told(f"{good}\n{good}\n") == [(True, good, None)] * 2
    assert told(f'[7, null, "x", [{good}], {good}]') == [
        (True, x, "not a record") for x in ("7", "null", '"x"', f"[{good}]")] + [(True, good, None)]
    assert told(f"[{good}] tail") == [(True, good, None), (True, " tail", "after the end")]
    assert told("") == told("  \n") == told("[]") == told("[ ,]") == []
    assert [w for *_, w in told('[{"product_id": "\udcff"}]')] == ["encoding"]


def test_what_cannot_be_read_is_told(spark, tmp_path):
    folder = tmp_path / "productgroup=Group A" / "marketplace=alpha+1 %"
    put(folder / "products.json",
        '[{"product_id": "1"}, {"product_id": "2", "title": , {"product_id": "3", "images": ["u"]}, 8]')
    put(folder / "product_none.json", "[]")
    put(folder / "product_bad.json", '[{"product_id": "4"}]')
    # A checksum that doesn't fit: the file can be listed but not read.
    (folder / ".product_bad.json.crc").write_bytes(b"crc\x00\x00\x00\x02\x00" + b"\x01\x02\x03\x04")
    (folder / "product_bytes.json").write_bytes(b'[{"product_id": "5"}, {"product_id": "\xff"}, {"product_id": "6"}]')
    put(folder / "reviews.json", [{"product_id": "9", "reviews": [{"content": "c"}]}])
    df = fi.read_raw_products(spark, str(tmp_path))
    good, broken = fi.split_broken(df)
    assert rows(good, "product_id", "images", "marketplace") == [
        ("1", None, "alpha+1 %"), ("3", ["u"], "alpha+1 %"), ("5", None, "alpha+1 %"), ("6", None, "alpha+1 %")]
    name = F.substring_index(fi.FILE, "/", -1).alias("name")
    assert rows(broken.select(name, fi.POSITION, fi.REASON), "name", fi.POSITION, fi.REASON) == [
        ("product_bytes.json", 22, "encoding"), ("products.json", 22, "broken"),
        ("products.json", 91, "not a record")]
    unread = fi.unread_files(spark, str(tmp_path), "product", df)
    assert rows(unread.select(name, fi.REASON), "name", fi.REASON) == [
        ("product_bad.json", "nothing read"), ("product_none.json", "nothing read")]
    only, _ = fi.split_broken(fi.of_marketplace(df, "alpha+1 %"))
    assert only.count() == 4 and fi.of_marketplace(df, "beta").count() == 0


def test_both_kinds_in_one_layout(spark, tmp_path):
    where = "date string, productgroup string, marketplace string"
    products = spark.createDataFrame([("1", "t", "2024", "Group A", "m")], f"product_id string, title string, {where}")
    reviews = spark.createDataFrame([("9", "2024", "Group A", "m")], f"product_id string, {where}")
    for _ in range(2):
        fi.write_partitioned(products, str(tmp_path), kind="products")
    fi.write_partitioned(reviews, str(tmp_path), kind="reviews")
    back = fi.read_partitioned(spark, str(tmp_path), "product_id string, title string", "product")
    assert rows(back, "product_id", "title") == [("1", "t")] * 2
    assert rows(fi.read_partitioned(spark, str(tmp_path), "product_id string", "review"), "product_id") == [("9",)]


def test_partitioned_layout(spark, tmp_path):
    df = spark.createDataFrame(
        [("1", "2024", "Group A", "m"), ("2", "2024", "Group B", "n")],
        "product_id string, date string, productgroup string, marketplace string")
    fi.write_partitioned(df, str(tmp_path / "p"))
    back = fi.read_partitioned(spark, str(tmp_path / "p"), "product_id string")
    pruned = back.where("marketplace = 'n'")
    assert rows(pruned, "product_id", "productgroup") == [("2", "Group B")]
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(marketplace" in plan


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame(
        [(1, 'a "quoted", line\nbreak', ["x"]), (2, None, None), (3, "", [])],
        "id int, t string, l array<string>")
    fi.write_csv(df, path)
    back = fi.read_csv(spark, path, "id int, t string, l string")
    got = {r.id: (r.t, r.l) for r in back.collect()}
    assert got[1] == ('a "quoted", line\nbreak', '["x"]')
    assert got[2] == (None, None)


def test_image_predictions_as_text(spark, tmp_path):
    put(tmp_path / "p.csv", "product_id,predictions\nP1,\"[{'Plug': 0.5}, {'x': 0.25}]\"\n")
    df = fi.read_image_predictions(spark, str(tmp_path / "p.csv"))
    assert df.first().predictions == [{"Plug": 0.5}, {"x": 0.25}]


def test_annotation_document(spark, tmp_path):
    put(tmp_path / "a.json", {
        "images": [{"id": 1, "width": 2, "height": 3, "file_name": "f", "extra": 1}, {"id": 2}],
        "annotations": [{"image_id": 1, "category_id": 5, "bbox": [1, 2, 3, 4]}],
        "categories": [{"id": 5, "name": "n"}]})
    parts = fi.read_annotations(spark, str(tmp_path / "a.json"))
    assert rows(parts["images"], "pos", "id", "file_name") == [(0, 1, "f"), (1, 2, None)]
    assert rows(parts["annotations"], "image_id", "bbox") == [(1, [1.0, 2.0, 3.0, 4.0])]
    assert rows(parts["categories"], "id", "name") == [(5, "n")]


@pytest.mark.parametrize("wrapped", [True, False])
def test_image_entries(spark, tmp_path, wrapped):
    box = {"left": 0.1, "top": 0.2, "width": 0.3, "height": 0.4}
    images = [{"url": "u", "regions": [{"tagName": "t", **box}, {"tagId": "7", **box}]},
              {"url": "", "name": "n", "regions": []}, {"regions": [{"tagName": "t", **box}]}]
    put(tmp_path / "e.json", {"images": images} if wrapped else images)
    df = fi.read_image_entries(spark, str(tmp_path / "e.json"))
    assert rows(df, "url", "pos", "tag_id", "tag_name", "left") == [
        ("n", None, None, None, None), ("u", 0, None, "t", 0.1), ("u", 1, "7", None, 0.1)]


def test_written_image_entries_are_read_back(spark, tmp_path):
    images = spark.createDataFrame([(1, 10, 10, "u"), (2, 10, 10, "v")],
                                   "id long, width int, height int, url string")
    flat = spark.range(5).selectExpr(
        "1L AS image_id", "'u' AS url", "id AS pos", "'t' AS tag_name", "id / 10D AS left",
        "0D AS top", "0D AS width", "0D AS height")
    fi.write_image_entries(an.entries(images, flat), str(tmp_path / "out"))
    back = fi.read_image_entries(spark, str(tmp_path / "out"), multi_line=False)
    assert rows(back, "url", "tag_name", "left") == sorted(
        [("u", "t", i / 10) for i in range(5)] + [("v", None, None)], key=str)


def test_image_files(spark, tmp_path):
    for name in ("alpha/P1_image_0.jpg", "beta/P2_IMAGE_1.jpg", "beta/x.jpg", "a/P3_image_0.png"):
        put(tmp_path / name, "bytes")
    df = fi.list_images(spark, str(tmp_path))
    assert rows(df, "product_id") == [("P1",), ("P2_IMAGE_1.jpg",)]
    assert rows(fi.list_images(spark, str(tmp_path), "alpha"), "product_id") == [("P1",)]


def test_only_the_named_images_are_opened(spark, tmp_path):
    names = ("P[1]_image_0.jpg", "P*_image_0.jpg", "P{a,b}_image_1.jpg", "P%201_image_0.jpg", "P 2_image_0.jpg")
    for name in names:
        put(tmp_path / name, name)
    put(tmp_path / "P1_image_0.jpg", "another")
    paths = [r.path for r in fi.list_images(spark, str(tmp_path)).collect() if "P1_" not in r.path]
    df = fi.open_images(spark, paths)
    assert sorted(bytes(r.content).decode() for r in df.collect()) == sorted(names)
    # Bytes go straight from the scan to the task that looks at them.
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and len(df.inputFiles()) == len(names)


def test_an_appended_batch_counts_once(spark, tmp_path):
    path = str(tmp_path / "t")
    assert fi.append_rows(spark.range(3), path, "a") and fi.append_rows(spark.range(3, 5), path, "b")
    assert not fi.append_rows(spark.range(3), path, "a")
    assert rows(fi.read_appended(spark, path, "id long"), "id") == [(i,) for i in range(5)]
    # A batch whose job has not ended doesn't count, and is written anew.
    (tmp_path / "t" / "_batch=b" / "_SUCCESS").unlink()
    assert rows(fi.read_appended(spark, path, "id long"), "id") == [(i,) for i in range(3)]
    assert fi.append_rows(spark.range(3, 6), path, "b")
    assert fi.read_appended(spark, path, "id long").count() == 6
    assert fi.read_appended(spark, str(tmp_path / "none"), "id long").count() == 0
    with pytest.raises(ValueError):
        fi.append_rows(spark.range(3), path, "../b")


def test_a_merge_rewrites_only_touched_buckets(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError):
        table.read()
    df = spark.range(1000).selectExpr("id AS k", "id * 2 AS x", "'old' AS s")
    table.create(df.union(df.selectExpr("k", "x - 1", "'less'")), ["k"], 16, ["x"])
    assert table.read().exceptAll(df).count() == 0 and table.read().count() == 1000

    def files():
        return {f: (f.stat().st_mtime_ns, f.stat().st_size) for f in (tmp_path / "t").rglob("*.parquet")}

    before, first = files(), table.manifest()["folders"]
    source = spark.createDataFrame([(7, 1, "new"), (7, 9, "newer"), (5000, 1, "more"), (None, 3, "null")],
                                   "k long, x long, s string")
    touched = table.upsert(source, ["x"])
    assert 1 <= len(touched) <= 3
    after, now = files(), table.manifest()["folders"]
    assert {f: after[f] for f in before} == before
    assert {b for b in now if now[b] != first.get(b)} == {str(b) for b in touched}
    # Only the touched buckets' files were written: far fewer than there are buckets.
    assert len({f.parent for f in set(after) - set(before)}) == len(touched)
    want = {(i, i * 2, "old") for i in range(1000) if i != 7} | {(7, 9, "newer"), (5000, 1, "more"), (None, 3, "null")}
    assert {tuple(r) for r in table.read().collect()} == want and table.read().count() == len(want)
    assert table.read(0).count() == 1000
    # The same merge again changes no row, null keys included.
    table.upsert(source, ["x"])
    assert {tuple(r) for r in table.read().collect()} == want and table.versions() == [0, 1, 2]
    assert table.upsert(source.limit(0)) == [] and table.read().count() == len(want)
    with pytest.raises(RuntimeError):
        table._commit(1, {})
    assert table.vacuum(1) > 0 and {tuple(r) for r in table.read().collect()} == want


def adapter(df):
    none = {q: F.lit(None).cast(schemas.SPEC_DDL) for q in sp.QUANTITIES}
    return (df.drop("category").withColumns(none),
            df.select(F.col("seller_id").alias("Name"), F.lit("u").alias("URL")))


def test_adapters(spark, raw):
    def failing(df):
        return df.select("no_such_column"), df

    adapters = {"alpha": ad.Adapter(adapter), "beta": ad.Adapter(failing, "sku")}
    products, sellers = ad.standardise(ad.read_marketplace(spark, raw), adapters)
    assert rows(products, "product_id", "marketplace", "product_group") == [
        ("1", "alpha", "Group A"), ("2", "alpha", "Group A")]
    # An absent category is the query.
    assert rows(products, "category") == rows(products, "query")
    assert sellers.columns == ["Name", "URL", "Marketplace"]
    assert ad.legacy_ids(adapters) == ("sku",)
    with pytest.raises(ValueError):
        ad.standardise(ad.read_marketplace(spark, raw), {"beta": ad.Adapter(failing)})
    # For training the category must be given.
    with pytest.raises(ValueError):
        ad.standardise(ad.read_marketplace(spark, raw), {"alpha": ad.Adapter(adapter)}, True)


def test_a_marketplace_that_fails_in_a_task(spark, raw):
    def failing(df):
        # Passes the first row, so that the task fails half-way.
        bad = F.expr("if(product_id = '2', raise_error('second row'), title)")
        return adapter(df)[0].withColumn("title", bad), df

    def bad_sellers(df):
        found, sold = adapter(df)
        return found, sold.withColumn("Name", F.expr("raise_error('no seller')"))

    def empty(df):
        found, sold = adapter(df)
        return found.where("product_id IS NULL"), sold

    read = ad.read_marketplace(spark, raw)
    adapters = {"beta": ad.Adapter(failing), "alpha": ad.Adapter(adapter),
                "gamma": ad.Adapter(empty), "delta": ad.Adapter(bad_sellers)}
    products, sellers, outcomes = ad.standardise_each(
        spark, lambda name: read("alpha"), adapters)
    assert rows(products, "product_id", "marketplace") == [("1", "alpha"), ("2", "alpha")]
    assert rows(sellers, "Marketplace") == [("alpha",)] * 2 + [("gamma",)] * 2
    told = {r.marketplace: r for r in outcomes.collect()}
    assert {m: (r.outcome, r.products, r.sellers) for m, r in told.items()} == {
        "alpha": ("rows", 2, 2), "beta": ("error", 0, 0), "gamma": ("empty", 0, 2),
        "delta": ("error", 0, 0)}
    assert "second row" in told["beta"].error and "no seller" in told["delta"].error
    with pytest.raises(ValueError, match="second row"):
        ad.standardise_each(spark, lambda name: read("alpha"), {"beta": ad.Adapter(failing)})


class SharedFolder:
    """A session that names a shared folder, or a cluster session that does not."""

    def __init__(self, folder=None):
        self.folder, self.conf, self.sparkContext, self.master = folder, self, self, "yarn"

    def get(self, key, default):
        return self.folder if key == "spark.checkpoint.dir" and self.folder else default


def test_work_dir_is_in_the_shared_folder():
    assert work_dir(SharedFolder("hdfs:///x/")).startswith("hdfs:///x/plugwatch-")
    with pytest.raises(ValueError):
        work_dir(SharedFolder())


def _no_rename(*_):
    raise AssertionError("the driver renames no file")


def test_arrays_are_named_where_they_are_written(spark, tmp_path, monkeypatch):
    """Each folder has files of its own number, under names that the tasks give, and folders are
    named as Spark's writer names them."""
    monkeypatch.setattr(fi, "_renamed", _no_rename)
    odd = ["a", "b/c=d%", None, "", "x y+z", "é[ß]"]
    records = spark.range(600).selectExpr(
        "to_json(named_struct('product_id', CAST(id AS string))) AS record", "'2024-01-01' AS date",
        "'Group A' AS productgroup", "id % 6 AS k").join(
        spark.createDataFrame(list(enumerate(odd)), "k long, marketplace string"), "k").drop("k")
    root = tmp_path / "raw"
    fi.write_arrays(records, str(root), "products", 50)
    fi.write_arrays(records.limit(0), str(root), "products", 50)
    found = [p for p in root.rglob("*") if p.is_file()]
    assert len(found) <= 1 + 600 // 50 + 5 and all(p.name.startswith("products") for p in found)
    assert {p.suffix for p in found} == {".json"}
    plain = str(tmp_path / "spark")
    records.write.partitionBy("date", "productgroup", "marketplace").text(plain)
    folders = lambda top: {str(p.relative_to(top)) for p in Path(top).rglob("*") if p.is_dir()}
    assert folders(root) == folders(plain)
    got = fi.read_raw_products(spark, str(root)).select("product_id").collect()
    assert sorted(int(r[0]) for r in got) == list(range(600))


def test_text_of_a_broken_file_is_not_repeated(spark, tmp_path):
    """Of records cut out of a broken file none carries the text of the whole file."""
    (tmp_path / "products.json").write_text(
        "[" + ", ".join(['{"product_id": "%d", "title": "%s"}' % (i, "t" * 900) for i in range(30)])
        + ', {"product_id": "31"')
    rows = fi.read_raw_products(spark, str(tmp_path))
    good, bad = fi.split_broken(rows)
    assert good.count() == 30 and [r[fi.CORRUPT] for r in bad.collect()] == ['{"product_id": "31"']
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    generate = next(line for line in plan.splitlines() if "Generate explode" in line)
    before = plan[plan.index(generate):].splitlines()[1]
    assert "Project" in before and "(size(" in before


def test_images_are_named_and_opened_by_the_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fi, "_rename", _no_rename)
    monkeypatch.setattr(fi, "open_images", _no_rename)
    df = spark.range(40).selectExpr("concat('P', id div 4, '_image_', id % 4) AS name", "CAST(id AS string) AS value")
    root = str(tmp_path / "images")
    fi.write_files(df, root, ".jpg")
    seen = tmp_path / "seen"

    def make():
        def detect(content):
            with open(seen, "ab") as f:
                f.write(content)
            return [("size", len(content) / 10)]
        return detect

    told = jobs.predict_images(spark, root, str(tmp_path / "out"), make, max_images=2, batch_files=3)
    assert sorted(r.product_id for r in told.collect()) == sorted(f"P{i // 2}" for i in range(20))
    # No others are opened, and these once.
    assert sorted(map(int, seen.read_text().split())) == [i for i in range(40) if i % 4 < 2]


def test_a_file_that_has_gone_is_left_out(spark, tmp_path):
    (tmp_path / "a b%20.jpg").write_bytes(b"x")
    paths = [f"file:{tmp_path}/a b%20.jpg", f"file:{tmp_path}/gone.jpg"]
    got = fi.open_chosen(spark.createDataFrame([(p,) for p in paths], "path string")).collect()
    assert [(r.path, bytes(r.content)) for r in got] == [(paths[0], b"x")]


def test_images_in_another_store_come_by_spark(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fi, "is_local", lambda *_: False)
    for i in range(9):
        (tmp_path / f"P{i}_image_0.jpg").write_bytes(b"x")
    told = jobs.predict_images(spark, str(tmp_path), str(tmp_path / "out"), lambda: lambda c: [("a", 1.0)],
                               batch_files=2)
    assert sorted(r.product_id for r in told.collect()) == [f"P{i}" for i in range(9)]


def test_rows_of_one_name_are_lines_of_one_file(spark, tmp_path):
    df = spark.createDataFrame([("P1_image_0", "a"), ("P1_image_0", "a"), ("P2_image_0", None), (None, "c")],
                               "name string, value string").repartition(3)
    fi.write_files(df, str(tmp_path / "images"), ".jpg")
    paths = fi.list_images(spark, str(tmp_path / "images"))
    got = fi.open_chosen(paths).collect()
    assert {r.path.rpartition("/")[2]: bytes(r.content) for r in got} == {
        "P1_image_0.jpg": b"a\na\n", "P2_image_0.jpg": b"\n"}
