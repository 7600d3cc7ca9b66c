import datetime as dt
import functools
import hashlib
import math
import operator
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plugwatch import settings
from plugwatch.operators import annotations as an
from plugwatch.operators import attribution as at
from plugwatch.operators import decisions as de
from plugwatch.operators import flags as fl
from plugwatch.operators import images as im
from plugwatch.operators import model as mo
from plugwatch.operators import numbering as nu
from plugwatch.operators import phrases as ph
from plugwatch.operators import reports as rp
from plugwatch.operators import reviews as rv
from plugwatch.operators import upsert as up
from plugwatch.schemas import SPEC_DDL
from plugwatch.session import stored

AUS, UK = settings.SOCKET_TAGS


def tuples(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


# --- Flags ---------------------------------------------------------------------------


def test_text_flags(spark):
    texts = ["adapter", "Adapter", "commercial use", "Splash  Proof", "waterproofed",
             "sealed against water", "weather proofing", None]
    df = fl.with_text_flags(spark.createDataFrame([(t,) for t in texts], "text string"))
    got = {r.text: (r.adapter_flag, r.industrial_flag, r.waterproof_flag) for r in df.collect()}
    assert got == {
        "adapter": (True, False, False), "Adapter": (False, False, False),
        "commercial use": (False, True, False), "Splash  Proof": (False, False, True),
        "waterproofed": (False, False, True), "sealed against water": (False, False, True),
        "weather proofing": (False, False, False), None: (False, False, False)}


def test_irrelevance(spark):
    some = [("input", ["230 V"])]
    rows = [
        ("1", "Group B", "USB Cables", "x", None), ("2", "Group A", "USB Cables", "x", None),
        ("3", "Group A", "c", "in case of fire", None), ("4", "Group A", "c", "a case", some),
        ("5", "Group C", "c", "usb plug", some), ("6", "Group A", "c", "usb plug", some),
        ("7", "Group A", "c", "x", some), ("8", "Group A", None, None, None),
        ("9", "Group Z", "Unknown", "x", None)]
    df = spark.createDataFrame(
        rows, f"product_id string, product_group string, category string, text string,"
              f" voltage_info {SPEC_DDL}").withColumns(
        {c: F.lit(None).cast(SPEC_DDL) for c in ("amperage_info", "wattage_info")})
    pairs = spark.createDataFrame([("7", "Group A"), ("7", "Group A"), ("4", "Group B")],
                                  "product_id string, product_group string")
    got = dict(tuples(fl.with_irrelevance(df, pairs), "product_id", "is_irrelevant"))
    assert got == {"1": True, "2": False, "3": True, "4": False, "5": True, "6": False,
                   "7": True, "8": False}


def test_recalls(spark):
    df = spark.createDataFrame(
        [("1", "has M.1 inside", " acme "), ("2", "has Mx1", None), ("3", None, "ACME"),
         ("4", "an Acme thing", "x"), ("5", "an acme thing", "x")],
        "product_id string, text string, manufacturer string")
    lists = settings.RecallLists(ids=("2",), models=("M.1",), brands=("Acme",))
    got = tuples(fl.with_recalls(df, lists), "product_id", "manufacturer", "recalled_flag",
                 "is_recall_brand")
    assert got == [("1", "acme", True, True), ("2", "", True, False), ("3", "ACME", False, True),
                   ("4", "x", False, True), ("5", "x", False, False)]
    # Empty lists match nothing.
    assert {tuple(r[-2:]) for r in fl.with_recalls(df).collect()} == {(False, False)}


@pytest.mark.parametrize("chars", [3, 2_000_000])
def test_recall_table(spark, chars):
    df = spark.createDataFrame(
        [("1", "has M.1 inside", " acme "), ("2", "has Mx1", None), ("3", None, "ACME"),
         ("4", "an Acme thing", "x"), ("5", "an acme thing", "x"), (None, "", ""),
         ("6", "both M.1 and Acme", ""), ("6", "both M.1 and Acme", "")],
        "product_id string, text string, manufacturer string")
    table = spark.createDataFrame(
        [("id", "2"), ("model", "M.1"), ("brand", "Acme"), ("brand", "Acme"), ("model", ""),
         ("brand", None), ("id", None), ("other", "has"), (None, "has")], "kind string, value string")
    lists = settings.RecallLists(ids=("2",), models=("M.1",), brands=("Acme",))
    columns = ("product_id", "text", "manufacturer", "recalled_flag", "is_recall_brand")
    want = sorted(map(tuple, fl.with_recalls(df, lists).select(*columns).collect()), key=str)
    got = fl.with_recall_table(df, table, chars)
    assert sorted(map(tuple, got.select(*columns).collect()), key=str) == want
    assert got.columns == [*df.columns, "recalled_flag", "is_recall_brand"]
    none = fl.with_recalls(df, table.limit(0)).collect()
    assert len(none) == 8 and {tuple(r[-2:]) for r in none} == {(False, False)}
    assert fl.with_recalls(df.limit(0), table).count() == 0


def test_many_recalls_leave_the_plan_small(spark):
    df = spark.range(300).selectExpr(
        "CAST(id AS string) AS product_id", "'' AS manufacturer",
        "concat('a kettle of type K', id * 977, 'x, red') AS text")

    def flagged(n):
        many = spark.range(n).selectExpr("'model' AS kind", "concat('K', id, 'x') AS value").unionAll(
            spark.range(n).selectExpr("'brand' AS kind", "concat('K', id * 2, 'x,') AS value"))
        return fl.with_recalls(df, many)

    got = {int(r.product_id): (r.recalled_flag, r.is_recall_brand) for r in flagged(100_000).collect()}
    assert got == {i: (i * 977 < 100_000, i * 977 < 200_000 and i % 2 == 0) for i in range(300)}
    plan = lambda n: len(flagged(n)._jdf.queryExecution().executedPlan().toString())
    assert plan(10_000) < 1.2 * plan(10)


def test_ip_rating(spark):
    df = spark.createDataFrame([("is ip67 now IP20",), ("IPX2",), ("IP6X",), ("xIP67",), (None,)],
                               "text string")
    got = [tuple(r[1:]) for r in fl.with_ip_rating(df).collect()]
    assert got == [("ip67", 6, 7, False), ("IPX2", None, 2, True)] + [(None,) * 4] * 3


def test_rules_from_file(tmp_path):
    path = tmp_path / "rules.json"
    path.write_text('{"G": {"query_list": ["a", " "], "exact_voltage": true}, "H": {}}')
    rules = settings.load_group_rules(str(path))
    assert rules[0].exact_voltage and not rules[0].exact_amperage
    assert settings.blank_queries(rules) == {"G": [" "], "H": []}
    with pytest.raises(ValueError):
        settings.check_queries(rules)
    settings.check_queries(settings.GROUP_RULES)


# --- Reviews -------------------------------------------------------------------------


def test_negativity(spark):
    lexicon = {"bad": -2.0, "good": 1.0, "fire": -1.0}
    texts = ["Bad, bad (good) day", "nothing here", "", " ", None, "FIRE!", "... !"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(rv.negativity(F.col("t"), lexicon)).collect()]
    assert got == [round(6 / (6 + 2 + 1), 3), 0.0, 0.0, 0.0, 0.0, 1.0, 0.0]


def test_similarities(spark):
    rng = np.random.default_rng(1)
    vectors, words = rng.normal(size=(40, 8)), rng.normal(size=(3, 8))
    df = spark.createDataFrame(
        [(i, v.tolist(), "a b c" if i else "") for i, v in enumerate(vectors)]
        + [(40, None, "a"), (41, [0.0] * 8, "a")], "id int, v array<double>, t string")
    weights = [1.0, 2.0, 0.5]
    rows = {r.id: r for r in df.select(
        "id", rv.max_similarity(F.col("v"), words).alias("top"),
        rv.danger(F.col("v"), F.col("t"), words).alias("danger"),
        rv.text_similarity(F.col("v"), F.col("t"), words, weights).alias("mean")).collect()}
    cosines = (vectors @ words.T) / np.outer(
        np.linalg.norm(vectors, axis=1), np.linalg.norm(words, axis=1))
    for i in range(40):
        assert rows[i].top == pytest.approx(cosines[i].max())
        assert rows[i].danger == pytest.approx(cosines[i].max() / (3 if i else 1))
        mean = np.average(cosines[i], weights=weights) / math.log(4)
        assert rows[i].mean == pytest.approx(min(1, max(0, mean)) if i else 0.0)
    assert rows[40].top == rows[41].top == 0.0


def test_encoder_hook(spark):
    def make():
        def encode(texts):
            return np.stack([[float(len(t)), 1.0] for t in texts])
        return encode

    df = spark.createDataFrame([("abc",), (None,)], "t string")
    got = [list(r[0]) for r in df.select(rv.embed(F.col("t"), make)).collect()]
    assert got == [[3.0, 1.0], [0.0, 1.0]]


def test_vectors_of_distinct_texts(spark, tmp_path):
    seen = str(tmp_path / "seen")

    def make():
        def encode(texts):
            with open(seen, "a") as f:
                f.writelines(f"{t}\n" for t in texts)
            return np.stack([[float(len(t)), 1.0] for t in texts])
        return encode

    texts = ["hot"] * 400 + ["rare", "rarer", None, ""] * 2
    df = spark.createDataFrame(list(enumerate(texts)), "id int, content string").repartition(6)
    df = df.withColumn("vector", F.lit("replaced"))
    told = rv.with_vectors(df, make)
    assert told.columns == ["id", "content", "vector"]
    assert dict(told.select("id", "content").collect()) == dict(enumerate(texts))
    assert told.count() == len(texts)
    assert {(r.content, tuple(r.vector)) for r in told.collect()} == {
        (t, (float(len(t or "")), 1.0)) for t in texts}
    # Collected twice, and the model has still seen each text once.
    with open(seen) as f:
        assert sorted(f.read().split("\n")[:-1]) == ["", "hot", "rare", "rarer"]
    assert rv.with_vectors(df.limit(0), make).count() == 0


def test_few_and_many_keyword_blocks_are_paired_alike(spark, monkeypatch):
    """Few blocks are joined by number, without a nested loop; more are crossed."""
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(20)], "id int, v array<double>")
    words = spark.createDataFrame([(rng.normal(size=4).tolist(),) for _ in range(15)], "k array<double>")
    few = rv.with_similarities(df, words, "v", "k", block=2)
    assert "NestedLoop" not in few._jdf.queryExecution().executedPlan().toString()
    few = few.orderBy("id").collect()
    for name in ("FEW_BLOCKS", "FEW_BYTES"):
        with monkeypatch.context() as m:
            m.setattr(rv, name, 0)
            many = rv.with_similarities(df, words, "v", "k", block=2).orderBy("id").collect()
        assert [r.max_similarity for r in many] == pytest.approx([r.max_similarity for r in few])


@pytest.mark.parametrize("block", [1, 7, 5000])
def test_similarities_in_blocks(spark, block):
    rng = np.random.default_rng(3)
    vectors, words = rng.normal(size=(30, 8)), rng.normal(size=(20, 8))
    # All cosines of the first vector are negative; one keyword repeats, one is zero, one null.
    vectors[0], words = -1.0, np.abs(words)
    weights = np.append(rng.uniform(1, 2, 20), [3.0, 0.5])
    words = np.vstack([words, words[:1], np.zeros(8)])
    df = spark.createDataFrame(
        [(i, x.tolist()) for i, x in enumerate(vectors)] + [(30, None), (31, [0.0] * 8)],
        "id int, v array<float>").withColumn("max_similarity", F.lit("replaced"))
    table = spark.createDataFrame(
        [(x.tolist(), float(w)) for x, w in zip(words, weights)] + [(None, 9.0)],
        "k array<double>, w double")
    got = {r.id: r for r in rv.with_similarities(df, table, "v", "k", "w", block).collect()}
    norms = np.outer(np.linalg.norm(vectors, axis=1), np.linalg.norm(words, axis=1))
    cosines = np.divide(vectors @ words.T, norms, out=np.zeros_like(norms), where=norms > 0)
    for i in range(30):
        assert got[i].max_similarity == pytest.approx(cosines[i].max(), abs=1e-6)
        assert got[i].mean_similarity == pytest.approx(
            np.average(cosines[i], weights=weights), abs=1e-6)
    assert [got[i][c] for i in (30, 31) for c in ("max_similarity", "mean_similarity")] == [0.0] * 4


def test_similarities_with_many_or_no_keywords(spark):
    rng = np.random.default_rng(4)
    vectors, words = rng.normal(size=(50, 16)), rng.normal(size=(5000, 16))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(vectors)], "id int, v array<double>")
    table = spark.createDataFrame([(x.tolist(),) for x in words], "k array<double>")
    got = rv.with_similarities(df, table, "v", "k").orderBy("id").collect()
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    cosines = unit(vectors) @ unit(words).T
    assert [r.max_similarity for r in got] == pytest.approx(cosines.max(axis=1).tolist())
    assert [r.mean_similarity for r in got] == pytest.approx(cosines.mean(axis=1).tolist())
    none = rv.with_similarities(df, table.limit(0), "v", "k").collect()
    assert len(none) == 50 and {(r.max_similarity, r.mean_similarity) for r in none} == {(None, None)}
    assert rv.with_similarities(df.limit(0), table, "v", "k").count() == 0


def test_feedback_scores_without_the_column(spark):
    df = rv.with_feedback_scores(spark.createDataFrame([(1,)], "id int"))
    assert tuple(df.first()) == (1, "", 0.0, 0.0)


def test_danger_must_be_given(spark):
    df = spark.createDataFrame([("text",)], "content string")
    with pytest.raises(ValueError):
        rv.with_feedback_scores(df)
    assert rv.with_feedback_scores(df, danger_of=lambda t: F.lit(0.25)).first().danger_score == 0.25


def test_review_sums(spark):
    df = spark.createDataFrame(
        [("a", None, "t", 1.0, 0.5), ("a", None, "t", 2.0, 0.5), (None, "m", None, None, None)],
        "product_id string, marketplace string, review_text string, negativity_score double,"
        " danger_score double")
    assert tuples(rv.review_scores(df)) == [("a", None, 3.0, 1.0, 2), (None, "m", 0.0, 0.0, 0)]
    assert tuples(rv.review_scores(df, ["product_id"], False)) == [("a", 3.0, 1.0, 2)]


# --- Images ----------------------------------------------------------------------------


def test_image_flags(spark):
    text = [("p", f"[{{'{AUS}': 0.9}}, {{'Plug': 0.99}}]"), ("p", '[{"x": 1.0}]'),
            ("q", f"[{{'{UK.upper()}': 0.95}}, {{'{UK}': 0.91}}]"), ("q", "[]"),
            ("r", f"[{{'{AUS}': 0.9}}]"), ("r", f"[{{'{AUS}': 0.9}}]")]
    df = spark.createDataFrame(text, "product_id string, predictions string")
    df = df.withColumn("predictions", im.parse_predictions(F.col("predictions")))
    flags = im.product_image_flags(im.image_maxima(df, 0.9))
    # A single image exactly at the limit does not flag, two do.
    assert tuples(flags) == [("p", 2, 0, 0), ("q", 2, 0, 1), ("r", 2, 1, 0)]


def test_image_choice(spark):
    paths = [(f"/a/P1_image_{i}.jpg",) for i in range(9)] + [("/b/P2_image_0.jpg",)]
    df = spark.createDataFrame(paths, "path string").withColumn(
        "product_id", im.image_id(F.col("path")))
    capped = im.cap_images(df, 2)
    assert tuples(capped, "path") == [("/a/P1_image_0.jpg",), ("/a/P1_image_1.jpg",),
                                      ("/b/P2_image_0.jpg",)]
    urls = spark.createDataFrame([("p", ["a", "b", "c"]), ("q", []), ("r", None)],
                                 "product_id string, images array<string>")
    assert tuples(im.image_urls(urls, 2)) == [("p", 0, "a"), ("p", 1, "b")]


def test_detector_hook(spark):
    def make():
        def detect(content):
            if content == b"bad":
                raise ValueError("broken")
            return [("low", 0.1), ("high", len(content) / 10)]
        return detect

    df = spark.createDataFrame([("/x/P%201_image_0.jpg", bytearray(b"12345")),
                                ("/x/P2_image_0.jpg", bytearray(b"bad"))],
                               "path string, content binary")
    # The path of a binary file is not encoded: what looks so is the name.
    assert tuples(im.detect(df, make)) == [("P%201", [{"high": 0.5}, {"low": 0.1}])]


# --- Annotations --------------------------------------------------------------------------


def annotation_tables(spark):
    images = spark.createDataFrame(
        [(0, 1, 100, 50, None, None, "old.jpg"), (1, 1, 200, 100, "", "c.jpg", "f.jpg"),
         (2, 2, 0, 0, "a.jpg", None, None), (3, 3, 10, 10, "", None, "")],
        "pos long, id long, width int, height int, absolute_url string, coco_url string,"
        " file_name string")
    images = an.latest_images(images).select("id", "width", "height", an.image_url().alias("url"))
    annotations = spark.createDataFrame(
        [(0, 1, 7, [20.0, 10.0, 300.0, 1.0]), (1, 1, 8, [0.5, 0.2, 0.1, -1.0]),
         (2, 2, 9, [5.0, 5.0, 5.0, 5.0]), (3, 9, 7, [1.0, 1.0, 1.0, 1.0]),
         (4, 1, 7, [1.0, 2.0]), (5, 1, 7, None)],
        "pos long, image_id long, category_id long, bbox array<double>")
    categories = spark.createDataFrame([(7, "plug"), (8, None)], "id long, name string")
    return images, annotations, categories


def test_regions_and_entries(spark):
    images, annotations, categories = annotation_tables(spark)
    flat = an.regions(annotations, images, categories)
    assert tuples(flat, "image_id", "tag_name", "left", "top", "width", "height") == [
        (1, "cat_8", 0.5, 0.2, 0.1, 0.0), (1, "plug", 0.1, 0.1, 1.0, 0.01),
        (2, "cat_9", 0.0, 0.0, 0.0, 0.0)]
    got = tuples(an.entries(images, flat).select(
        "url", F.transform("regions", lambda r: r["tagName"]).alias("tags")))
    assert got == [("a.jpg", ["cat_9"]), ("c.jpg", ["plug", "cat_8"])]
    counts = an.conversion_counts(images, annotations, categories).first()
    assert tuple(counts) == (3, 6, 2, 2, 1)
    assert tuples(an.tag_table(categories)) == [(7, "plug"), (8, "cat_8")]


def test_an_image_has_one_entry_in_order(spark):
    images = spark.createDataFrame([(1, "u"), (2, "v"), (3, None)], "id long, url string")
    places = [5001, 998, 1001, 999, 1000]
    flat = spark.createDataFrame([(1, "u", p, f"t{p}") for p in places],
                                 "image_id long, url string, pos long, tag_name string").selectExpr(
        "*", "0D AS left", "0D AS top", "0D AS width", "0D AS height")
    got = {r.url: [x.tagName for x in r.regions] for r in an.entries(images, flat).collect()}
    assert got == {"u": [f"t{p}" for p in sorted(places)], "v": []}
    tagged = an.with_tag_ids(flat, spark.createDataFrame([("t998", "7")], "name string, id string"))
    ids = {r.url: [x.tagId for x in r.regions] for r in an.entries(images, tagged, "tag_id").collect()}
    assert ids == {"u": ["7"], "v": []}
    none = an.with_tag_ids(flat, spark.createDataFrame([("x", "7")], "name string, id string"))
    assert {len(r.regions) for r in an.entries(images, none, "tag_id").collect()} == {0}


def test_documents_keep_their_own_ids(spark):
    images = spark.createDataFrame([("a", 1, 10, 10, "ua"), ("b", 1, 20, 20, "ub")],
                                   "document string, id long, width int, height int, url string")
    boxes = spark.createDataFrame([("a", 0, 1, 5, [5.0] * 4), ("b", 0, 1, 5, [5.0] * 4)],
                                  "document string, pos long, image_id long, category_id long, bbox array<double>")
    names = spark.createDataFrame([("a", 5, "na"), ("b", 5, "nb")], "document string, id long, name string")
    flat = an.regions(boxes, images, names)
    assert tuples(flat, "document", "url", "tag_name", "left") == [
        ("a", "ua", "na", 0.5), ("b", "ub", "nb", 0.25)]
    assert an.latest_images(images.withColumn("pos", F.lit(0))).count() == 2
    assert tuples(an.entries(images, flat).select("document", "url", F.size("regions"))) == [
        ("a", "ua", 1), ("b", "ub", 1)]


def test_tag_ids(spark):
    flat = spark.createDataFrame(
        [(1, "", "plug"), (2, "given", "what"), (3, None, "what"), (4, None, None)],
        "pos long, tag_id string, tag_name string")
    tags = spark.createDataFrame([("plug", "t1")], "name string, id string")
    assert tuples(an.with_tag_ids(flat, tags), "pos", "tag_id") == [(1, "t1"), (2, "given")]
    assert tuples(an.unknown_tags(flat, tags)) == [("what",)]
    wanted = spark.createDataFrame([(" a ",), ("a",), ("plug",), (" ",), (None,)], "name string")
    assert tuples(an.new_tags(wanted, tags)) == [("a",)]


def test_tag_remap_falls_back_to_image_tags(spark):
    box = "0D AS left, 0D AS top, 0D AS width, 0D AS height"
    flat = spark.sql(f"SELECT * FROM VALUES (1, 0, 'a'), (1, 1, 'x'), (2, 0, 'x')"
                     f" AS t(image_id, pos, tag_id)").selectExpr("*", *box.split(", "))
    image_tags = spark.createDataFrame([(1, "b"), (2, "b"), (2, "x"), (3, "a")],
                                       "image_id int, tag_id string")
    mapping = spark.createDataFrame([("a", "A"), ("b", "B")], "old_id string, new_id string")
    images = spark.createDataFrame([(1, "u"), (2, "v"), (3, "w"), (4, "x"), (5, None)],
                                   "id int, url string")
    got = tuples(an.remap_tags(images, flat, image_tags, mapping), "image_id", "url", "pos", "tag_id")
    assert got == [(1, "u", 0, "A"), (2, "v", None, "B"), (3, "w", None, "A"), (4, "x", None, None)]


# --- Decisions ------------------------------------------------------------------------------


def test_adjustments(spark):
    df = spark.createDataFrame(
        [("Group A", True, 1.0, 1.0, 1.0, True, True, 2.0, 3.0, 2),
         ("Group B", True, 1.0, 1.0, 1.0, True, None, None, None, None),
         ("Group E", True, 1.0, 1.0, 1.0, False, True, 1.0, 1.0, 1),
         (None, None, None, 1.0, None, None, None, None, None, None)],
        "product_group string, industrial_flag boolean, voltage_score double, amperage_score"
        " double, wattage_score double, waterproof_flag boolean, ip_incompliance boolean,"
        " negativity_score double, danger_score double, review_count long")
    got = [(r.voltage_score, r.amperage_score, r.wattage_score, r.adjusted_ip_incompliance,
            r.adjusted_negativity_score, r.adjusted_danger_score)
           for r in de.adjust(df).collect()]
    assert got == [(0.0, 0.0, 0.0, True, 2.0, 4.5), (1.0, 1.0, 0.0, None, None, None),
                   (0.0, 1.0, 0.0, False, 1.0, 1.0), (0.0, 1.0, 0.0, False, None, None)]


def test_logistic_and_decision(spark):
    df = spark.createDataFrame(
        [(1, 2.0, None, 0, None, False), (2, None, None, None, None, False),
         (3, None, True, None, None, False), (4, None, None, 1, 0, False),
         (5, None, None, None, None, True), (6, -2.0, False, 0, 0, None)],
        f"id int, x double, adjusted_ip_incompliance boolean, `{AUS}` int, `{UK}` int,"
        " recalled_flag boolean")
    scored = de.logistic(df, {"x": 1.0}, 0.5, "text_nc_prob")
    first = scored.first().text_nc_prob
    assert first == pytest.approx(1 / (1 + math.exp(-2.5)))
    got = dict(tuples(de.decide(scored), "id", "final_non_compliant"))
    assert got == {1: True, 2: False, 3: True, 4: True, 5: True, 6: False}
    filled = de.logistic(df, {"x": 1.0}, 0.5, fill_missing=0.0).where("id = 2").first()
    assert filled.predicted_prob == pytest.approx(1 / (1 + math.exp(-0.5)))
    with pytest.raises(KeyError):
        de.logistic(df, {"y": 1.0}, 0.0)


def test_merge_matches_null_marketplaces_and_keeps_every_product(spark):
    products = spark.createDataFrame([("a", None), ("a", None), ("a", "m"), ("b", "m")],
                                     "product_id string, marketplace string")
    flags = spark.createDataFrame([("a", 3)], "product_id string, image_count long")
    scores = spark.createDataFrame([("a", None, 1.0), ("c", "m", 2.0)],
                                   "product_id string, marketplace string, danger_score double")
    got = tuples(de.merge_evidence(products, flags, scores))
    assert got == [("a", "m", 3, None), ("a", None, 3, 1.0), ("a", None, 3, 1.0),
                   ("b", "m", None, None)]


def test_training_rows(spark):
    spot = spark.createDataFrame(
        [("a", "g", 1, 0, 0, 0), ("b", "g", 0, 1, 0, 0), ("c", "g", 0, 0, 1, 0),
         ("d", "g", 0, 1, 0, 0)],
        "product_id string, product_group string, my_compliant_flag int, my_non_compliant_flag"
        " int, my_ambiguous_flag int, my_irrelevant_product_flag int")
    products = spark.createDataFrame(
        [("a", "g", 1.0, 0.5, None, True, False, None, False, False),
         ("d", "g", 1.0, 0.5, None, True, False, None, False, True)],
        "product_id string, product_group string, voltage_score double, amperage_score double,"
        " wattage_score double, is_recall_brand boolean, waterproof_flag boolean,"
        " ip_incompliance boolean, industrial_flag boolean, is_irrelevant boolean")
    scores = spark.createDataFrame([("a", 1.0, 2.0, 4)], "product_id string, negativity_score"
                                   " double, danger_score double, review_count long")
    matched = de.match_spot_checks(products, spot, scores)
    rows, source = de.training_rows(matched, label_prefix="my_")
    assert tuples(rows) == [("a", 1.0, 0.5, 0.0, 1.0, 1.0, 1.0, 0.0),
                            ("b", 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0)]
    assert source.count() == 3


# --- Model ------------------------------------------------------------------------------


def separable(spark, third=False):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 2)) * [1.0, 1e-4]
    label = np.where(x[:, 0] + rng.normal(size=300) * 0.7 > 0.3, "yes", "no")
    if third:
        label = np.where(x[:, 0] < -0.8, "maybe", label)
    names = sorted(set(label))
    rows = [(float(a), float(b), *[float(lab == n) for n in names])
            for (a, b), lab in zip(x, label)]
    ddl = ", ".join(["a double", "b double", *[f"{n} double" for n in names]])
    return x, label, names, spark.createDataFrame(rows, ddl)


@pytest.mark.parametrize("third", [False, True])
@pytest.mark.parametrize("intercept", [False, True])
def test_training_reaches_the_optimum(spark, third, intercept):
    x, label, names, df = separable(spark, third)
    model = mo.train(df, ["a", "b"], names, intercept=intercept)
    w, b = model.weights[:, :-1], model.weights[:, -1]
    z = x @ w.T + b
    if third:
        p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    else:
        p = 1 / (1 + np.exp(-z))
    y = np.stack([(label == n) for n in model.outputs], axis=1).astype(float)
    # Zero gradient of the sum of the losses plus half the squared weights.
    assert np.abs((p - y).T @ x + w).max() < 1e-6
    assert (np.abs((p - y).sum(axis=0)).max() < 1e-6) if intercept else (b == 0).all()
    metrics, wrong = mo.evaluate(model, df, names)
    want = np.array(model.classes)[p.argmax(1) if third else (p[:, 0] > 0.5).astype(int)]
    assert metrics.first().accuracy == pytest.approx((want == label).mean())
    assert wrong.count() == (want != label).sum()
    assert [r["class"] for r in model.coefficient_table(spark).collect()] == model.outputs


def test_training_needs_two_classes(spark):
    df = spark.createDataFrame([(1.0, 1.0, 0.0)], "a double, yes double, no double")
    with pytest.raises(ValueError):
        mo.train(df, ["a"], ["yes", "no"])


def test_class_report(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "a"), ("b", "d")],
                               "true_class string, predicted_class string")
    got = {r["class"]: tuple(r)[1:] for r in mo.class_report(df).collect()}
    assert got["a"] == (0.5, 0.5, 0.5, 2)
    assert got["c"] == (0.0, 0.0, 0.0, 1)
    assert got["d"] == (0.0, 0.0, 0.0, 0)
    row = mo.metrics(df).first()
    assert row.accuracy == pytest.approx(0.4)
    assert row.macro_recall == pytest.approx((0.5 + 0.5 + 0 + 0) / 4)
    matrix = {r[0]: tuple(r)[1:] for r in mo.confusion_matrix(df, ["a", "b"]).collect()}
    assert matrix == {"a": (1, 1), "b": (0, 1), "c": (1, 0)}


# --- Reports ------------------------------------------------------------------------------


def decided(spark):
    rows = [("1", "m", "g", "q", True, False, True, False, False, 0.9, False),
            ("1", "m", "g", "q", True, False, False, True, False, 0.1, False),
            ("2", "n", "h", "r", False, False, False, False, False, None, False),
            ("3", "n", "h", "r", True, True, True, True, True, 0.9, True),
            ("4", None, None, None, True, False, False, False, False, 0.9, False)]
    return spark.createDataFrame(
        rows, "product_id string, marketplace string, product_group string, query string,"
              " final_non_compliant boolean, adjusted_ip_incompliance boolean, recalled_flag"
              f" boolean, `{AUS}` boolean, `{UK}` boolean, text_nc_prob double, is_irrelevant"
              " boolean")


def test_group_summary(spark):
    rows = {r.product_group: r for r in rp.group_summary(decided(spark)).collect()}
    assert set(rows) == {"g", "h", "TOTAL"}
    assert tuple(rows["g"])[1:] == (2, 2, 100.0, 0, 0.0, 1, 50.0, 1, 50.0, 1, 50.0)
    assert rows["TOTAL"].total_count == 3
    assert rows["TOTAL"]["non_compliant_%"] == pytest.approx(200 / 3)
    assert rp.group_summary(decided(spark).where("false")).count() == 0


def test_ratio_reports(spark):
    # Rows over distinct products: the ratio exceeds 100.
    assert [tuple(r) for r in rp.query_summary(decided(spark)).collect()] == [
        ("q", 1, 2, 200.0), ("r", 1, 0, 0.0)]
    assert rp.query_summary(decided(spark), top=1).count() == 1
    assert [r[0] for r in rp.marketplace_summary(decided(spark)).collect()] == ["m", "n"]


# --- Upserts -------------------------------------------------------------------------------


def test_product_upsert(spark):
    ddl = ("ProductID string, Marketplace string, ProductGroup string, UploadDate timestamp,"
           " Title string, Description string, Rating double, Price double, Currency string,"
           " NumImages int, SellerID int")
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    old = [("a", "m", "g", t1, "old a", None, 1.0, 1.0, "GBP", 1, 1),
           ("b", "m", "g", t1, "old b", None, 1.0, 1.0, "GBP", 1, 1)]
    new = [(" a ", "m", "g", t1, "late", None, 1.0, 1.0, "gbp", 1, 1),
           ("a", "m", "g", t2, " x" * 400, None, 4.555, 2.0, "eurx", None, 1),
           (None, "m", "g", t2, "t", None, 1.0, 1.0, "GBP", 1, 1),
           (" ", "m", "g", t2, "t", None, 1.0, 1.0, "GBP", 1, 1),
           ("c" * 30, "m", "g", t2, "t", None, None, None, None, 1, 1),
           ("c" * 31, "m", "g", t2, "t", None, None, None, None, 1, 1),
           ("n", "m", "g", t2, None, None, None, None, None, 1, 1)]
    target = up.conform_products(spark.createDataFrame(old, ddl))
    source = spark.createDataFrame(new, ddl)
    table, rejects = up.upsert_products(target, source, cut=("Title", "Currency"))
    rows = {r.ProductID: r for r in table.collect()}
    # Two ids that share 18 characters are not made one: both are told as too long.
    assert set(rows) == {"a", "b"}
    assert tuples(rejects, "ProductID", "reason") == [("c" * 30, "length"), ("c" * 31, "length"),
                                                      ("n", "null")]
    assert (len(rows["a"].Title), rows["a"].Currency, float(rows["a"].Price)) == (499, "EUR", 2.0)
    assert rows["b"].Title == "old b"
    table, rejects = up.upsert_products(target, source)
    assert {r.ProductID: r.Title for r in table.collect()} == {"a": "late", "b": "old b"}
    assert rejects.where("ProductID = 'a' AND reason = 'length'").count() == 1
    with pytest.raises(ValueError):
        up.upsert_products(target, source, cut=("ProductID",))


def test_seller_upsert(spark):
    target = spark.createDataFrame([(5, "a", "m", "old"), (9, "z", "m", None)],
                                   "SellerID int, Name string, Marketplace string, URL string")
    new = spark.createDataFrame(
        [(" a ", "m", "u2"), ("a", "m", "u1"), ("a", "m", None), ("b", "m", None),
         ("c", "n", "x"), (None, "m", "x"), (" ", "m", "x"), ("d", " ", "x")],
        "Name string, Marketplace string, URL string")
    table, ids = up.upsert_sellers(target, new)
    rows = {(r.Name, r.Marketplace): (r.SellerID, r.URL) for r in table.collect()}
    assert rows[("a", "m")] == (5, "u1") and rows[("z", "m")] == (9, None)
    assert {rows[("b", "m")][0], rows[("c", "n")][0]} == {10, 11}
    assert {tuple(r) for r in ids.collect()} == {
        (rows[k][0], *k) for k in (("a", "m"), ("b", "m"), ("c", "n"))}
    long = spark.createDataFrame([("x" * 255 + "1", "m", "u"), ("x" * 255 + "2", "m", "u")],
                                 "Name string, Marketplace string, URL string")
    assert up.first_sellers(long).count() == 0
    assert [r.reason for r in up.conform_sellers(long).collect()] == ["length"] * 2
    with pytest.raises(KeyError):
        up.upsert_sellers(target, new.drop("URL"))


def test_checked_append(spark):
    target = spark.createDataFrame([("k0",)], "key string")
    parents = spark.createDataFrame([("p",)], "id string")
    rows = spark.createDataFrame(
        [(1, "k0", "p", "v"), (2, "k1", "no", "v"), (3, "k1", "p", None), (4, "k1", "p", "v"),
         (5, "k1", "p", "v"), (6, None, "p", "v"), (7, "k2", None, "v")],
        "no int, key string, parent string, value string")
    out = up.checked_append(target, rows, up.Constraints(
        ("key",), ("value",), {"parent": (parents, "id")}), ["no"])
    assert dict(tuples(out, "no", "reason")) == {
        1: "key", 2: "reference", 3: "null", 4: None, 5: "key", 6: "null", 7: None}
    twice = up.checked_append(target, rows.union(rows), up.Constraints(("key",)), ["no"])
    reasons = sorted((r.no, r.reason or "") for r in twice.collect())
    assert len(reasons) == 14 and [x for x in reasons if not x[1]] == [(2, ""), (7, "")]


def test_rows_that_tie_in_order_are_appended_once(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (2, "c"), (2, None)], "key int, value string")
    out = up.checked_append(rows.limit(0), rows, up.Constraints(("key",)), ["key"])
    assert sorted(tuples(out), key=str) == sorted([
        (1, "a", None), (1, "b", "key"), (2, None, None), (2, None, "key"), (2, "c", "key")], key=str)


def test_a_merge_does_not_sort_or_group_the_target(spark):
    target = spark.range(1000).selectExpr("id AS k", "id AS x")
    source = spark.createDataFrame([(1, 5), (1, 7), (2000, 1), (None, 1)], "k long, x long")
    out = up.upsert(target, source, ["k"], ["x"])
    assert {tuple(r) for r in out.where("k IS NULL OR k IN (1, 2, 2000)").collect()} == {
        (1, 7), (2, 2), (2000, 1), (None, 1)}
    assert out.count() == 1002
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Sort " not in plan
    again = up.upsert(out, source, ["k"], ["x"])
    assert again.count() == 1002


def test_constraints_of_the_tables(spark):
    products = spark.createDataFrame([("p",)], "ProductID string")
    found = up.table_constraints("Reviews", {"Products": products})
    assert found.primary_key == ("ReviewID",)
    assert found.not_null == ("ReviewID", "ReviewText", "Rating", "ReviewTs")
    assert set(found.references) == {"ProductID"} and found.references["ProductID"][1] == "ProductID"
    row = (1, "p", "t", 3, dt.datetime(2024, 1, 1))
    rows = spark.createDataFrame([row, row, (2, "q", *row[2:]), (3, None, *row[2:]), (4, "p", None, *row[3:])],
                                 "ReviewID int, ProductID string, ReviewText string, Rating int, ReviewTs timestamp")
    out = up.checked_append(rows.limit(0), rows, found, ["ReviewID"])
    assert sorted((r.ReviewID, r.reason or "") for r in out.collect()) == [
        (1, ""), (1, "key"), (2, "reference"), (3, ""), (4, "null")]


# --- Attribution and numbering ---------------------------------------------------------


def test_attribution(spark):
    results = spark.createDataFrame(
        [(1, "q1", 0, "a"), (1, "q1", 1, "b"), (2, "q2", 0, "a"), (3, "q1", 0, "c"),
         (3, "q1", 1, "a")], "run int, query string, position int, product_id string")
    current = at.current_results(results)
    # The second run replaces q1's ids, but q1 keeps its place before q2.
    assert tuples(current) == [("q1", 1, 0, "c"), ("q1", 1, 1, "a"), ("q2", 2, 0, "a")]
    products = spark.createDataFrame([("a", "own"), ("b", "own"), ("c", None), (None, "own")],
                                     "product_id string, query string")
    assert tuples(at.attribute_queries(products, current)) == [
        ("a", "q2"), ("b", "own"), ("c", "q1"), (None, "own")]
    assert tuples(at.first_ids(results, 1), "query", "product_id") == [("q1", "a"), ("q2", "a")]


def test_numbering_is_dense_and_batches_are_full(spark):
    numbered = nu.number_rows(spark.range(10_007), ["id"]).select("row_no").collect()
    assert sorted(r[0] for r in numbered) == list(range(1, 10_008))
    sizes = nu.with_batches(spark.range(1000), ["id"]).groupBy("batch").count().orderBy(
        "batch").collect()
    assert [tuple(r) for r in sizes] == [(i, 64) for i in range(15)] + [(15, 40)]


@pytest.mark.parametrize("bucket_rows, block", [(10, 3), (100, 1), (10**6, 4096)])
def test_numbers_do_not_depend_on_the_buckets(spark, bucket_rows, block):
    want = {r.id: r.row_no for r in nu.number_rows(spark.range(3000), ["id"]).collect()}
    numbered = nu.number_rows(spark.range(3000), ["id"], bucket_rows=bucket_rows, block=block)
    assert {r.id: r.row_no for r in numbered.collect()} == want
    assert sorted(want, key=want.get) == sorted(want, key=lambda i: hashlib.md5(str(i).encode()).hexdigest())


def test_path_columns(spark):
    df = spark.createDataFrame([("/r/date=1/productgroup=group  b/marketplace=x/f",), ("/none",)],
                               "p string")
    got = [tuple(r) for r in df.select(at.group_from_path(F.col("p")),
                                       at.marketplace_from_path(F.col("p"))).collect()]
    assert got == [("group  b", "x"), (None, None)]


def test_training_with_many_features(spark, monkeypatch):
    """200 features in three classes, next to each other in blocks; the slopes say it is the optimum."""
    names = [f"f{i}" for i in range(200)]
    df = spark.range(400).select(
        *[((F.xxhash64("id", F.lit(i)) % 1000) / 1000).alias(f) for i, f in enumerate(names)],
        *[(F.col("id") % 3 == i).cast("int").alias(c) for i, c in enumerate(("x", "y", "z"))])
    df = stored(df.repartition(5))
    monkeypatch.setattr(mo, "FEW_TASKS", 1)
    model = mo.train(df, names, ["x", "y", "z"], intercept=True)
    slopes = mo.residuals(model, df, ["x", "y", "z"], intercept=True).collect()
    assert len(slopes) == 3 * 201 and max(abs(r.residual) for r in slopes) < 1e-5
    assert {r.feature for r in slopes} == {*names, "intercept"}


def test_rows_without_a_feature_are_left_out(spark):
    df = spark.createDataFrame([(0.1, 1, 0), (0.9, 0, 1), (0.5, 1, 0), (0.7, 0, 1)], "a double, no int, yes int")
    odd = spark.createDataFrame([(None, 1, 0), (float("nan"), 0, 1)], "a double, no int, yes int")
    both = [mo.train(x, ["a"], ["no", "yes"]).weights for x in (df, df.union(odd))]
    assert np.allclose(*both)


def test_training_that_has_not_converged_is_an_error(spark):
    df = spark.createDataFrame([(0.1, 1, 0), (0.9, 0, 1), (0.5, 1, 0)], "a double, no int, yes int")
    assert mo.train(df, ["a"], ["no", "yes"]).classes == ["no", "yes"]
    with pytest.raises(ValueError, match="converged"):
        mo.train(df, ["a"], ["no", "yes"], max_steps=1)


def _phrase_case(n):
    """Texts with phrases of 1 to 40 bytes, some cut by one letter, some of both kinds."""
    rng = random.Random(n)
    some = lambda k: "".join(rng.choice("abcdé ") for _ in range(k))
    phrases = sorted({some(rng.choice([1, 4, 5, 9, 16, 17, 31, 40])) for _ in range(n)} - {""})
    table = {p: rng.choice([1, 2, 3]) for p in phrases if len(p) > 1 or p == "é"}
    texts = ["", "é", "x" * 50] + [some(rng.randint(0, 60)) + rng.choice(phrases)[:rng.choice([-1, 99])]
                                   + some(rng.randint(0, 9)) for _ in range(80)]
    want = {t: k for t in texts if (k := functools.reduce(
        operator.or_, (kinds for p, kinds in table.items() if p in t), 0))}
    return texts, table, want


@pytest.mark.parametrize("n,slab,bits", [(40, 1 << 20, 256), (300, 70, 256), (200, 1 << 20, 0)])
def test_phrases_in_texts(spark, monkeypatch, n, slab, bits):
    """Also where long texts are cut, and where the filter is so full that most places are wrong."""
    texts, table, want = _phrase_case(n)
    monkeypatch.setattr(ph, "SLAB", slab)
    if not bits:
        monkeypatch.setattr(ph, "MOST_BITS", 3)
        monkeypatch.setattr(ph, "_filter", lambda *_: b"\xff")
    df = spark.createDataFrame([(t,) for t in [*texts, *texts, None]], "text string").repartition(3)
    phrases = spark.createDataFrame(list(table.items()), "value string, kinds int")
    got = ph.kinds_in_texts(df, phrases, (1, 2))
    keyed = df.distinct().withColumn("text_key", ph.text_key(F.col("text")))
    assert {r.text: r.kinds for r in keyed.join(got, "text_key").collect()} == want


def test_recall_lists_of_any_length_write_the_texts_once_or_less(spark, monkeypatch):
    """The texts are not written again for each block of phrases."""
    written = []
    for module in (fl, ph):
        monkeypatch.setattr(module, "stored", lambda df, store=module.stored: written.append(df.columns) or store(df))
    df = spark.range(60).selectExpr("CAST(id AS string) AS product_id", "'' AS manufacturer",
                                    "concat('a kettle of type K', id * 7, 'x, red') AS text")
    many = spark.range(200).selectExpr("'model' AS kind", "concat('K', id, 'x') AS value")
    got = {int(r.product_id): r.recalled_flag for r in fl.with_recall_table(df, many, 10).collect()}
    assert got == {i: i * 7 < 200 for i in range(60)}
    assert len(written) <= 6 and not [c for c in written if "text" in c]


def test_similarities_write_the_rows_once(spark, monkeypatch):
    """Whatever the number of keyword blocks; and each row is compared with all of them."""
    written = []
    store = rv.stored
    monkeypatch.setattr(rv, "stored", lambda df: written.append(df.columns) or store(df))
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(300, 4))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(vectors)], "id int, v array<double>")
    got = rv.with_similarities(df, df.select(F.reverse("v").alias("k")), "v", "k", block=3).collect()
    assert len([c for c in written if "id" in c]) == 1 and len(written) <= 4
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    want = (unit @ unit[:, ::-1].T).max(axis=1)
    assert {r.id: r.max_similarity for r in got} == pytest.approx(dict(enumerate(want)))
