import os

import pytest


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    """The folder for written tables, as a cluster names it."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


@pytest.fixture(scope="session")
def table(spark):
    """Rows as a table of documents; ``more`` names columns beyond."""
    def make(rows, schema="doc_id long, text string"):
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture(scope="session")
def read(spark):
    def read(name, sf="sf0.001"):
        return spark.read.parquet(os.path.join("/root/testdata", sf, f"{name}.parquet"))

    return read


@pytest.fixture
def odd(table):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing names."""
    long_text = " ".join(f"w{i % 977}x{i % 31}" for i in range(40_000))
    rows = [
        (1, "Some words that are the same for all of them", "en", "a", 1),
        (2, "some WORDS that are the same for all of them", None, None, None),
        (2, "some WORDS that are the same for all of them", None, None, None),
        (None, "some words that are the same for all of them", "en", "a", 5),
        (None, None, None, None, None), (None, None, None, None, None), (4, "", "de", "b", 0),
        (5, None, "de", "b", 0), (6, " \t\n ", "de", "b", 3), (7, "... 123 !!!", "fr", "c", 11),
        (8, long_text, "en", "a", 9), (9, long_text, "en", "b", 9), (10, "eins", "de", "b", 4),
        (2, "another text under a number that is taken", "en", "c", 7),
        (11, "\U0001d11e İstanbul ÄÖ ſ", "de", "b", 1),
    ]
    return table(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr(
        "*", "doc_id AS id", "text AS norm", "1 AS keep_id", "source AS row", "2 AS salt",
        "'x' AS digest", "0.5D AS score", "'y' AS spans", "3 AS copy")
