import unicodedata

import pytest
from pyspark.sql import functions as F

from plugwatch.functions import text as tx


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "t string").select(expr(F.col("t"))).first()[0]


def test_normalise(spark):
    text = f"a{chr(0x200B)}b – c — d {chr(0x2212)}5{chr(0xFEFF)}"
    assert one(spark, text, tx.normalise_text) == "ab - c - d -5"
    assert one(spark, None, tx.normalise_text) == ""


def test_listing_text(spark):
    assert one(spark, " a\x00b\r\n\tc  d ", tx.clean_listing_text) == "ab c d"
    nbsp = chr(0xA0)
    assert one(spark, f"a{nbsp}b{nbsp} c{nbsp}", tx.clean_listing_text) == f"a{nbsp}b c"
    assert one(spark, None, tx.clean_listing_text) is None


def test_encoding(spark):
    text = f"ﬁne{chr(0x2028)}½ x\x07\x85y  é {chr(0x65)}{chr(0x301)}"
    assert one(spark, text, tx.clean_encoding) == "fine 1⁄2 x y é é"
    assert one(spark, None, tx.clean_encoding) is None


def test_encoding_of_long_text_is_whole(spark):
    text = "é" * 50_000 + "ﬁ"
    assert one(spark, text, tx.clean_encoding) == "é" * 50_000 + "fi"


def test_characters_that_stay_in_the_jvm_do_not_change():
    kept = [chr(c) for c in (*range(0x80), *range(0xC0, 0x132))]
    assert all(unicodedata.normalize("NFKC", c) == c for c in kept)


def test_only_string_columns_are_cleaned(spark):
    df = spark.createDataFrame([(1, " a ", ["  x"])], "n int, s string, l array<string>")
    assert tuple(tx.clean_string_columns(df).first()) == (1, "a", ["  x"])


def test_join_text(spark):
    df = spark.createDataFrame([("a–b", None, ["x"])], "a string, b string, c array<string>")
    assert df.select(tx.join_text(df, "a", "b", "nope", "c")).first()[0] == 'a-b||||||["x"]'
    upper = tx.join_text(df, "a", "b", sep="/", normalise=F.upper)
    assert df.select(upper).first()[0] == "A–B/"
    with pytest.raises(KeyError):
        tx.join_text(df, "nope", ignore_missing=False)


def test_chunks(spark):
    assert one(spark, "A b. C! d • e - f—g; h", tx.chunks) == ["A b.", "C!", "d", "e", "f—g;", "h"]
    assert one(spark, "  ", tx.chunks) == ["  "]


def test_words(spark):
    assert one(spark, f" a b{chr(0xA0)}c\x1cd ", tx.word_count) == 4
    assert one(spark, " ", tx.word_count) == 1


def test_literal_alternation(spark):
    assert one(spark, "a (b) c", lambda c: c.rlike(tx.any_of(["x.y", "(b)"])))
    assert not one(spark, "xzy b", lambda c: c.rlike(tx.any_of(["x.y", "(b)"])))
