"""Bounded samples of labelled documents, to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keyed_texts(df: DataFrame, key: Column, text: Column, max_chars: int) -> DataFrame:
    """The texts that may be sampled, under a hash of their key: (h, text). Those that are null or
    longer than ``max_chars`` may not."""
    return df.select(F.xxhash64(key.cast("string")).alias("h"), text.alias("text")).filter(
        F.length("text") <= max_chars)


def sample(labels: DataFrame, texts: DataFrame, slots: int) -> list[tuple[str, str]]:
    """At most ``slots`` (label, text) pairs of each label, in a fixed order.

    ``labels`` has (h, label), a label for keys that have a text; ``texts`` is as of
    ``keyed_texts``. Each key falls into a slot by its hash, and the least hash of a slot wins: a
    partial aggregate, so a hot label is no hot task. Only the winners' texts are moved. Null
    labels are none. Of texts with the same key, the least one is taken.
    """
    won = labels.filter("label is not null").groupBy(
        F.col("label").cast("string").alias("label"), F.pmod("h", F.lit(slots)).alias("slot")
    ).agg(F.min("h").alias("h"))
    # At most slots rows for each label, as many as the caller collects.
    found = texts.join(F.broadcast(won), "h").groupBy("label", "slot").agg(
        F.min("text").alias("text"))
    return [(r["label"], r["text"]) for r in found.sort("label", "slot").collect()]
