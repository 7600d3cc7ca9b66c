"""Marketplace adapters: raw rows of one marketplace to standard products and sellers."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plugwatch.functions.text import clean_listing_text
from plugwatch.session import stored
from plugwatch.settings import PRODUCT_COLUMNS

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Adapter:
    """``process`` maps raw rows to (products, sellers); ``legacy_id`` names an older id field."""

    process: Callable[[DataFrame], tuple[DataFrame, DataFrame]]
    legacy_id: str | None = None


def canonical(products: DataFrame, marketplace: str, for_model: bool = False) -> DataFrame:
    """Stamp the marketplace, clean the text and select the canonical columns.

    Outside training an absent category is the query. A missing column is an error.
    """
    df = products.withColumns({
        "marketplace": F.lit(marketplace), "text": clean_listing_text(F.col("text"))})
    if not for_model and "category" not in df.columns:
        df = df.withColumn("category", F.col("query"))
    missing = [c for c in PRODUCT_COLUMNS if c not in df.columns]
    if missing:
        raise KeyError(f"adapter {marketplace!r} gives no {missing}")
    return df.select(*PRODUCT_COLUMNS)


def standardise(read: Callable[[str], DataFrame], adapters: Mapping[str, Adapter],
                for_model: bool = False) -> tuple[DataFrame, DataFrame]:
    """Products and sellers of all marketplaces.

    ``read(marketplace)`` gives the raw rows. A marketplace whose adapter fails while the plan
    is built is logged and left out; if none is left, that is an error.
    """
    products, sellers = [], []
    for name, adapter in adapters.items():
        try:
            found, sold = adapter.process(read(name))
            found = canonical(found, name, for_model)
        except Exception:
            log.exception("marketplace %s left out", name)
            continue
        products.append(found)
        sellers.append(sold.withColumn("Marketplace", F.lit(name)))
    if not products:
        raise ValueError("no marketplace gave any products")
    return (reduce(DataFrame.unionByName, products),
            reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sellers))


OUTCOMES = "marketplace string, outcome string, products long, sellers long, error string"


def standardise_each(spark: SparkSession, read: Callable[[str], DataFrame],
                     adapters: Mapping[str, Adapter], for_model: bool = False,
                     ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Products and sellers of the marketplaces that succeed, and the outcome of each.

    Every marketplace is written to the shared folder on its own, so that one whose adapter
    fails, be it while the plan is built or in a task, takes nothing from the others and leaves
    none of its rows. An outcome is ``rows``, ``empty`` (no products) or ``error`` with the
    first line of the reason. If all fail, that is an error.
    """
    products, sellers, outcomes = [], [], []
    for name, adapter in adapters.items():
        try:
            found, sold = adapter.process(read(name))
            found = stored(canonical(found, name, for_model))
            sold = stored(sold.withColumn("Marketplace", F.lit(name)))
            counts = found.count(), sold.count()
        except Exception as err:
            log.exception("marketplace %s left out", name)
            reason = str(err).strip().split("\n")[0]
            outcomes.append((name, "error", 0, 0, f"{type(err).__name__}: {reason}"))
            continue
        products.append(found)
        sellers.append(sold)
        outcomes.append((name, "rows" if counts[0] else "empty", *counts, None))
    if not products:
        raise ValueError(f"no marketplace succeeded: {outcomes}")
    return (reduce(DataFrame.unionByName, products),
            reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sellers),
            spark.createDataFrame(outcomes, OUTCOMES))


def legacy_ids(adapters: Mapping[str, Adapter]) -> tuple[str, ...]:
    return tuple(a.legacy_id for a in adapters.values() if a.legacy_id)


def read_marketplace(spark: SparkSession, root: str, **options) -> Callable[[str], DataFrame]:
    """Reader for :func:`standardise` over the raw product files below ``root``: good records only.
    Use :func:`from_rows` to keep the broken ones too, and to read the files once."""
    from plugwatch.sources.files import read_raw_products, split_broken

    return lambda name: split_broken(read_raw_products(spark, root, name, **options))[0]


def from_rows(rows: DataFrame) -> Callable[[str], DataFrame]:
    """Reader for :func:`standardise` over rows of ``read_raw_products``, broken ones left out."""
    from plugwatch.sources.files import of_marketplace, split_broken

    return lambda name: split_broken(of_marketplace(rows, name))[0]
