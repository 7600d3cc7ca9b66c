"""From raw documents to a training mixture, in five stages.

Each stage takes all that the one before it kept, as a written table, and its decisions take effect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plugwatch.llm import decontaminate, exact_dedup, queries, simhash, toxicity
from plugwatch.llm.common import packed
from plugwatch.session import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model doesn't predict to be toxic, with their own columns as they were."""
    model = queries.toxicity_model(docs, spark, sf_dir)
    rows = docs.select(packed(docs).alias("row"), "text")
    return toxicity.score(rows, model, spans=False).filter("predicted = 0").select("row.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links."""
    return simhash.near_dedup(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.decontaminate(docs, items)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture, in random order, with ``copy`` and ``shuffle_key``."""
    return queries.mixture(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
]

# A learned stage and string hashes that SQL lacks; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
