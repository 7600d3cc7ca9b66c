"""Which query found which product, ids per query, and path columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plugwatch.operators.joins import join_unique
from plugwatch.settings import MAX_IDS_PER_QUERY

# --- Fixed values: patterns ------------------------------------------------------------
GROUP_IN_PATH = r"(?iU)Group\s+[A-Z]"
MARKETPLACE_IN_PATH = r"marketplace=([^\\/]+)"


def current_results(results: DataFrame) -> DataFrame:
    """Search results when a repeated query replaces its earlier result.

    ``results``: run (order of retrieval), query, position, product_id. The query keeps the
    place of its first run, in ``query_no``.
    """
    runs = results.groupBy("query").agg(
        F.min("run").alias("query_no"), F.max("run").alias("run"))
    return results.join(runs, ["query", "run"]).select(
        "query", "query_no", "position", "product_id")


def first_ids(results: DataFrame, limit: int = MAX_IDS_PER_QUERY) -> DataFrame:
    """The first ``limit`` ids of each query; the limit applies before the shuffle too."""
    rank = F.row_number().over(Window.partitionBy("query").orderBy("position", "product_id"))
    return results.withColumn("_rank", rank).where(F.col("_rank") <= limit).drop("_rank")


def first_ids_array(ids: Column, limit: int = MAX_IDS_PER_QUERY) -> Column:
    """The same for ids that come as one array per query."""
    return F.slice(ids, 1, limit)


def attribute_queries(products: DataFrame, results: DataFrame) -> DataFrame:
    """Set ``query`` of each product to the last query that lists its id; others keep theirs.

    ``results``: query, query_no, product_id.
    """
    found = results.where("product_id != ''").groupBy("product_id").agg(
        F.max_by("query", F.struct("query_no", "query")).alias("_found"))
    out = join_unique(products, found, ["product_id"])
    return out.withColumn("query", F.coalesce("_found", "query")).drop("_found") \
        .select(*products.columns)


def group_from_path(path: Column) -> Column:
    """The first ``Group X`` in a path, as written there; null without one."""
    return F.nullif(F.regexp_extract(path, GROUP_IN_PATH, 0), F.lit(""))


def marketplace_from_path(path: Column) -> Column:
    """The value of the ``marketplace=`` folder; null without one."""
    return F.nullif(F.regexp_extract(path, MARKETPLACE_IN_PATH, 1), F.lit(""))


def id_or_legacy(*columns: str) -> Column:
    """The first column unless it is empty, else the first legacy column that is not null."""
    return F.coalesce(F.nullif(F.col(columns[0]), F.lit("")), *[F.col(c) for c in columns[1:]])


def path_mapping(paths: DataFrame, old_prefix: str, new_prefix: str,
                 column: str = "path") -> DataFrame:
    """``old_path, new_path`` of the paths below ``old_prefix``."""
    path = F.col(column)
    rest = F.substring(path, F.lit(len(old_prefix) + 1), F.length(path))
    return paths.where(path.startswith(old_prefix)).select(
        path.alias("old_path"), F.concat(F.lit(new_prefix), rest).alias("new_path"))
