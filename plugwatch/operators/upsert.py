"""Keyed upserts and constraint-checked appends for tables of plain files.

Each operator returns the new table or the rows to add; writing them is the caller's step,
so a failed job leaves the old table as it was.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plugwatch import schemas
from plugwatch.functions.text import strip
from plugwatch.operators.joins import join_unique
from plugwatch.operators.numbering import number_rows
from plugwatch.session import stored

# --- Fixed values: column lengths of the relational tables ------------------------------
PRODUCT_LENGTHS = {
    "ProductID": 18, "Marketplace": 32, "ProductGroup": 32, "Title": 500,
    "Description": 4000, "Currency": 3,
}
SELLER_LENGTHS = {"Name": 255, "Marketplace": 32, "URL": 1000}
PRODUCT_COLUMNS = (
    "ProductID", "Marketplace", "ProductGroup", "UploadDate", "Title", "Description",
    "Rating", "Price", "Currency", "NumImages", "SellerID",
)
PRODUCT_REQUIRED = ("ProductID", "Marketplace", "ProductGroup", "UploadDate", "Title")


def filled(*names: str) -> Column:
    """True where none of the columns is null or blank."""
    cond = F.lit(True)
    for n in names:
        cond = cond & (strip(F.col(n).cast("string")) != "")
    return F.coalesce(cond, F.lit(False))


def _fitted(lengths: Mapping[str, int], keys: Iterable[str], cut: Iterable[str]) -> dict[str, Column]:
    """Stripped text columns; those in ``cut`` are cut to size. Keys never are: rows that differ
    behind the cut would become one."""
    wrong = set(cut) & set(keys)
    if wrong:
        raise ValueError(f"keys are not cut: {sorted(wrong)}")
    return {n: strip(F.substring(strip(F.col(n)), 1, size) if n in set(cut) else F.col(n))
            for n, size in lengths.items()}


def _too_long(lengths: Mapping[str, int]) -> Column:
    cond = F.lit(False)
    for n, size in lengths.items():
        cond = cond | F.coalesce(F.length(F.col(n)) > size, F.lit(False))
    return cond


def conform_products(df: DataFrame, cut: Iterable[str] = ()) -> DataFrame:
    """Rows with a product id, stripped and cast to the table's columns, with ``reason``: null,
    or why the table can't take a row: ``length`` (a text is too long) or ``null`` (a required
    column is). Text columns named in ``cut`` are cut to size instead."""
    text = _fitted(PRODUCT_LENGTHS, PRODUCT_REQUIRED[:3], cut)
    text["Currency"] = F.upper(text["Currency"])
    missing = F.lit(False)
    for c in PRODUCT_REQUIRED:
        missing = missing | F.col(c).isNull()
    return df.where(filled("ProductID")).withColumns({
        **text,
        "Rating": F.col("Rating").cast("decimal(3,2)"),
        "Price": F.col("Price").cast("decimal(18,2)"),
        "NumImages": F.col("NumImages").cast("int"),
        "SellerID": F.col("SellerID").cast("int"),
    }).select(*PRODUCT_COLUMNS).withColumn(
        "reason", F.when(_too_long(PRODUCT_LENGTHS), "length").when(missing, "null"))


def one_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that is largest by ``order`` and then by all other columns.

    A maximum, not a window: it is taken before the shuffle too, so a key with very many
    rows costs one row per task.
    """
    others = [c for c in df.columns if c not in keys]
    ranked = [c for c in order if c not in keys] + [c for c in others if c not in order]
    best = F.max(F.struct(*ranked)).alias("_best")
    return df.groupBy(*keys).agg(best).select(
        *keys, *[F.col(f"_best.{c}").alias(c) for c in ranked]).select(*df.columns)


def merge_rows(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` without the keys of ``new``, and ``new``; keys that are null match each other.

    The target is joined, not grouped: it is shuffled only if the new keys are too many to be
    broadcast, and never sorted for a maximum.
    """
    some = new.select(*[F.col(f"`{k}`").alias(f"_new_{i}") for i, k in enumerate(keys)])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"_new_{i}"))
    return target.join(some, same, "left_anti").unionByName(new)


def upsert(target: DataFrame, source: DataFrame, keys: list[str],
           order: Iterable[str] = ()) -> DataFrame:
    """The table after a merge: source rows replace or extend, other rows stay.

    Of source rows with the same key the largest by ``order`` counts. Only the source is grouped,
    and stored. Keys of ``target`` are unique. ``sources.buckets`` has a table of which a merge
    reads and writes only a part.
    """
    return merge_rows(target, stored(one_per_key(source.select(*target.columns), keys, list(order))), keys)


def upsert_products(target: DataFrame, df: DataFrame,
                    cut: Iterable[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Products after the merge, and the rejected rows with their reason; of rows with the same
    id the latest upload counts."""
    rows = conform_products(df, cut)
    table = upsert(target.select(*PRODUCT_COLUMNS),
                   rows.where(F.col("reason").isNull()).drop("reason"), ["ProductID"], ["UploadDate"])
    return table, rows.where(F.col("reason").isNotNull())


def conform_sellers(df: DataFrame, cut: Iterable[str] = ()) -> DataFrame:
    """Named sellers, stripped, with ``reason`` as for products."""
    missing = [c for c in ("Name", "Marketplace", "URL") if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    text = _fitted(SELLER_LENGTHS, ("Name", "Marketplace"), cut)
    rows = df.where(filled("Name", "Marketplace")).select(*[c.alias(n) for n, c in text.items()])
    return rows.withColumn("reason", F.when(_too_long(SELLER_LENGTHS), "length"))


def first_sellers(df: DataFrame, cut: Iterable[str] = ()) -> DataFrame:
    """Sellers that the table can take, one per name and marketplace: the lowest URL, if any."""
    rows = conform_sellers(df, cut).where(F.col("reason").isNull())
    return rows.groupBy("Name", "Marketplace").agg(F.min("URL").alias("URL"))


def upsert_sellers(target: DataFrame, df: DataFrame,
                   cut: Iterable[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Sellers after the merge, and the ``SellerID, Name, Marketplace`` of all merged ones.

    Known sellers keep their id and take the new URL. New ones are numbered after the
    highest id. Target and source are joined once, and the join is a written table.
    """
    keys = ["Name", "Marketplace"]
    new = first_sellers(df, cut).withColumn("_new", F.lit(True))
    old = target.select("SellerID", *keys, F.col("URL").alias("_old"))
    both = stored(old.join(new, keys, "full"))
    known = both.where(F.col("SellerID").isNotNull())
    fresh = number_rows(both.where(F.col("SellerID").isNull()).select(*keys, "URL"), keys, "_no")
    top = both.select(F.coalesce(F.max("SellerID"), F.lit(0))).scalar()
    columns = ["SellerID", *keys, "URL"]
    numbered = fresh.withColumn("SellerID", (top + F.col("_no")).cast("int")).select(*columns)
    url = F.when(F.col("_new"), F.col("URL")).otherwise(F.col("_old"))
    table = known.withColumn("URL", url).select(*columns).unionByName(numbered)
    ids = known.where("_new").select(*columns).unionByName(numbered)
    return table, ids.select("SellerID", *keys)


@dataclass(frozen=True)
class Constraints:
    """Keys of a table: primary key, required columns, and references as
    ``{column: (table, its column)}``."""

    primary_key: tuple[str, ...]
    not_null: tuple[str, ...] = ()
    references: dict[str, tuple[DataFrame, str]] = field(default_factory=dict)


def table_constraints(name: str, tables: Mapping[str, DataFrame]) -> Constraints:
    """The constraints of one of the five tables of ``schemas.TABLES``; ``tables`` has those it
    refers to."""
    ddl, key, references = schemas.TABLES[name]
    required = tuple(f.name for f in T.StructType.fromDDL(ddl).fields if not f.nullable)
    return Constraints(key, required, {
        column: (tables[parent], parent_column)
        for column, (parent, parent_column) in references.items()})


def checked_append(target: DataFrame, rows: DataFrame, constraints: Constraints,
                   order: list[str]) -> DataFrame:
    """``rows`` with ``reason``: null for the rows to append, else why a row is rejected.

    Reasons are ``null`` (a required column), ``reference`` (a missing parent) and ``key``
    (the key exists, or an earlier valid row has it, by ``order`` and then by all other columns). Of
    rows equal in all columns one is appended.
    """
    pk = list(constraints.primary_key)
    required = [*pk, *[c for c in constraints.not_null if c not in pk]]
    has_null = F.lit(False)
    for c in required:
        has_null = has_null | F.col(c).isNull()
    # Equal rows are counted first, before the shuffle too.
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n"))
    checked = counted.withColumn("_null", has_null).withColumn("_orphan", F.lit(False))
    for column, (parent, parent_column) in constraints.references.items():
        parents = parent.select(F.col(parent_column).alias(column)).dropna().distinct() \
            .withColumn("_found", F.lit(True))
        checked = join_unique(checked, parents, [column]).withColumn(
            "_orphan", F.col("_orphan")
            | (F.col(column).isNotNull() & F.col("_found").isNull())).drop("_found")
    taken = target.select(*pk).distinct().withColumn("_taken", F.lit(True))
    checked = join_unique(checked, taken, pk).withColumn(
        "_reason",
        F.when(F.col("_null"), "null").when(F.col("_orphan"), "reference")
        .when(F.col("_taken"), "key"))
    # First valid row per key, as a partial minimum instead of a window over a hot key. Rows that
    # tie in ``order`` are told apart by the rest, so that a key is never appended twice.
    place = F.struct(*order, *[c for c in rows.columns if c not in order])
    first = checked.where(F.col("_reason").isNull()).groupBy(*pk).agg(F.min(place).alias("_first"))
    late = F.col("_reason").isNull() & ~place.eqNullSafe(F.col("_first"))
    told = join_unique(checked, first, pk).withColumn(
        "_reason", F.when(late, "key").otherwise(F.col("_reason")))
    again = told.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))))
    return again.withColumn(
        "reason", F.when(F.col("_reason").isNull() & (F.col("_i") > 1), "key")
        .otherwise(F.col("_reason"))).select(*rows.columns, "reason")
