"""Image annotations: boxes to normalised regions, categories to tags, tags to tag ids.

Regions stay flat, one row per region, through all joins, and the flat table is the result that
holds at any size. Nested entries are for output: one row, and so one value, per image.

Several annotation documents may be handled at once: where the tables have a column ``document``,
ids count within it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plugwatch.functions.text import strip
from plugwatch.operators.joins import join_unique


def document_key(*frames: DataFrame) -> list[str]:
    """``document``, if all tables tell it."""
    return ["document"] if all("document" in f.columns for f in frames) else []


def image_url(images_prefix: str = "") -> Column:
    """First non-empty of absolute URL, hosted URL and file name."""
    p = images_prefix
    return F.coalesce(*[F.nullif(F.col(f"{p}{c}"), F.lit(""))
                        for c in ("absolute_url", "coco_url", "file_name")])


def normalise_box(x: Column, y: Column, w: Column, h: Column,
                  img_w: Column, img_h: Column) -> dict[str, Column]:
    """Box in shares of the image, kept in [0, 1].

    A box with any value above 1 is in pixels; it is 0 along an axis of unknown size.
    """
    pixels = F.greatest(x, y, w, h) > 1.0

    def share(value: Column, size: Column) -> Column:
        scaled = F.coalesce(F.try_divide(value.cast("double"), size.cast("double")), F.lit(0.0))
        return F.greatest(F.lit(0.0), F.least(
            F.lit(1.0), F.when(pixels, scaled).otherwise(value.cast("double"))))

    return {"left": share(x, img_w), "top": share(y, img_h),
            "width": share(w, img_w), "height": share(h, img_h)}


def latest_images(images: DataFrame, position: str = "pos") -> DataFrame:
    """One row per image id: the last one listed."""
    keys = [*document_key(images), "id"]
    others = [c for c in images.columns if c not in keys]
    last = F.max_by(F.struct(*others), F.col(position)).alias("_last")
    return images.groupBy(*keys).agg(last).select(*keys, "_last.*")


def regions(annotations: DataFrame, images: DataFrame, categories: DataFrame) -> DataFrame:
    """Flat regions ``image_id, url, pos, tag_name, left, top, width, height``.

    Annotations of unknown images and boxes that do not have four values drop out. An unknown
    or nameless category is called ``cat_<id>``.

    ``annotations``: image_id, category_id, pos, bbox; ``images``: id (unique), width,
    height, url; ``categories``: id, name and, if an id may repeat, pos: the last one counts.
    ``document`` comes first if all three have it.
    """
    doc = document_key(annotations, images, categories)
    place = "pos" if "pos" in categories.columns else "name"
    named = categories.groupBy(*doc, F.col("id").alias("category_id")).agg(
        F.max_by("name", place).alias("name"))
    sized = images.select(*doc, F.col("id").alias("image_id"), "url",
                          F.col("width").alias("_w"), F.col("height").alias("_h"))
    box = F.col("bbox")
    parts = [F.get(box, F.lit(i)) for i in range(4)]
    placed = join_unique(
        annotations.where(F.size(box) == 4), sized, [*doc, "image_id"], "inner")
    return (
        join_unique(placed, named, [*doc, "category_id"])
        .select(
            *doc, "image_id", "url", "pos",
            F.coalesce("name", F.concat(F.lit("cat_"), F.col("category_id").cast("string")))
            .alias("tag_name"),
            *[c.alias(n) for n, c in normalise_box(*parts, F.col("_w"), F.col("_h")).items()],
        )
    )


def entries(images: DataFrame, flat: DataFrame, tag: str = "tag_name") -> DataFrame:
    """Nested entries ``image_id, url, regions`` for output, one per image that has a URL.

    Regions come in the order of ``pos``; an image without any has ``[]``. ``tag`` is the
    column of ``flat`` that regions carry, as ``tagName`` or ``tagId``. Images take part in the
    grouping as rows without a region, so there is one grouping and no join.
    """
    keys = [*document_key(images, flat), "image_id", "url"]
    label = F.col(tag).cast("string").alias("tagId" if tag == "tag_id" else "tagName")
    region = F.struct("pos", label, "left", "top", "width", "height")
    held = flat.select(*keys, region.alias("_region"))
    bare = images.withColumnRenamed("id", "image_id").select(
        *keys, F.lit(None).cast(held.schema["_region"].dataType).alias("_region"))
    return (
        held.unionByName(bare).where(F.col("url").isNotNull()).groupBy(*keys)
        .agg(F.array_sort(F.collect_list("_region")).alias("_regions"))
        .select(*keys, F.transform("_regions", lambda r: r.dropFields("pos")).alias("regions"))
    )


def conversion_counts(images: DataFrame, annotations: DataFrame,
                      categories: DataFrame) -> DataFrame:
    """One row with the numbers of images, annotations, categories, and images with and
    without URL. ``images`` has unique ids."""
    n = F.count(F.lit(1))

    def only(name: str) -> list[Column]:
        names = ["num_images", "num_annotations", "num_categories", "num_entries_with_url",
                 "num_images_without_url"]
        return [F.col(c) if c in name.split() else F.lit(0).cast("bigint").alias(c) for c in names]

    parts = [
        images.agg(n.alias("num_images"), F.count("url").alias("num_entries_with_url"),
                   F.count_if(F.col("url").isNull()).alias("num_images_without_url"))
        .select(*only("num_images num_entries_with_url num_images_without_url")),
        annotations.agg(n.alias("num_annotations")).select(*only("num_annotations")),
        categories.agg(n.alias("num_categories")).select(*only("num_categories")),
    ]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.agg(*[F.sum(c).alias(c) for c in rows.columns])


def tag_table(categories: DataFrame) -> DataFrame:
    """``id, name`` of all categories in the order of the id."""
    name = F.coalesce("name", F.concat(F.lit("cat_"), F.col("id").cast("string")))
    return categories.select("id", name.alias("name")).orderBy("id")


def new_tags(wanted: DataFrame, existing: DataFrame) -> DataFrame:
    """Stripped, non-blank tag names that do not exist yet, each once."""
    names = wanted.select(strip(F.col("name")).alias("name")).where("name != ''")
    return names.distinct().join(existing.select("name"), "name", "left_anti")


def with_tag_ids(flat: DataFrame, tags: DataFrame) -> DataFrame:
    """Regions with ``tag_id``: the given one, or that of the tag name; others drop out.

    ``entries(images, with_tag_ids(…), "tag_id")`` keeps the images that lose all regions.
    ``tags``: name (unique), id.
    """
    ids = tags.select(F.col("name").alias("tag_name"), F.col("id").cast("string").alias("_id"))
    given = F.nullif(F.col("tag_id"), F.lit("")) if "tag_id" in flat.columns else F.lit(None)
    return (
        flat.withColumn("_given", given.cast("string")).join(ids, "tag_name", "left")
        .withColumn("tag_id", F.coalesce("_given", "_id"))
        .where(F.col("tag_id").isNotNull()).drop("_given", "_id")
    )


def unknown_tags(flat: DataFrame, tags: DataFrame) -> DataFrame:
    """Tag names used by regions without a given id that no tag has."""
    wanted = flat.where(F.coalesce(F.col("tag_id").cast("string"), F.lit("")) == "") \
        if "tag_id" in flat.columns else flat
    names = wanted.where("tag_name != ''").select("tag_name")
    return names.distinct().join(
        tags.select(F.col("name").alias("tag_name")), "tag_name", "left_anti")


def remap_tags(images: DataFrame, flat: DataFrame, image_tags: DataFrame,
               mapping: DataFrame) -> DataFrame:
    """Images with their tags under new ids: ``image_id, url, pos, tag_id`` and the box.

    Regions of unmapped tags drop out. An image left without regions has its mapped image-level
    tags instead, as rows without position and box, or one row without a tag if it has none of
    these either. Images without URL are skipped.

    ``images``: id (unique), url; ``flat``: image_id, pos, tag_id, left, top, width, height;
    ``image_tags``: image_id, tag_id; ``mapping``: old_id (unique), new_id.
    """
    ids = mapping.select(F.col("old_id").alias("tag_id"), F.col("new_id").alias("_new"))
    box = ["left", "top", "width", "height"]
    kept = flat.join(ids, "tag_id").select("image_id", "pos", F.col("_new").alias("_tag"), *box)
    whole = image_tags.join(ids, "tag_id").select(
        F.col("image_id").alias("_image"), F.col("_new").alias("_whole"))
    listed = images.where(F.col("url").isNotNull()).select(F.col("id").alias("image_id"), "url")
    placed = listed.join(kept, "image_id", "left")
    return placed.join(
        whole, (F.col("image_id") == F.col("_image")) & F.col("pos").isNull(), "left"
    ).select("image_id", "url", "pos", F.coalesce("_tag", "_whole").alias("tag_id"), *box)
