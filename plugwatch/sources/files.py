"""File sources and sinks."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plugwatch import schemas
from plugwatch.operators.attribution import (
    group_from_path, id_or_legacy, marketplace_from_path,
)
from plugwatch.operators.images import parse_predictions
from plugwatch.session import stored
from plugwatch.sources.tolerant import split_parts

CORRUPT = "_corrupt_record"
# Where a record that can't be read stands, and why it can't.
FILE, POSITION, REASON = "_file", "_position", "_reason"


def _any_case(word: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)


def _as_text(kind: T.DataType) -> T.DataType:
    """The same shape with text for each single value."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_as_text(kind.elementType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _as_text(f.dataType)) for f in kind.fields])
    return kind if isinstance(kind, T.MapType) else T.StringType()


def _typed(value: Column, kind: T.DataType) -> Column:
    """Text of that shape as ``kind``, null where a single value can't be read as its type."""
    if kind == _as_text(kind):
        return value
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _typed(x, kind.elementType))
    if isinstance(kind, T.StructType):
        fields = [_typed(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value.try_cast(kind)


def _named(kind: str) -> str:
    """The pattern of ``*.json`` file names with ``kind`` in them, in any case."""
    return f"*{_any_case(kind)}*.json"


def _json_files(spark: SparkSession, root: str, kind: str, schema: str, multi_line: bool,
                nested_dirs: bool) -> DataFrame:
    """``*.json`` files below ``root`` with ``kind`` in their name, in any case.

    A file that Spark can't read as a whole is cut into its records (``sources.tolerant``), and only
    the broken ones come back with ``_corrupt_record`` set, their file, position and reason.
    Values are read as text and cast afterwards, so that one of a wrong type is null and does not
    break its record. Files that can't be opened are skipped here: see :func:`unread_files`.
    """
    wanted = T.StructType.fromDDL(schema)
    plain = _as_text(wanted)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    reader = (
        spark.read.schema(T.StructType([*plain.fields, T.StructField(CORRUPT, T.StringType())]))
        .options(**options).option("multiLine", multi_line).option("ignoreCorruptFiles", True)
        .option("pathGlobFilter", _named(kind))
    )
    if nested_dirs:
        reader = reader.option("recursiveFileLookup", True)
    names = [f.name for f in wanted.fields]
    broken = F.col(CORRUPT)
    # Spark refuses to read the column of broken records alone, so another one is looked at.
    some = F.when(broken.isNotNull() | F.col(f"`{names[0]}`").isNotNull(), broken)
    rows = reader.json(root).withColumns(
        {FILE: F.col("_metadata.file_path"), "_parts": split_parts(some, names)})
    # The text of a whole file is not repeated for each of its records.
    rows = rows.withColumns({
        "_whole": broken.isNull(), CORRUPT: F.when(F.size("_parts") > 0, None).otherwise(broken),
    }).withColumn("_part", F.explode_outer("_parts"))
    part, whole = F.col("_part"), F.col("_whole")
    again = F.from_json(part["record"], T.StructType(
        [*plain.fields, T.StructField(CORRUPT, T.StringType())]), options)
    rows = rows.withColumn("_again", F.when(part["record"].isNotNull() & part["reason"].isNull(), again))
    read = whole | (F.col("_again").isNotNull() & F.col(f"_again.{CORRUPT}").isNull())
    told = F.coalesce(part["reason"], F.when(part.isNull(), "empty").otherwise("broken"))
    rows = rows.select(
        *[F.when(whole, F.col(f"`{n}`")).when(read, F.col("_again")[n]).alias(n) for n in names],
        F.when(~read, F.coalesce(part["record"], broken)).alias(CORRUPT), FILE,
        F.when(~read, F.coalesce(part["position"], F.lit(0))).alias(POSITION),
        F.when(~read, told).alias(REASON))
    typed = {f.name: _typed(F.col(f"`{f.name}`"), f.dataType) for f in wanted.fields
             if f.dataType != _as_text(f.dataType)}
    return rows.withColumns(typed)


def _folder() -> Column:
    """The folder of the row's file. Spark encodes all but "+", which decoding would take for a
    blank."""
    path = F.replace(F.col(FILE), F.lit("+"), F.lit("%2B"))
    return F.regexp_replace(F.url_decode(path), "/[^/]*$", "")


def split_broken(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the rows of broken records for quarantine: ``_file``, ``_position`` (in
    characters), ``_reason`` and the record's text."""
    broken = F.col(CORRUPT).isNotNull()
    return (df.where(~broken).drop(CORRUPT, FILE, POSITION, REASON),
            df.where(broken).select(FILE, POSITION, REASON, CORRUPT))


def unread_files(spark: SparkSession, root: str, kind: str, rows: DataFrame) -> DataFrame:
    """The files of a kind that gave ``rows`` neither a row nor a broken record: ``_file``,
    ``length`` and ``_reason``, ``nothing read``: the file can't be opened, or holds an empty list.
    Only names and sizes are listed; Spark lists no files without bytes."""
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", _named(kind)).load(root)
        .select(F.col("_metadata.file_path").alias(FILE), "length")
    )
    return listed.join(rows.select(FILE).distinct(), FILE, "left_anti").withColumn(
        REASON, F.lit("nothing read"))


def read_raw_products(spark: SparkSession, root: str, marketplace: str | None = None,
                      schema: str = schemas.RAW_PRODUCT, multi_line: bool = True) -> DataFrame:
    """Raw products below ``date=/productgroup=/marketplace=`` or any other folders.

    Adds ``product_group`` and ``marketplace`` from the path. ``marketplace`` keeps the files
    whose folder names it. Files that hold one JSON array are read whole (``multi_line``);
    JSON lines are split into tasks. Broken records: see :func:`split_broken`.
    """
    df = _json_files(spark, root, "product", schema, multi_line, nested_dirs=True)
    folder = _folder()
    if marketplace:
        df = df.where(folder.contains(marketplace))
    return df.withColumns({
        "product_group": group_from_path(folder), "marketplace": marketplace_from_path(folder)})


def of_marketplace(rows: DataFrame, marketplace: str) -> DataFrame:
    """The rows of :func:`read_raw_products` whose folder names the marketplace."""
    return rows.where(_folder().contains(marketplace))


def read_review_records(spark: SparkSession, root: str, legacy_ids: tuple[str, ...] = (),
                        schema: str = schemas.RAW_REVIEW, multi_line: bool = True) -> DataFrame:
    """One row per record of the raw review files: the product id (or the first legacy id that is
    set), the marketplace of its folder and the nested reviews. Broken records: see
    :func:`split_broken`."""
    schema = ", ".join([schema, *[f"{c} string" for c in legacy_ids]])
    df = _json_files(spark, root, "review", schema, multi_line, nested_dirs=True)
    return df.select(
        id_or_legacy("product_id", *legacy_ids).alias("product_id"),
        marketplace_from_path(_folder()).alias("marketplace"), "reviews",
        CORRUPT, FILE, POSITION, REASON)


def each_review(records: DataFrame) -> DataFrame:
    """One row per review, and one per broken record."""
    none = F.array(F.lit(None).cast(records.schema["reviews"].dataType.elementType))
    reviews = F.when(F.col(CORRUPT).isNotNull(), none).otherwise(F.col("reviews"))
    return records.withColumn("_review", F.explode(reviews)).select(
        "product_id", "marketplace", "_review.*", CORRUPT, FILE, POSITION, REASON)


def read_raw_reviews(spark: SparkSession, root: str, legacy_ids: tuple[str, ...] = (),
                     schema: str = schemas.RAW_REVIEW, multi_line: bool = True) -> DataFrame:
    """The reviews of :func:`read_review_records`, one a row."""
    return each_review(read_review_records(spark, root, legacy_ids, schema, multi_line))


def read_partitioned(spark: SparkSession, root: str, schema: str, kind: str = "") -> DataFrame:
    """JSON lines as :func:`write_partitioned` leaves them, of the files with ``kind`` in their
    name. Filters on ``date``, ``productgroup`` and ``marketplace`` skip whole folders."""
    return spark.read.schema(
        f"{schema}, date string, productgroup string, marketplace string"
    ).option("pathGlobFilter", _named(kind)).json(root)


def _rename(spark: SparkSession, root: str, name) -> None:
    """Gives Spark's files below ``root`` the path ``name(folder, file name)``, relative to the folder,
    as the writer can't name its files."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    top = hadoop.Path(root)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, old = fs.listFiles(top, True), []
    while found.hasNext():
        path = found.next().getPath()
        if path.getName().startswith("part-"):
            old.append(path)
    for path in old:
        new = hadoop.Path(path.getParent(), name(path.getParent().getName(), path.getName()))
        if not fs.rename(path, new):
            raise OSError(f"can't rename {path.toString()}")


def _renamed(spark: SparkSession, root: str, kind: str) -> None:
    """Names below ``root`` that start with ``kind`` and end in ``.json``."""
    _rename(spark, root, lambda folder, name: f"{kind}-{name.rsplit('.', 1)[0]}.json")


def is_local(spark: SparkSession, path: str) -> bool:
    """Whether Spark finds ``path`` in the file system, where tasks can open it too."""
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getScheme() == "file"


def _local_path(path: str) -> str:
    return re.sub("^file:/*", "/", path)


def _write_each(df: DataFrame, path: str) -> None:
    """Writes each row's ``value`` and a line break to the file ``file`` below the local ``path``. Each task
    writes its files under their names, so the driver handles none; one that is run again replaces them."""
    root = _local_path(path)

    def write(batches):
        import os
        import uuid

        import pyarrow as pa

        made = set()
        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                folder, _, last = f"{root}/{name}".rpartition("/")
                if folder not in made:
                    os.makedirs(folder, exist_ok=True)
                    made.add(folder)
                # Spark reads no names that start with a point.
                part = f"{folder}/.{uuid.uuid4().hex}"
                with open(part, "wb") as f:
                    f.write((value or "").encode() + b"\n")
                os.replace(part, f"{folder}/{last}")
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    df.select("file", "value").mapInArrow(write, "n long").agg(F.sum("n")).collect()


def write_files(df: DataFrame, path: str, suffix: str) -> None:
    """One file for each row of ``df``, with the text ``value``, a line break and the name ``name`` +
    ``suffix``; paths are in the order of the names. Rows of one name are lines of one file. Names are plain
    letters, digits and ``_``."""
    spark = df.sparkSession
    if is_local(spark, path):
        name = F.coalesce("name", F.lit("__HIVE_DEFAULT_PARTITION__")).alias("name")
        lines = df.groupBy(name).agg(F.array_join(F.collect_list(F.coalesce("value", F.lit(""))), "\n").alias("value"))
        # In folders by the first letters, so that paths lie in the order of the names.
        return _write_each(lines.select(
            F.concat(F.left("name", F.lit(4)), F.lit("/"), F.col("name"), F.lit(suffix)).alias("file"), "value"), path)
    df.write.partitionBy("name").text(path)
    _rename(spark, path, lambda folder, name: folder.removeprefix("name=") + suffix)


def write_partitioned(df: DataFrame, path: str, mode: str = "append", kind: str = "") -> None:
    """Raw layout ``date=/productgroup=/marketplace=`` as JSON lines, which Spark can split.

    Each task writes its own file per folder, so a large folder is not one task's work. ``kind``
    starts the names of the new files, so that products and reviews can lie in one folder.
    """
    df.write.mode(mode).partitionBy("date", "productgroup", "marketplace").json(path)
    if kind:
        _renamed(df.sparkSession, path, kind)


# What Spark writes as % and two digits in the name of a folder.
_ESCAPED = "([\\x01-\\x1F\"#%'*/:=?\\\\\\x7F{\\[\\]^])"


def _folder_name(name: str) -> Column:
    """The folder that Spark's writer gives a value of the column ``name``."""
    value = F.coalesce(F.col(name), F.lit("__HIVE_DEFAULT_PARTITION__"))
    letters = F.transform(F.regexp_extract_all(value, F.lit("(?s)."), F.lit(0)), lambda c: F.when(
        c.rlike(_ESCAPED), F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(c)), 2, "0"))).otherwise(c))
    return F.concat(F.lit(f"{name}="), F.when(value.rlike(_ESCAPED), F.array_join(letters, "")).otherwise(value))


def write_arrays(records: DataFrame, path: str, kind: str, file_rows: int = 10_000) -> None:
    """Raw layout with JSON arrays: rows of ``record`` (the JSON text of one record) and the folder
    columns, dealt by the hash of the record to files of some ``file_rows`` each."""
    spark, folders = records.sparkSession, ["date", "productgroup", "marketplace"]
    # An empty value has the folder of a null one.
    records = records.withColumns({c: F.nullif(F.col(c).cast("string"), F.lit("")) for c in folders})
    # Written, so that Spark measures how small it is.
    sizes = stored(records.groupBy(*folders).agg(
        (1 + F.floor(F.count(F.lit(1)) / file_rows)).alias("_files")))
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}")) for c in folders]
    dealt = records.alias("r").join(sizes.alias("s"), same).select(
        *[f"r.{c}" for c in folders], "record", F.pmod(F.xxhash64("record"), F.col("_files")).alias("_no"))
    # Of a size that is a parameter, so the array of one file fits a task.
    arrays = dealt.groupBy(*folders, "_no").agg(
        F.concat(F.lit("[\n"), F.array_join(F.sort_array(F.collect_list("record")), ",\n"),
                 F.lit("\n]")).alias("value"))
    if is_local(spark, path):
        name = F.concat(F.lit(f"{kind}-{uuid.uuid4().hex}-"), F.col("_no").cast("string"), F.lit(".json"))
        return _write_each(arrays.select(
            F.concat_ws("/", *map(_folder_name, folders), name).alias("file"), "value"), path)
    arrays.select("value", *folders).write.mode("append").option("maxRecordsPerFile", 1).option(
        "lineSep", "\n").partitionBy(*folders).text(path)
    _renamed(spark, path, kind)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV table with header and quoted line breaks."""
    return spark.read.schema(schema).csv(path, header=True, multiLine=True, escape='"')


def write_csv(df: DataFrame, path: str, partition_by: tuple[str, ...] = (),
              mode: str = "overwrite") -> None:
    """A CSV table; nested columns become JSON text."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    flat = df.select([
        F.to_json(f"`{f.name}`").alias(f.name) if isinstance(f.dataType, nested)
        else F.col(f"`{f.name}`") for f in df.schema.fields
    ])
    flat.write.mode(mode).partitionBy(*partition_by).csv(
        path, header=True, escape='"', emptyValue="")


def read_image_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Predictions kept as text in a CSV table: ``product_id, predictions``."""
    raw = read_csv(spark, path, "product_id string, predictions string")
    return raw.withColumn("predictions", parse_predictions(F.col("predictions")))


def read_annotations(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The images, annotations and categories of annotation documents, as flat tables.

    ``pos`` is the place in the document's list, ``document`` the path of its file: ids count
    within a document.
    """
    docs = spark.read.schema(schemas.ANNOTATION_DOCUMENT).json(path, multiLine=True).withColumn(
        "document", F.col("_metadata.file_path"))
    return {
        part: docs.select("document", F.posexplode(part).alias("pos", "_item"))
        .select("document", "pos", "_item.*")
        for part in ("images", "annotations", "categories")
    }


def read_image_entries(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Flat regions of an entries file, which is ``{"images": […]}`` or a bare list; without
    ``multi_line``, of the JSON lines of :func:`write_image_entries`.

    Columns: ``url`` (or the name), ``image_no``, ``pos``, ``tag_id``, ``tag_name`` and the
    box. An entry without regions has one row with nulls; one without url and name drops out.
    """
    raw = spark.read.schema(schemas.IMAGE_ENTRIES).json(path, multiLine=multi_line)
    bare = F.struct("url", "name", "regions")
    rows = raw.select(F.posexplode_outer(
        F.coalesce("images", F.array(bare))).alias("image_no", "_e"))
    url = F.coalesce(F.nullif(F.col("_e.url"), F.lit("")), F.nullif(F.col("_e.name"), F.lit("")))
    return rows.select(
        url.alias("url"), "image_no", F.posexplode_outer("_e.regions").alias("pos", "_r"),
    ).where("url IS NOT NULL").select(
        "url", "image_no", "pos", F.col("_r.tagId").alias("tag_id"),
        F.col("_r.tagName").alias("tag_name"), "_r.left", "_r.top", "_r.width", "_r.height")


def write_image_entries(entries: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Entries as JSON lines ``{"url": …, "part": …, "regions": […]}``."""
    entries.write.mode(mode).json(path)


def list_images(spark: SparkSession, root: str, marketplace: str | None = None) -> DataFrame:
    """Image files ``*_image*.jpg`` below ``root`` as ``product_id`` (from the file name) and
    ``path``. Files are listed, not opened."""
    from plugwatch.operators.images import image_id

    df = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*_{_any_case('image')}*.jpg").load(root)
    )
    if marketplace:
        df = df.where(F.regexp_replace("path", "/[^/]*$", "").contains(marketplace))
    # The path of a binary file is not encoded, unlike that in _metadata.
    return df.select(image_id(F.col("path")).alias("product_id"), "path")


def open_images(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path`` and ``content`` of these files; no others are opened. Files that have gone or can't
    be read are left out."""
    # What Spark would take for a pattern is part of the name.
    exact = [re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths]
    return spark.read.format("binaryFile").option("ignoreCorruptFiles", True).option(
        "ignoreMissingFiles", True).load(exact).select("path", "content")


def open_chosen(chosen: DataFrame, task_files: int = 256) -> DataFrame:
    """``path`` and ``content`` of the local files of a table with their ``path``, as of :func:`open_images`: each
    task opens some ``task_files``, and the driver holds none of the paths."""
    def read(batches):
        import pyarrow as pa

        schema = pa.schema([("path", pa.string()), ("content", pa.binary())])
        for batch in batches:
            rows, size = [], 0
            for path in batch.column(0).to_pylist():
                try:
                    with open(_local_path(path), "rb") as f:
                        rows.append((path, f.read()))
                except OSError:
                    continue
                size += len(rows[-1][1])
                if size > 1 << 24:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], schema=schema)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], schema=schema)

    tasks = 1 + chosen.count() // task_files
    return chosen.select("path").repartition(tasks, "path").mapInArrow(read, "path string, content binary")


def append_rows(df: DataFrame, path: str, batch: str) -> bool:
    """Append the rows of a batch to a Parquet table, once: a batch that is there is not written
    again, and one whose job failed is written anew. Tells whether it was written.

    A batch is a folder, which Spark's committer marks as done at the end; ``batch`` names it.
    """
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", batch):
        raise ValueError(f"not the name of a batch: {batch!r}")
    spark, folder = df.sparkSession, f"{path.rstrip('/')}/_batch={batch}"
    if batch in _batches(spark, path)[0]:
        return False
    df.write.mode("overwrite").option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(folder)
    return True


def _batches(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """The batches of a table that are done, and those that are not."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    top = hadoop.Path(path)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done, other = [], []
    for found in fs.listStatus(top) if fs.exists(top) else ():
        name = found.getPath().getName()
        if name.startswith("_batch="):
            ok = fs.exists(hadoop.Path(found.getPath(), "_SUCCESS"))
            (done if ok else other).append(name.removeprefix("_batch="))
    return sorted(done), sorted(other)


def read_appended(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of the batches that are done."""
    done, _ = _batches(spark, path)
    folders = [f"{path.rstrip('/')}/_batch={b}" for b in done]
    return (spark.read.schema(schema).parquet(*folders) if folders
            else spark.createDataFrame([], schema))


def path_columns(path: Column) -> dict[str, Column]:
    return {"product_group": group_from_path(path), "marketplace": marketplace_from_path(path)}
