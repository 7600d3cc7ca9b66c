"""A keyed table of Parquet files in buckets, of which a merge rewrites only those it touches.

A row's bucket is the hash of its key. A version file lists the folder of each bucket; the
highest version is the table. A merge writes new folders for the buckets that its rows fall into and
then a new version file, so that a failed job leaves the table as it was, a reader keeps the files
it began with, and of two writers at once the second one fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plugwatch.operators.upsert import merge_rows, one_per_key
from plugwatch.session import stored

BUCKET = "_bucket"


class BucketTable:
    """The table below ``root``: see :meth:`create`."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._fs = self._hadoop.Path(self.root).getFileSystem(
            spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, *parts: str):
        return self._hadoop.Path("/".join([self.root, *parts]))

    def versions(self) -> list[int]:
        folder = self._path("versions")
        if not self._fs.exists(folder):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        """What a version (the highest one) consists of: schema, keys, number of buckets, and the
        folder of each bucket that has rows."""
        known = self.versions()
        if not known:
            raise ValueError(f"no table at {self.root}")
        path = self._path("versions", f"{known[-1] if version is None else version:010d}.json")
        text = self.spark.read.text(path.toString(), wholetext=True).first()[0]
        return json.loads(text)

    def _commit(self, version: int, manifest: dict) -> None:
        """The version file appears whole or not at all, and only if there is none of its number."""
        draft = self._path("versions", f".{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        final = self._path("versions", f"{version:010d}.json")
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            self._fs.delete(draft, False)
            raise RuntimeError(f"another writer has made version {version}")

    def _write(self, rows: DataFrame, buckets: Iterable[int]) -> dict[str, str]:
        """New folders for the buckets, each written by one task: keys are unique, so their hash
        makes buckets even."""
        found, folder = sorted(buckets), f"data-{uuid.uuid4().hex}"
        if found:
            rows.repartition(len(found), BUCKET).write.partitionBy(BUCKET).parquet(
                f"{self.root}/{folder}")
        return {str(b): f"{folder}/{BUCKET}={b}" for b in found}

    def create(self, df: DataFrame, keys: list[str], buckets: int,
               order: Iterable[str] = ()) -> None:
        """Version 0, of ``df`` with one row per key: the largest by ``order``. Choose ``buckets``
        so that one bucket is a task's work."""
        if self.versions():
            raise ValueError(f"there is a table at {self.root}")
        rows = stored(self._dealt(one_per_key(df, keys, list(order)), keys, buckets))
        used = [r[0] for r in rows.select(BUCKET).distinct().collect()]
        self._commit(0, {"schema": df.schema.json(), "keys": keys, "buckets": buckets,
                         "folders": self._write(rows, used)})

    @staticmethod
    def _dealt(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)))

    def _folders(self, manifest: dict, folders: Iterable[str]) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(manifest["schema"]))
        paths = [f"{self.root}/{f}" for f in folders]
        return (self.spark.read.schema(schema).parquet(*paths) if paths
                else self.spark.createDataFrame([], schema))

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of a version, the highest one if none is given."""
        manifest = self.manifest(version)
        return self._folders(manifest, manifest["folders"].values())

    def upsert(self, source: DataFrame, order: Iterable[str] = ()) -> list[int]:
        """Rows of ``source`` replace or extend the table's; of source rows with the same key the
        largest by ``order`` counts. Gives the buckets that were rewritten; the files of the
        others are neither read nor written. Key types must be those of the table."""
        version = self.versions()[-1]
        manifest = self.manifest(version)
        keys, folders = manifest["keys"], manifest["folders"]
        columns = T.StructType.fromJson(json.loads(manifest["schema"])).fieldNames()
        new = stored(self._dealt(
            one_per_key(source.select(*columns), keys, list(order)), keys, manifest["buckets"]))
        touched = sorted(r[0] for r in new.select(BUCKET).distinct().collect())
        old = self._folders(manifest, [folders[str(b)] for b in touched if str(b) in folders])
        rows = merge_rows(self._dealt(old, keys, manifest["buckets"]), new, keys)
        self._commit(version + 1, {**manifest, "folders": {**folders, **self._write(rows, touched)}})
        return touched

    def vacuum(self, keep: int = 2) -> int:
        """Delete the version files but the last ``keep``, and the folders that none of those names.
        Gives the number of folders deleted. Not while a merge runs."""
        known = self.versions()
        used = {f for v in known[-keep:] for f in self.manifest(v)["folders"].values()}
        gone = {f for v in known[:-keep] for f in self.manifest(v)["folders"].values()} - used
        for v in known[:-keep]:
            self._fs.delete(self._path("versions", f"{v:010d}.json"), False)
        for folder in gone:
            self._fs.delete(self._path(folder), True)
        return len(gone)
