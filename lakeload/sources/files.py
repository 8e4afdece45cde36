"""Listings of stored files, from file metadata alone; no content is read.

``file_listing`` is a data source whose partitions are prefixes: the driver looks at the names
right below the root, and each task walks one of them, folder by folder. So the driver holds
prefixes, not files.
"""

from __future__ import annotations

import posixpath
import re
import sys
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Tasks get the classes below as they are, as this package may not be on their machines.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"
# Names that one library has for stores that Spark names otherwise.
_STORES = {"s3a": "s3", "s3n": "s3", "gs": "gs", "hdfs": "hdfs", "file": "file"}
_BATCH = 10_000  # files a task hands on at a time
COLUMNS = "path string, key string, prefix string, length bigint, modificationTime timestamp"


class Prefix(InputPartition):
    """One task: the files below a folder or, with no name, those right in the root."""

    def __init__(self, name: str | None):
        self.name = name


def _store(root: str) -> tuple[fs.FileSystem, str]:
    scheme, _, rest = root.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{_STORES[scheme]}:{rest}")


def _plain(name: str) -> bool:
    return not name.startswith(("_", "."))


class ListingReader(DataSourceReader):
    def __init__(self, root: str, everything: bool):
        self.root, self.everything = root, everything

    def partitions(self):
        store, base = _store(self.root)
        found = store.get_file_info(fs.FileSelector(base, allow_not_found=False))
        names = [f.base_name for f in found if f.type == fs.FileType.Directory]
        return [Prefix(None), *[Prefix(n) for n in names if self.everything or _plain(n)]]

    def read(self, partition):
        store, base = _store(self.root)
        base = base.rstrip("/")
        folders, rows = [base if partition.name is None else f"{base}/{partition.name}"], []
        while folders:
            for found in store.get_file_info(fs.FileSelector(folders.pop(), allow_not_found=True)):
                if not (self.everything or _plain(found.base_name)):
                    continue
                if found.type == fs.FileType.Directory:
                    if partition.name is not None:
                        folders.append(found.path)
                elif found.type == fs.FileType.File and (found.size or self.everything):
                    key = found.path[len(base) + 1 :]
                    at = found.mtime or datetime.fromtimestamp(0, timezone.utc)
                    rows.append((f"{self.root.rstrip('/')}/{key}", key, partition.name, found.size, at))
                if len(rows) >= _BATCH:
                    yield self._batch(rows)
                    rows = []
        if rows:
            yield self._batch(rows)

    def _batch(self, rows):
        types = [pa.string()] * 3 + [pa.int64(), pa.timestamp("us", "UTC")]
        arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["path", "key", "prefix", "length", "modificationTime"])


class FileListing(DataSource):
    """``spark.read.format("file_listing").option("root", ...)``, and ``everything`` or not."""

    @classmethod
    def name(cls):
        return "file_listing"

    def schema(self):
        return COLUMNS

    def reader(self, schema):
        return ListingReader(self.options["root"], self.options.get("everything", "false") == "true")


def _qualified(spark: SparkSession, root: str) -> str:
    """The root as its file system names it: absolute, without ``.`` or ``..``."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    whole = store.makeQualified(path)
    parts = posixpath.normpath(whole.toUri().getPath())
    return store.makeQualified(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(whole, parts)).toString()


def list_files(spark: SparkSession, root: str, everything: bool = False) -> DataFrame:
    """Every file under ``root``: its key below the root, the key's first segment, size, time.

    ``prefix`` is null for a file that lies directly in the root. As Spark's file sources do,
    the listing leaves out files without content and names that start with ``_`` or ``.``, with
    what lies below such folders, unless ``everything`` is asked for. Stores that only Spark's
    own readers know, such as viewfs, are listed by Spark, whose driver then holds all files
    and which can't list everything.
    """
    root = _qualified(spark, root)
    if root.partition(":")[0] not in _STORES:
        if everything:
            raise ValueError(f"only Spark can list {root}, and it leaves out empty and hidden files")
        return _listed_by_spark(spark, root)
    spark.dataSource.register(FileListing)
    listing = spark.read.format("file_listing").option("root", root)
    return listing.option("everything", str(everything).lower()).load()


def _listed_by_spark(spark: SparkSession, root: str) -> DataFrame:
    base = re.sub(_SCHEME, "", root).rstrip("/") + "/"
    below = F.regexp_replace("path", _SCHEME, "")
    # Each file is a scan split of its own, so splits are grouped.
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", "length", "modificationTime")
        .coalesce(4 * spark.sparkContext.defaultParallelism)
    )
    key = F.substring(below, F.lit(len(base) + 1), F.length(below))
    prefix = F.when(F.col("key").contains("/"), F.substring_index("key", "/", 1))
    return files.withColumn("key", key).select("path", "key", prefix.alias("prefix"), "length", "modificationTime")


def list_prefixes(spark: SparkSession, root: str) -> DataFrame:
    """The distinct first path segments under ``root`` that hold files."""
    return list_files(spark, root).where("prefix IS NOT NULL").select("prefix").distinct()


def list_keys(spark: SparkSession, root: str, prefix: str) -> DataFrame:
    """The files under one prefix, with keys still relative to ``root``."""
    return list_files(spark, root).where(F.col("prefix") == prefix.rstrip("/"))


def prefix_sizes(spark: SparkSession, root: str) -> DataFrame:
    """File count and bytes for each prefix."""
    return (
        list_files(spark, root)
        .groupBy("prefix")
        .agg(F.count(F.lit(1)).alias("file_count"), F.sum("length").alias("total_bytes"))
    )
