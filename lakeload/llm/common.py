"""What several operators share: words, stored intermediate tables, components, ranks."""

from __future__ import annotations

import ctypes
import os
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeload import scratch

# Words end at a blank, tab, line feed, vertical tab, form feed or carriage return.
WORD = r"[^\x20\x09-\x0D]+"

# Rows of a few numbers that may be broadcast; beyond this a join shuffles.
BROADCAST_ROWS = 500_000

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, A-Z in lower case, the number of each word, and each text's bounds.

    Words are what stands between ASCII white space. The words of text i are the numbers
    from ``bounds[i]`` to ``bounds[i + 1]``. Nulls have none.
    """
    trimmed = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    split = pc.ascii_split_whitespace(trimmed)
    words = pc.greater(pc.binary_length(trimmed), 0).to_numpy(zero_copy_only=False)
    counts = np.where(words, pc.list_value_length(split).to_numpy(zero_copy_only=False), 0)
    flat = split.flatten()
    if not words.all():  # an empty text splits into one empty word
        flat = flat.filter(pc.greater(pc.binary_length(flat), 0))
    coded = flat.dictionary_encode()
    bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), bounds


# Texts that a task works on side by side, in bytes, unless one text has more.
SLICE_BYTES = 2 << 20


def text_slices(batches, column: int, most: int = SLICE_BYTES):
    """The rows of Arrow batches in slices of at most ``most`` bytes of one column.

    A longer text makes a slice of its own. Memory is given back as slices end and at the
    end of a task, as Python workers live on and would keep it.
    """
    give_back()
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < len(batch):
            before = ends[start - 1] if start else 0
            end = max(int(np.searchsorted(ends, before + most, side="right")), start + 1)
            yield batch.slice(start, end - start)
            pa.default_memory_pool().release_unused()
            start = end
        del batch, sizes, ends  # not kept while the next batch is read
    give_back()


# What empties the tables that operators keep in a Python worker from task to task.
kept_tables: list = []


def give_back() -> None:
    """Empty what other operators' tasks left in this Python worker, and return free memory."""
    for clear in kept_tables:
        clear()
    trim()


def trim() -> None:
    """Return this process's free memory to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library than glibc
        pass


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Rows go to this session's Python workers in Arrow batches of about ``SLICE_BYTES``.

    By default a batch has up to 10,000 rows and 64 MB, and the JVM and the worker
    hold two of them for each task. Results do not depend on it. It stays set, as stages are
    run by their caller; a bound that the session already has is kept.
    """
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, str(SLICE_BYTES))


_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application.

    They may run on other machines, or where the package is not on the path. The driver
    keeps the archive while it runs, for executors that start later.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        folder = _shipped[context.applicationId] = tempfile.TemporaryDirectory()
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        copy = os.path.join(folder.name, "copy", os.path.basename(package))
        shutil.copytree(package, copy, ignore=shutil.ignore_patterns("__pycache__"))
        context.addPyFile(shutil.make_archive(copy, "zip", os.path.dirname(copy), os.path.basename(copy)))


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Remove the shuffle files of what runs here as it ends, not when the driver collects garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def saved(frame: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read back, which cuts the lineage.

    Unlike cached blocks, the files outlive a lost executor. The rows are counted as they
    are written; ``row_count`` of the result has their number.
    """
    path = scratch.new_dir(frame.sparkSession, label)
    counted = Observation()
    with _shuffles_removed(frame.sparkSession):
        frame.observe(counted, F.count(F.lit(1)).alias("rows")).write.option("compression", "zstd").parquet(path)
    stored = frame.sparkSession.read.schema(frame.schema).parquet(path)
    stored.row_count = counted.get["rows"]
    stored.path = path
    return stored


def dropped(stored: DataFrame) -> None:
    """Delete what ``saved`` wrote, when nothing that is still to run reads it."""
    spark = stored.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(stored.path)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def unused(name: str, columns: list[str]) -> str:
    """The name, lengthened until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def word_count(text: Column | str) -> Column:
    """Words in a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def small(frame: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether the rows are so few that they may be broadcast; reads no more than that."""
    known = getattr(frame, "row_count", None)
    if known is not None:
        return known <= limit
    return frame.limit(limit + 1).count() <= limit


def maybe_broadcast(frame: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    return F.broadcast(frame) if small(frame, limit) else frame


def join_groups(
    rows: DataFrame, groups: DataFrame, key: str | list[str], size: str, total: int, how: str = "inner"
) -> DataFrame:
    """Join rows to one-row-a-group facts, where a few groups may hold most rows.

    A group of a thousandth of all rows or more is one of at most a thousand, so those
    are broadcast whatever the input's size. The others shuffle, and none of them can
    fill a partition. ``how`` is inner, or left to keep the rows without a group.
    """
    least = max(total // 1000, 1)
    hot = F.broadcast(groups.where(F.col(size) >= least))
    rest = groups.where(F.col(size) < least)
    in_hot = rows.join(hot, key)
    others = rows.join(hot.select(key), key, "left_anti")
    return in_hot.unionByName(others.join(rest, key, how))


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(id, component) for every id in ``edges`` (a, b): the smallest id it can reach.

    Each round takes the smallest label among the neighbours, then the label of that
    label, so long chains halve. All rounds are joins and aggregates with partial sums.
    """
    both = saved(
        edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select("b", "a")).distinct(),
        label,
    )
    labels = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component"))
    labels = labels.select("id", F.least("id", "component").alias("component"))
    if not both.row_count:
        return labels
    labels = saved(labels, label)
    while True:
        near = (
            both.join(labels, F.col("b") == F.col("id"))
            .groupBy(F.col("a").alias("near_id"))
            .agg(F.min("component").alias("near"))
        )
        hooked = labels.join(near, F.col("id") == F.col("near_id"), "left").select(
            "id",
            F.col("component").alias("before"),
            F.least("component", "near").alias("component"),
        )
        parents = labels.select(F.col("id").alias("parent"), F.col("component").alias("above"))
        after = hooked.join(parents, F.col("component") == F.col("parent"), "left").select(
            "id", "before", F.coalesce("above", "component").alias("component")
        )
        changes = Observation()
        after = after.observe(changes, F.count_if(F.col("component") != F.col("before")).alias("changed"))
        labels = saved(after.select("id", "component"), label)
        if not changes.get["changed"]:
            return labels


def ranked(
    rows: DataFrame, parts: list[str], buckets: list[str], order: list[str], name: str = "rank"
) -> DataFrame:
    """Add the position of each row, from 0, in its part, by buckets and then by order.

    Only the counts of the buckets are summed in order; rows are numbered inside their
    bucket, so no task sorts a whole part. Buckets should hold some thousand rows.
    """
    counts = rows.groupBy(*parts, *buckets).agg(F.count(F.lit(1)).alias("_count"))
    before = Window.partitionBy(*parts) if parts else Window.partitionBy(F.lit(0))
    before = before.orderBy(*buckets).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *parts, *buckets, F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_start")
    )
    inside = F.row_number().over(Window.partitionBy(*parts, *buckets).orderBy(*order))
    numbered = rows.withColumn("_inside", inside)
    return (
        numbered.join(starts, [*parts, *buckets])
        .withColumn(name, F.col("_start") + F.col("_inside") - 1)
        .drop("_start", "_inside")
    )
