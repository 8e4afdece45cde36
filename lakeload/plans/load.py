"""Load one table or all of them, with a result for each.

A load is one pass: scan, parse, write. Row, reject and null counts are observed on the
rows as they are written. They are taken in the write's own tasks, whose metrics Spark
counts once for each partition, however often a lost executor makes it run again.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import AbstractContextManager, contextmanager, nullcontext
from dataclasses import asdict, dataclass
from datetime import datetime, timezone
from functools import reduce
from operator import add

from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeload.functions.columns import digest_sums
from lakeload.operators import fit, sinks, sketch
from lakeload.operators.catalog import create_namespace, namespace_location, quoted, read_table
from lakeload.operators.checks import (
    comparison,
    digest_text,
    partition_count,
    reconcile,
    table_digest,
)
from lakeload.plans.schemas import declared_not_null
from lakeload.plans.spec import LoadSpec
from lakeload.sources import delimited

RESULT_COLUMNS = (
    "table_name string, row_count bigint, rejected bigint, null_violations bigint,"
    " partitions int, seconds double, status string, error string, finished_at timestamp,"
    " digest string"
)


class TableExists(RuntimeError):
    """The target name is taken and the spec says to fail."""


class BadRows(RuntimeError):
    """The source breaks the declared schema and the spec says to fail."""


@dataclass(frozen=True)
class LoadResult:
    """One audit row; status is ``ok``, ``skipped`` or ``failed``."""

    table_name: str
    row_count: int | None = None
    rejected: int | None = None
    null_violations: int | None = None
    partitions: int | None = None
    seconds: float | None = None
    status: str = "ok"
    error: str | None = None
    finished_at: datetime | None = None
    digest: str | None = None


class LoadFailed(RuntimeError):
    """Some tables did not load; ``results`` has all of them."""

    def __init__(self, results: list[LoadResult]):
        self.results = results
        failed = [r for r in results if r.status == "failed"]
        super().__init__("; ".join(f"{r.table_name}: {r.error}" for r in failed))


def audit_frame(spark: SparkSession, results: list[LoadResult]) -> DataFrame:
    """The results as rows, one for each table loaded."""
    return spark.createDataFrame([tuple(asdict(r).values()) for r in results], RESULT_COLUMNS)


_splitting = threading.Lock()


@contextmanager
def _split_size(spark: SparkSession, split_bytes: int | None) -> Iterator[None]:
    """Cut scans into splits of this size, whatever the number of cores."""
    if split_bytes is None:
        yield
        return
    wanted = {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.files.minPartitionNum": "1",
    }
    # One load at a time, so that each puts back what was set before it.
    with _splitting:
        before = {key: spark.conf.get(key, None) for key in wanted}
        for key, value in wanted.items():
            spark.conf.set(key, value)
        try:
            yield
        finally:
            for key, value in before.items():
                spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def source_frame(spark: SparkSession, table: str, spec: LoadSpec) -> DataFrame:
    """The rows a load of this table writes."""
    path, schema = spec.source_path(table), spec.registry[table]
    if spec.malformed == "null":
        return delimited.scan(spark, path, schema, spec.layout)
    return delimited.well_formed(delimited.parse(spark, path, schema, spec.layout))


def source_fit(spark: SparkSession, table: str, spec: LoadSpec) -> DataFrame:
    """For each declared column, the narrowest type of its values and whether the declared one holds them.

    Reads the text as it is, so values that a load would turn to null, such as keys beyond 32
    bits, are seen before it. Lines with too few fields count as null there; fields beyond the
    declared ones are not seen, ``malformed`` is for those.
    """
    schema = spec.registry[table]
    text = T.StructType([T.StructField(c, T.StringType()) for c in schema.names])
    return fit.type_fit(delimited.scan(spark, spec.source_path(table), text, spec.layout), schema)


def _observed(spark: SparkSession, table: str, spec: LoadSpec):
    """The rows to write, the observation filled as they are written, and the input splits."""
    path, schema = spec.source_path(table), spec.registry[table]
    observation = Observation(f"{table}-{uuid.uuid4().hex}")
    if spec.malformed == "null":
        rows = delimited.scan(spark, path, schema, spec.layout)
        kept = None
        metrics = {"rows": F.count(F.lit(1))}
    else:
        rows = delimited.parse(spark, path, schema, spec.layout)
        kept = ~F.col(delimited.MALFORMED)
        metrics = {"rows": F.count_if(kept), "rejected": F.count_if(~kept)}
    nulls = [F.col(f"`{c}`").isNull() for c in declared_not_null(schema)]
    if kept is not None:
        nulls = [kept & is_null for is_null in nulls]
    if nulls:
        metrics["nulls"] = reduce(add, map(F.count_if, nulls))
    if spec.digest:
        metrics |= {f"digest{i}": d for i, d in enumerate(digest_sums(schema.names, kept))}
    observed = rows.observe(observation, *[m.alias(name) for name, m in metrics.items()])
    return observed if kept is None else delimited.well_formed(observed), observation, rows


def _check(spec: LoadSpec, counts: dict) -> None:
    if spec.malformed == "fail" and counts["rejected"]:
        raise BadRows(f"{counts['rejected']} lines do not fit the schema")
    if spec.nulls == "fail" and counts.get("nulls"):
        raise BadRows(f"{counts['nulls']} nulls in columns declared non-null")


def _write(spark: SparkSession, table: str, spec: LoadSpec, exists: bool) -> dict:
    """Write and register one table; returns the observed counts."""
    name = spec.table_name(table)
    rows, observation, scan = _observed(spark, table, spec)
    partitions = partition_count(scan)
    one_commit = spec.format in sinks.TABLE_FORMATS

    def write_version(root: str, path: str | None = None) -> None:
        path = path or sinks.version_path(root, table)
        # Files that no entry names are not ours to overwrite.
        sinks.write_path(rows, path, spec.format, spec.options, mode="error")
        try:
            _check(spec, observation.get)
            sinks.point_table_at(spark, name, path, spec.format, spec.options)
        except Exception:
            sinks.remove_path(spark, path)
            raise

    if spec.mode == "external" and not one_commit:
        root = spec.external_root()
        first = f"{root}/{table}"
        write_version(root, None if exists or sinks.path_exists(spark, first) else first)
    elif spec.mode == "external":
        path = sinks.location_of(spark, name) if exists else f"{spec.external_root()}/{table}"
        sinks.write_path(
            rows, path, spec.format, spec.options, name, "overwrite" if exists else "error"
        )
        _check(spec, observation.get)
        if not exists:
            sinks.register_external(spark, name, path, spec.format)
    elif exists and not one_commit:
        write_version(namespace_location(spark, spec.namespace))
    else:
        try:
            sinks.create_as_select(rows, name, spec.format, spec.options, replace=exists)
        except PySparkException as error:
            if one_commit or not sinks.location_taken(error):
                raise
            # An interrupted load left files there. They are not ours to remove.
            write_version(namespace_location(spark, spec.namespace))
        try:
            _check(spec, observation.get)
        except BadRows:
            if not exists:
                spark.sql(f"DROP TABLE {quoted(name)}")
            raise

    counts = observation.get
    if spec.malformed != "reject" and exists and spec.rejects_name(table).rsplit(".", 1)[-1] not in spec.registry:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(spec.rejects_name(table))}")
    if spec.malformed == "reject":
        _write_rejects(spark, table, spec, counts["rejected"])
    return {**counts, "partitions": partitions}


def _write_rejects(spark: SparkSession, table: str, spec: LoadSpec, rejected: int) -> None:
    """Keep the raw lines. They are read again, but only if the load saw any."""
    name = spec.rejects_name(table)
    spark.sql(f"DROP TABLE IF EXISTS {quoted(name)}")
    if rejected:
        parsed = delimited.parse(
            spark, spec.source_path(table), spec.registry[table], spec.layout
        )
        path = sinks.version_path(namespace_location(spark, spec.namespace), f"{table}__rejects")
        if spec.format in sinks.TABLE_FORMATS:
            path = None  # such formats keep their own files
        sinks.create_as_select(delimited.rejects(parsed), name, spec.format, spec.options, path)


def _load(
    spark: SparkSession,
    table: str,
    spec: LoadSpec,
    landed: Callable[[str], AbstractContextManager] = nullcontext,
) -> LoadResult:
    start = time.monotonic()

    def result(**values) -> LoadResult:
        return LoadResult(
            table_name=table,
            seconds=round(time.monotonic() - start, 3),
            finished_at=datetime.now(timezone.utc),
            **values,
        )

    try:
        exists = spark.catalog.tableExists(quoted(spec.table_name(table)))
        if exists and spec.if_exists == "skip":
            return result(status="skipped")
        if exists and spec.if_exists == "fail":
            raise TableExists(spec.table_name(table))
        with landed(table):
            counts = _write(spark, table, spec, exists)
    except Exception as error:  # one table's failure must not stop the others
        return result(status="failed", error=f"{type(error).__name__}: {error}")
    return result(
        row_count=counts["rows"],
        rejected=counts.get("rejected", 0),
        null_violations=counts.get("nulls", 0),
        partitions=counts["partitions"],
        digest=digest_text([v for k, v in counts.items() if k.startswith("digest")])
        if spec.digest
        else None,
    )


def side_by_side(spark: SparkSession, job: Callable, items: Iterable, width: int) -> list:
    """Run a Spark job for each item from a few driver threads; results in the items' order.

    Spark fills the slots one job's last tasks leave free with the next job's tasks.
    """
    # Each item gets a copy of this thread's local properties. Spark keeps its execution ids
    # there, so jobs with one copy between them would run under each other's ids.
    jobs = [(inheritable_thread_target(spark)(job), item) for item in items]
    with ThreadPoolExecutor(width) as pool:
        futures = [pool.submit(run, item) for run, item in jobs]
        return [future.result() for future in futures]


def source_bytes(spark: SparkSession, path: str) -> int:
    """Bytes below a path, 0 if there is none."""
    jvm = spark.sparkContext._jvm
    source = jvm.org.apache.hadoop.fs.Path(path)
    store = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store.getContentSummary(source).getLength() if store.exists(source) else 0


def load_all(
    spark: SparkSession,
    spec: LoadSpec,
    tables: Iterable[str] | None = None,
    landed: Callable[[str], AbstractContextManager] = nullcontext,
) -> list[LoadResult]:
    """Load the named tables, or all of the registry's, several at a time.

    Every table is tried. The results are appended to the spec's audit table, if it names
    one, before ``LoadFailed`` is raised for tables that failed.

    ``landed`` gives, for a table's name, a context that its load runs in, for text that is not
    to stay: written as the load begins and removed as it ends. What such text takes is then
    that of the tables loading side by side. They start in the order named, and their seconds
    include the writing.
    """
    names = list(spec.registry if tables is None else tables)
    for table in names:
        spec.registry[table]
    sinks.require_format(spark, spec.format)
    create_namespace(spark, spec.namespace, spec.namespace_location)
    with _split_size(spark, spec.split_bytes):
        # The largest first, so that small ones fill the slots their last tasks leave free.
        order = sorted(names, key=lambda table: -source_bytes(spark, spec.source_path(table)))
        loaded = side_by_side(
            spark, lambda table: _load(spark, table, spec, landed), order, spec.parallel_tables
        )
    by_name = dict(zip(order, loaded, strict=True))
    results = [by_name[table] for table in names]
    if spec.audit_table:
        sinks.create_if_missing(spark, spec.audit_table, RESULT_COLUMNS)
        sinks.insert_rows(audit_frame(spark, results).coalesce(1), spec.audit_table)
    if any(r.status == "failed" for r in results):
        raise LoadFailed(results)
    return results


def load_table(spark: SparkSession, table: str, spec: LoadSpec) -> LoadResult:
    return load_all(spark, spec, [table])[0]


def reconcile_load(
    spark: SparkSession,
    table: str,
    spec: LoadSpec,
    exact: bool = False,
    result: LoadResult | None = None,
) -> DataFrame:
    """Compare a loaded table with its source files.

    Given the load's result with a digest, the source text is only read again if the
    table's own digest is another.
    """
    loaded = read_table(spark, spec.table_name(table))
    if result and result.digest and not exact:
        rows, digest = table_digest(loaded)
        if (rows, digest) == (result.row_count, result.digest):
            return comparison(spark, table, rows, rows, 0, 0)
    return reconcile(source_frame(spark, table, spec), loaded, table, exact)


def keep_sketch(spark: SparkSession, table: str, spec: LoadSpec, result: LoadResult) -> str:
    """Store a sketch of the source beside its loaded table; returns the sketch's name.

    The table is read in place of the text: its digest must be the one the load observed as
    it parsed the source, so both hold the same rows and have the same sketch.
    """
    loaded = read_table(spark, spec.table_name(table))
    if not result.digest or table_digest(loaded) != (result.row_count, result.digest):
        raise BadRows(f"{table} is not what its load observed, or no digest was observed")
    name = spec.sketch_name(table)
    spark.sql(f"DROP TABLE IF EXISTS {quoted(name)}")
    path = sinks.version_path(namespace_location(spark, spec.namespace), f"{table}__sketch")
    path = None if spec.format in sinks.TABLE_FORMATS else path
    sinks.create_as_select(sketch.sketch(loaded).coalesce(1), name, spec.format, spec.options, path)
    return name


def sketch_differences(spark: SparkSession, table: str, spec: LoadSpec) -> sketch.Differences | None:
    """The rows by which a table has come to differ from its source, as hashes; None if too many."""
    kept = read_table(spark, spec.sketch_name(table)).collect()
    now = sketch.sketch(read_table(spark, spec.table_name(table))).collect()
    return sketch.decode(kept, now)


def reconcile_sketch(spark: SparkSession, table: str, spec: LoadSpec) -> DataFrame:
    """``reconcile_load`` from the stored sketch: the table is read once, the text not at all.

    Differences too many to come out of the sketch are counted from the text.
    """
    kept = read_table(spark, spec.sketch_name(table)).collect()
    now = sketch.sketch(read_table(spark, spec.table_name(table))).collect()
    found = sketch.decode(kept, now)
    if found is None:
        return reconcile_load(spark, table, spec)
    totals = [sketch.row_total(cells) for cells in (kept, now)]
    return comparison(spark, table, *totals, found.missing, found.extra)


def reconcile_all(
    spark: SparkSession,
    spec: LoadSpec,
    tables: Iterable[str] | None = None,
    exact: bool = False,
    results: Iterable[LoadResult] = (),
) -> DataFrame:
    """``reconcile_load`` for the named tables, or all of the registry's, as one frame."""
    names = list(spec.registry if tables is None else tables)
    of = {r.table_name: r for r in results}
    with _split_size(spark, spec.split_bytes):
        frames = side_by_side(
            spark,
            lambda table: reconcile_load(spark, table, spec, exact, of.get(table)),
            names,
            spec.parallel_tables,
        )
    return reduce(DataFrame.unionAll, frames)
