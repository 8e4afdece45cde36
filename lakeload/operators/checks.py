"""Checks on a load: nulls, partitions, and table against source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeload.functions.columns import digest_sums, hash_parts, row_hash
from lakeload.operators.catalog import literal

# Rows are compared in this many groups. Each task shuffles at most one summary row for
# each group, so more groups cost more where the sides agree; fewer groups cost more where
# they do not, as all rows of a differing group are shuffled.
NESTED = (T.ArrayType, T.MapType, T.StructType)
BUCKETS = 1024


class NullsFound(RuntimeError):
    """Columns declared non-null hold nulls."""


class SchemaMismatch(ValueError):
    """Two frames to compare differ in column names or types."""


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, null_count) for the given columns, in one pass over them only.

    Written as a difference of counts because parquet and orc answer both counts from
    file footers when aggregate push-down is on.
    """
    if not columns:
        return df.sparkSession.createDataFrame([], "column_name string, null_count bigint")
    rows = F.count(F.lit(1))
    return df.agg(*[(rows - F.count(f"`{c}`")).alias(c) for c in columns]).unpivot(
        [], [f"`{c}`" for c in columns], "column_name", "null_count"
    )


def require_not_null(df: DataFrame, columns: Sequence[str]) -> None:
    if found := null_counts(df, columns).where("null_count > 0").collect():
        raise NullsFound(", ".join(f"{r.column_name}: {r.null_count}" for r in found))


def table_digest(df: DataFrame) -> tuple[int, str]:
    """Row count and digest of a frame, comparable with what a load observed."""
    sums = digest_sums(df.columns)
    row = df.agg(F.count(F.lit(1)), *sums).head()
    return row[0], digest_text(row[1:])


def digest_text(sums: Sequence[int | None]) -> str:
    return ":".join(str(s or 0) for s in sums)


def partition_count(scan: DataFrame) -> int:
    """Number of input splits. For scans: over a shuffle this would run the stages before it."""
    return scan.rdd.getNumPartitions()


def partition_profile(df: DataFrame) -> DataFrame:
    """Rows in each input partition."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


def column_profile(df: DataFrame, table_name: str) -> DataFrame:
    """One row for each column: position, type, rows, nulls, least and greatest value."""
    stats = [
        F.expr(
            f"named_struct('table_name', {literal(table_name)}, 'position', {position},"
            f" 'column_name', {literal(f.name)}, 'data_type', '{f.dataType.simpleString()}',"
            f" 'row_count', count(1), 'null_count', count(1) - count(`{f.name}`),"
            f" 'min_value', CAST(min(`{f.name}`) AS string),"
            f" 'max_value', CAST(max(`{f.name}`) AS string))"
        )
        for position, f in enumerate(df.schema, 1)
    ]
    return df.agg(F.array(*stats).alias("stats")).select(F.inline("stats"))


def _sided(source: DataFrame, table: DataFrame) -> DataFrame:
    """Both sides' rows in one frame, ``_side`` +1 for source rows and -1 for table rows."""
    want = [(f.name, f.dataType) for f in source.schema]
    if want != [(f.name, f.dataType) for f in table.schema]:
        raise SchemaMismatch("source and table differ in column names or types")
    return source.withColumn("_side", F.lit(1)).unionAll(table.withColumn("_side", F.lit(-1)))


def _copies(source: DataFrame, table: DataFrame) -> DataFrame:
    """Each distinct row with the copies each side holds.

    One grouping of both sides together, half the shuffles of ``exceptAll`` both ways.
    Equal rows merge before the shuffle, so a row repeated very often stays small.
    """
    columns = [f"`{c}`" for c in source.columns]
    return (
        _sided(source, table)
        .groupBy(*columns)
        .agg(
            F.count_if(F.col("_side") > 0).alias("source_copies"),
            F.count_if(F.col("_side") < 0).alias("table_copies"),
        )
    )


def row_differences(source: DataFrame, table: DataFrame) -> DataFrame:
    """The rows that source and table hold in different numbers, with both numbers."""
    return _copies(source, table).where("source_copies <> table_copies")


def _compare_rows(source: DataFrame, table: DataFrame) -> Row:
    surplus = F.col("source_copies") - F.col("table_copies")
    totals = {
        "source_rows": F.sum("source_copies"),
        "table_rows": F.sum("table_copies"),
        "missing": F.sum(F.when(surplus > 0, surplus)),
        "extra": F.sum(F.when(surplus < 0, -surplus)),
    }
    return (
        _copies(source, table)
        .agg(*[F.coalesce(total, F.lit(0)).alias(name) for name, total in totals.items()])
        .head()
    )


def reconcile(
    source: DataFrame, table: DataFrame, table_name: str, exact: bool = False
) -> DataFrame:
    """(table_name, source_rows, table_rows, missing, extra): is the table what the source holds?

    Rows are compared as multisets. First every task reduces its rows to a count and hash
    sums for each of ``BUCKETS`` groups, so only those summaries are shuffled and a load
    that went well costs one read of each side. Rows move only for the groups that differ.
    Two groups that differ pass for equal with a chance below 2^-100; ``exact`` leaves
    nothing to chance and compares all rows. Hashes skip nulls inside arrays, maps and
    structs, so tables with such columns are always compared exactly.
    """
    exact = exact or any(isinstance(f.dataType, NESTED) for f in source.schema)
    find = _compare_rows if exact else _compare_groups
    found = find(source, table)
    return comparison(
        source.sparkSession,
        table_name,
        found["source_rows"],
        found["table_rows"],
        found["missing"],
        found["extra"],
    )


def comparison(
    spark: SparkSession,
    table_name: str,
    source_rows: int,
    table_rows: int,
    missing: int,
    extra: int,
) -> DataFrame:
    """The one-row result of a reconciliation."""
    counts = {
        "source_rows": source_rows,
        "table_rows": table_rows,
        "missing": missing,
        "extra": extra,
    }
    return spark.range(0, 1, 1, 1).select(
        F.lit(table_name).alias("table_name"),
        *[F.lit(n).cast("bigint").alias(name) for name, n in counts.items()],
    )


def _compare_groups(source: DataFrame, table: DataFrame) -> dict[str, int]:
    columns = source.columns
    bucket = F.pmod(row_hash(columns), F.lit(BUCKETS))
    sums = {f"_sum{i}": p for i, p in enumerate(hash_parts(F.col("_a")) + hash_parts(F.col("_b")))}
    parts = list(sums)
    summary = (
        _sided(source, table)
        .select(
            "_side",
            bucket.alias("_bucket"),
            row_hash(columns, 1).alias("_a"),
            row_hash(columns, 2).alias("_b"),
        )
        .select("_side", "_bucket", *[part.alias(name) for name, part in sums.items()])
        .groupBy("_bucket")
        .agg(
            F.count_if(F.col("_side") > 0).alias("source_rows"),
            F.count_if(F.col("_side") < 0).alias("table_rows"),
            *[F.sum(F.col("_side") * F.col(p)).alias(p) for p in parts],
        )
        .collect()
    )
    differing = [
        r for r in summary if r.source_rows != r.table_rows or any(r[p] for p in parts)
    ]
    # A group that only one side has needs no comparison.
    missing = sum(r.source_rows for r in differing if not r.table_rows)
    extra = sum(r.table_rows for r in differing if not r.source_rows)
    mixed = [r._bucket for r in differing if r.source_rows and r.table_rows]
    if mixed:
        found = _compare_rows(
            source.where(bucket.isin(mixed)), table.where(bucket.isin(mixed))
        )
        missing, extra = missing + found.missing, extra + found.extra
    return {
        "source_rows": sum(r.source_rows for r in summary),
        "table_rows": sum(r.table_rows for r in summary),
        "missing": missing,
        "extra": extra,
    }
