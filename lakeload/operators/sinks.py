"""Writing tables. The format is a parameter throughout.

Every write is the scan's own tasks writing their rows: no shuffle, one output file
for each input split.
"""

from __future__ import annotations

import posixpath
import re
import uuid
from collections.abc import Mapping

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from lakeload.operators.catalog import literal, quoted, temp_view

FILE_FORMATS = ("parquet", "orc", "avro")
TABLE_FORMATS = ("iceberg", "delta")  # these replace a table in one commit


class FormatUnavailable(RuntimeError):
    """The format needs a module that is not on the class path."""


def require_format(spark: SparkSession, fmt: str) -> None:
    """Fail before any data moves if the format's module is missing."""
    if fmt not in FILE_FORMATS + TABLE_FORMATS:
        raise ValueError(f"unknown format {fmt!r}")
    if fmt in ("parquet", "orc"):
        return
    try:
        spark.read.format(fmt).load([])
    except Exception as error:
        missing = ("Failed to find data source", "DATA_SOURCE_NOT_FOUND")
        if any(m in str(error) for m in missing):
            raise FormatUnavailable(f"format {fmt!r} needs its module on the class path") from error


def create_table_sql(
    name: str,
    fmt: str,
    view: str | None = None,
    options: Mapping[str, str] | None = None,
    location: str | None = None,
    replace: bool = False,
) -> str:
    """``CREATE TABLE`` text: from a view's rows, or over files that exist."""
    clauses = [f"CREATE {'OR REPLACE ' if replace else ''}TABLE {quoted(name)} USING {fmt}"]
    if options:
        pairs = ", ".join(f"{literal(k)} = {literal(str(v))}" for k, v in options.items())
        clauses.append(f"OPTIONS ({pairs})")
    if location:
        clauses.append(f"LOCATION {literal(location)}")
    if view:
        clauses.append(f"AS SELECT * FROM {quoted(view)}")
    return " ".join(clauses)


def create_as_select(
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    location: str | None = None,
    replace: bool = False,
) -> None:
    """Create a table from a frame's rows; with a location, at that path.

    ``replace`` is for formats that commit a replacement in one step.
    """
    with temp_view(df) as view:
        df.sparkSession.sql(create_table_sql(name, fmt, view, options, location, replace))


def location_taken(error: PySparkException) -> bool:
    """Whether a create failed because files lie where the table would go."""
    return error.getCondition() == "LOCATION_ALREADY_EXISTS"


def write_path(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    refresh: str | None = None,
    mode: str = "overwrite",
) -> None:
    """Overwrite a path with a frame's rows; refresh the table registered over it, if any."""
    df.write.format(fmt).options(**(options or {})).mode(mode).save(path)
    if refresh and df.sparkSession.catalog.tableExists(quoted(refresh)):
        df.sparkSession.catalog.refreshTable(quoted(refresh))


def register_external(
    spark: SparkSession,
    name: str,
    path: str,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> None:
    """A catalog entry over files that exist; the schema comes from them."""
    spark.sql(create_table_sql(name, fmt, options=options, location=path))


def location_of(spark: SparkSession, name: str) -> str:
    """Where a registered table's files lie."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)}")
    return rows.where("col_name = 'Location'").select("data_type").head()[0]


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a directory that the loader itself made."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def create_if_missing(spark: SparkSession, name: str, columns: str, fmt: str = "parquet") -> None:
    """An empty typed table; nothing happens if the name is taken."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(name)} ({columns}) USING {fmt}")


def version_path(root: str, table: str) -> str:
    return posixpath.join(root, f"{table}-{uuid.uuid4().hex[:12]}")


def made_by_loads(path: str, root: str, table: str) -> bool:
    """Whether the loader made this directory: a table's own, or a version, in ``root``."""
    bare = [re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", p).rstrip("/") for p in (path, root)]
    folder, _, last = bare[0].rpartition("/")
    return folder == bare[1] and bool(re.fullmatch(re.escape(table) + "(-[0-9a-f]{12})?", last))


def point_table_at(
    spark: SparkSession,
    name: str,
    path: str,
    fmt: str,
    options: Mapping[str, str] | None = None,
) -> None:
    """Point a name at newly written files.

    Plain files have no commit of their own, so a replacement is written to a new
    directory first and the name moves after it is whole. With the same columns the entry
    stays, with its type and options, and only its location changes. Else the new files
    are registered under another name first, which then takes the old one's place. The
    directory that a load made before, beside the new one, is removed; other files stay.
    """
    table = name.rsplit(".", 1)[-1]
    if not spark.catalog.tableExists(quoted(name)):
        register_external(spark, name, path, fmt, options)
        return
    before = location_of(spark, name)
    columns = [(f.name, f.dataType) for f in spark.read.format(fmt).load(path).schema]
    if columns == [(f.name, f.dataType) for f in spark.table(quoted(name)).schema]:
        spark.sql(f"ALTER TABLE {quoted(name)} SET LOCATION {literal(path)}")
        spark.catalog.refreshTable(quoted(name))
    else:
        new = f"{name}__{uuid.uuid4().hex[:8]}"
        register_external(spark, new, path, fmt, options)
        spark.sql(f"DROP TABLE {quoted(name)}")
        spark.sql(f"ALTER TABLE {quoted(new)} RENAME TO {quoted(name)}")
    if made_by_loads(before, path.rstrip("/").rpartition("/")[0], table):
        remove_path(spark, before)


def insert_rows(df: DataFrame, name: str) -> None:
    """Append rows to a table whose columns are in the same order."""
    df.write.insertInto(quoted(name))
