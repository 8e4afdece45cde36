"""Names: namespaces, tables and views."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """Backtick each part of a dotted name."""
    return ".".join(f"`{part}`" for part in name.replace("`", "").split("."))


def literal(text: str) -> str:
    """A SQL string literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def create_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    at = f" LOCATION {literal(location)}" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {quoted(namespace)}{at}")


def namespace_location(spark: SparkSession, namespace: str) -> str:
    rows = spark.sql(f"DESCRIBE NAMESPACE {quoted(namespace)}")
    return rows.where("info_name = 'Location'").head()["info_value"].rstrip("/")


def list_tables(spark: SparkSession, namespace: str) -> DataFrame:
    """The stored tables of a namespace; ``SHOW TABLES`` lists session views as well."""
    return (
        spark.sql(f"SHOW TABLES IN {quoted(namespace)}")
        .where(~F.col("isTemporary"))
        .select("tableName")
    )


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(quoted(name))


def show_rows(spark: SparkSession, name: str, count: int = 20, order_by: str | None = None):
    """The first rows of a table, as ``show()`` would print; in a fixed order if asked."""
    rows = read_table(spark, name)
    return (rows.orderBy(order_by) if order_by else rows).limit(count)


@contextmanager
def temp_view(df: DataFrame) -> Iterator[str]:
    """A view name of its own, so that loads running side by side do not replace each other's."""
    name = f"load_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(name)
    try:
        yield name
    finally:
        df.sparkSession.catalog.dropTempView(name)
