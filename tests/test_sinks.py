import glob

import pytest
from pyspark.errors import AnalysisException

from lakeload.operators import catalog, sinks


@pytest.fixture
def rows(spark):
    return spark.range(100).selectExpr("id", "CAST(id AS decimal(7,2)) AS price", "'x' AS name")


def same(a, b):
    return a.dtypes == b.dtypes and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_create_as_select(spark, rows, namespace, fmt):
    sinks.create_as_select(rows, f"{namespace}.t", fmt)
    assert same(catalog.read_table(spark, f"{namespace}.t"), rows)
    detail = spark.sql(f"DESCRIBE EXTENDED {namespace}.t").where("col_name = 'Provider'").head()
    assert detail["data_type"] == fmt


def test_create_as_select_fails_if_the_name_is_taken(spark, rows, namespace):
    sinks.create_as_select(rows, f"{namespace}.t")
    with pytest.raises(AnalysisException):
        sinks.create_as_select(rows, f"{namespace}.t")
    assert not [t for t in spark.catalog.listTables(namespace) if t.name.startswith("load_")]


def test_options_reach_the_writer(spark, rows, namespace, tmp_path):
    sinks.create_as_select(
        rows, f"{namespace}.t", "parquet", {"compression": "zstd"}, str(tmp_path / "files")
    )
    files = glob.glob(str(tmp_path / "files" / "*.parquet"))
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_location_with_a_quote_and_a_blank(spark, rows, namespace, tmp_path):
    path = str(tmp_path / "it's here")
    sinks.create_as_select(rows, f"{namespace}.t", location=path)
    assert same(catalog.read_table(spark, f"{namespace}.t"), rows)
    assert glob.glob(f"{path}/*.parquet")


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_overwrite_then_refresh_the_table_over_it(spark, rows, namespace, tmp_path, fmt):
    path, name = str(tmp_path / "files"), f"{namespace}.t"
    sinks.write_path(rows, path, fmt)
    sinks.register_external(spark, name, path, fmt)
    assert same(catalog.read_table(spark, name), rows)
    sinks.write_path(rows.where("id < 7"), path, fmt, refresh=name)
    assert catalog.read_table(spark, name).count() == 7


def test_dropping_an_external_table_keeps_its_files(spark, rows, namespace, tmp_path):
    path = str(tmp_path / "files")
    sinks.write_path(rows, path)
    sinks.register_external(spark, f"{namespace}.t", path)
    spark.sql(f"DROP TABLE {namespace}.t")
    assert spark.read.parquet(path).count() == 100


def test_create_if_missing_twice_keeps_the_rows(spark, namespace):
    name = f"{namespace}.test_table"
    sinks.create_if_missing(spark, name, "id INT, name STRING")
    assert catalog.read_table(spark, name).count() == 0
    sinks.insert_rows(spark.sql("SELECT 1 AS id, 'a' AS name"), name)
    sinks.create_if_missing(spark, name, "id INT, name STRING")
    assert catalog.read_table(spark, name).collect() == [(1, "a")]


def test_point_table_at_moves_the_name(spark, rows, namespace, tmp_path):
    name = f"{namespace}.t"
    for n in (5, 9):
        path = sinks.version_path(str(tmp_path), "t")
        sinks.write_path(rows.where(f"id < {n}"), path)
        sinks.point_table_at(spark, name, path, "parquet")
        assert catalog.read_table(spark, name).count() == n


def test_statements_for_table_formats():
    assert sinks.create_table_sql(
        "lake.ns.t", "iceberg", "v", {"write.format.default": "orc"}, replace=True
    ) == (
        "CREATE OR REPLACE TABLE `lake`.`ns`.`t` USING iceberg"
        " OPTIONS ('write.format.default' = 'orc') AS SELECT * FROM `v`"
    )
    assert sinks.create_table_sql("ns.t", "delta", location="s3a://b/t") == (
        "CREATE TABLE `ns`.`t` USING delta LOCATION 's3a://b/t'"
    )


def test_names_cannot_break_out_of_a_statement():
    assert catalog.quoted("a`; DROP TABLE b") == "`a; DROP TABLE b`"
    assert catalog.literal("it's \\ here") == "'it\\'s \\\\ here'"


@pytest.mark.parametrize("fmt", ["avro", "iceberg", "delta"])
def test_missing_modules_are_reported_before_any_write(spark, fmt):
    with pytest.raises(sinks.FormatUnavailable):
        sinks.require_format(spark, fmt)


def test_unknown_formats_raise(spark):
    with pytest.raises(ValueError):
        sinks.require_format(spark, "csv")


def test_list_tables_leaves_out_views(spark, rows, namespace):
    rows.createOrReplaceTempView("a_view")
    sinks.create_as_select(rows, f"{namespace}.b")
    sinks.create_as_select(rows, f"{namespace}.a")
    listed = catalog.list_tables(spark, namespace)
    assert sorted(r.tableName for r in listed.collect()) == ["a", "b"]
    spark.catalog.dropTempView("a_view")


def test_show_rows(spark, rows, namespace):
    sinks.create_as_select(rows, f"{namespace}.t")
    assert catalog.show_rows(spark, f"{namespace}.t").count() == 20
    first = catalog.show_rows(spark, f"{namespace}.t", 3, order_by="id")
    assert [r.id for r in first.collect()] == [0, 1, 2]


def test_namespace_location(spark, namespace, tmp_path):
    assert catalog.namespace_location(spark, namespace).endswith(str(tmp_path / "namespace"))


def test_temp_views_do_not_collide(spark):
    with catalog.temp_view(spark.range(1)) as a, catalog.temp_view(spark.range(2)) as b:
        assert a != b
        assert (spark.table(a).count(), spark.table(b).count()) == (1, 2)
    assert not spark.catalog.tableExists(a)
