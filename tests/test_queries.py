"""Every driver query against its SQL; those without SQL must give rows."""

import os
import pathlib

import __spark_entry__ as driver
import oracle
import pytest

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = driver.loader_queries()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    frame = QUERIES[name](spark, SF_DIR)
    sql = driver.loader_sql().get(name)
    if sql is None:
        assert frame.count() > 0
    else:
        assert oracle.mismatch(frame, con, sql) is None


def test_every_sql_belongs_to_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(driver.loader_sql()) <= set(QUERIES)


def test_file_inventory_against_the_disk(spark):
    root = driver._inventory_root(spark, SF_DIR)
    found = {}
    for folder, _, names in os.walk(root):
        for name in names:
            if not name.startswith(("_", ".")):
                prefix = os.path.relpath(folder, root).split(os.sep)[0]
                count, size = found.get(prefix, (0, 0))
                found[prefix] = (count + 1, size + os.path.getsize(os.path.join(folder, name)))
    listed = driver.files.prefix_sizes(spark, root).collect()
    assert {r.prefix: (r.file_count, r.total_bytes) for r in listed} == found


def size_of(path):
    return sum(f.stat().st_size for f in pathlib.Path(path).rglob("*.*") if f.is_file())


def test_staged_text_takes_less_than_plain_text(spark, tmp_path):
    rows = driver.given(spark, SF_DIR, "lineitem")
    plain = str(tmp_path / "lineitem.dat")
    driver.delimited.write_delimited(rows, plain)
    root = driver.staged(spark, SF_DIR, "lineitem", lambda: rows)
    assert 2 * size_of(f"{root}/lineitem.dat") < size_of(plain)


def test_loads_of_queries_write_packed_tables(spark):
    spec = driver.staged_spec(spark, SF_DIR, ["customer"])
    driver.load_table(spark, "customer", spec)
    files = driver.catalog.read_table(spark, spec.table_name("customer")).inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_entry(spark):
    assert driver.entry(spark).count() > 0
