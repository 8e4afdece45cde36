"""The registered tables from text that is there only while its table loads."""

import pathlib

import __spark_entry__ as driver
import pyarrow.parquet as pq
import pytest
from lakeload import scratch
from lakeload.plans.load import LoadFailed
from lakeload.plans.schemas import tpcds

FEW = ["reason", "date_dim", "store_sales", "income_band"]


@pytest.fixture(scope="module")
def given(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("given")
    day = "timestampadd(DAY, id % 900, TIMESTAMP '2000-01-01') AS"
    columns = {
        "lineitem": (
            5000, "id * 7919 % 5003 AS l_orderkey", "id % 97 AS l_partkey", "id % 9 AS l_suppkey",
            "CAST(id % 7 AS int) AS l_linenumber", "id % 50 + 0D AS l_quantity", "id / 8D AS l_extendedprice",
            "0.04D AS l_discount", "0.02D AS l_tax", "'N' AS l_returnflag", "'O' AS l_linestatus", f"{day} l_shipdate",
        ),
        "orders": (
            800, "id AS o_orderkey", "id % 30 AS o_custkey", "id * 10.5D AS o_totalprice", f"{day} o_orderdate",
            "'O' AS o_orderstatus", "'5-LOW' AS o_orderpriority",
        ),
        "customer": (
            30, "id AS c_custkey", "CAST(id % 5 AS int) AS c_nationkey", "id / 4D AS c_acctbal",
            "'a' AS c_name", "'b' AS c_mktsegment",
        ),
        "supplier": (
            12, "id AS s_suppkey", "CAST(id % 5 AS int) AS s_nationkey", "id / 4D AS s_acctbal", "'s' AS s_name",
        ),
        "part": (
            20, "id AS p_partkey", "CAST(id % 5 AS int) AS p_size", "id / 4D AS p_retailprice",
            "'p' AS p_name", "'b' AS p_brand", "'t' AS p_type",
        ),
    }
    for table, (rows, *values) in columns.items():
        spark.range(0, rows, 1, 2).selectExpr(*values).write.parquet(f"{root}/{table}.parquet")
    return str(root)


@pytest.fixture
def few(monkeypatch):
    monkeypatch.setattr(driver, "tpcds", lambda: tpcds().only(FEW))


@pytest.fixture
def left(spark):
    """The files of a kind that have come below the scratch root since the test began."""
    root = pathlib.Path(scratch.scratch_root(spark))
    before = set(root.rglob("*"))

    def found(ending):
        return [f for f in root.rglob(f"*{ending}") if f not in before and f.is_file()]

    return found


COUNTS = {"reason": 12, "date_dim": 800, "store_sales": 5000, "income_band": 30}


def test_load_tpcds_leaves_tables_and_no_text(spark, given, few, left, monkeypatch):
    turns, load_all = [], driver.load_all

    def watched(spark, spec, tables, *more):
        loaded = load_all(spark, spec, tables, *more)
        turns.append((tables, left(".gz")))
        return loaded

    monkeypatch.setattr(driver, "load_all", watched)
    monkeypatch.setattr(driver, "TURN_BYTES", 1)
    rows = driver.load_tpcds(spark, given).collect()
    assert [tuple(r) for r in rows] == [(t, COUNTS[t], 0, "ok") for t in FEW]
    assert turns == [(["store_sales"], []), (["date_dim", "income_band", "reason"], [])]
    held = {f.parent.name: 0 for f in left(".parquet")}
    for f in left(".parquet"):
        held[f.parent.name] += pq.read_metadata(f).num_rows
    assert held == COUNTS


def test_numbers_of_many_values_are_packed(spark, given, few, left):
    driver.load_tpcds(spark, given)
    file = next(f for f in left(".zstd.parquet") if f.parent.name == "store_sales")
    group = pq.read_metadata(file).row_group(0)
    found = {group.column(i).path_in_schema: group.column(i).encodings for i in range(group.num_columns)}
    assert "DELTA_BINARY_PACKED" in found["ss_sold_date_sk"]


def test_schema_registry_leaves_neither_text_nor_tables(spark, given, few, left):
    rows = driver.schema_registry(spark, given).collect()
    named = [(r.table_name, r.position, r.column_name, r.data_type) for r in rows]
    assert named == [
        (table, i, field.name, field.dataType.simpleString())
        for table, schema in driver.tpcds().items()
        for i, field in enumerate(schema, 1)
    ]
    assert all(r.row_count == COUNTS[r.table_name] for r in rows)
    assert left(".gz") == [] and left(".parquet") == []


def test_turns_hold_each_table_once_and_no_more_than_the_largest(spark, given, monkeypatch):
    assert tpcds_sorted(driver.tpcds_turns(spark, given)) == sorted(tpcds())
    assert len(driver.tpcds_turns(spark, given)) == 1  # all are small
    monkeypatch.setattr(driver, "TURN_BYTES", 1)
    turns = driver.tpcds_turns(spark, given)
    assert tpcds_sorted(turns) == sorted(tpcds())
    assert ["web_sales"] in turns and ["catalog_sales"] in turns


def tpcds_sorted(turns):
    return sorted(table for turn in turns for table in turn)


def test_a_table_whose_text_fails_does_not_stop_later_turns(spark, given, few, left, monkeypatch):
    rows = driver._tpcds_rows

    def failing(spark, sf_dir, table, schema):
        found = rows(spark, sf_dir, table, schema)
        return found.selectExpr("CAST(raise_error('no text') AS string) AS a") if table == "store_sales" else found

    monkeypatch.setattr(driver, "_tpcds_rows", failing)
    monkeypatch.setattr(driver, "TURN_BYTES", 1)
    with pytest.raises(LoadFailed, match="store_sales: .*no text") as failure:
        driver.schema_registry(spark, given)
    found = {r.table_name: (r.status, r.row_count) for r in failure.value.results}
    assert found == {t: ("ok", COUNTS[t]) for t in FEW} | {"store_sales": ("failed", None)}
    assert left(".gz") == []
