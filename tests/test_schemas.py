import os
import re

import pytest
from pyspark.sql import types as T

from lakeload.plans.schemas import Registry, data_type, declared_not_null, tpcds


ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def documented():
    """The tables of FIXTURES.md: name, then (column, type, nullable) in order."""
    text = open(f"{ROOT}/FIXTURES.md").read()
    text = text.split("## 2. TPC-DS tables")[1].split("## 3.")[0]
    tables = {}
    for name, body in re.findall(r"### `(\w+)`.*?```\n(.*?)\n```", text, re.S):
        words = [line.rstrip(",").split() for line in body.splitlines()]
        tables[name] = [(w[0], w[1], len(w) == 2) for w in words]
    return tables


def test_every_table_matches_the_documented_schema():
    declared = {
        name: [(f.name, f.dataType.simpleString(), f.nullable) for f in schema]
        for name, schema in tpcds().items()
    }
    assert declared == documented()
    assert list(declared) == list(documented())
    assert len(declared) == 25
    assert sum(map(len, declared.values())) == 429


def test_declared_not_null():
    assert sum(len(declared_not_null(s)) for s in tpcds().values()) == 30
    assert declared_not_null(tpcds()["inventory"]) == [
        "inv_date_sk",
        "inv_item_sk",
        "inv_warehouse_sk",
    ]
    assert declared_not_null(tpcds()["store_sales"]) == []


def test_override_changes_one_column_and_keeps_the_rest():
    changed = tpcds().override({"web_sales": {"ws_order_number": "bigint"}})
    before, after = tpcds()["web_sales"], changed["web_sales"]
    assert after["ws_order_number"] == T.StructField("ws_order_number", T.LongType(), False)
    assert [f for f in after if f.name != "ws_order_number"] == [
        f for f in before if f.name != "ws_order_number"
    ]
    assert changed["item"] == tpcds()["item"]


def test_unknown_names_raise():
    with pytest.raises(KeyError):
        tpcds()["no_such_table"]
    with pytest.raises(KeyError):
        tpcds().override({"item": {"i_nothing": "int"}})
    with pytest.raises(ValueError):
        data_type("tinytext")
    with pytest.raises(KeyError):
        tpcds().only(["item", "nothing"])


def test_only_keeps_order():
    assert list(tpcds().only(["store", "item"])) == ["store", "item"]
    assert isinstance(tpcds().only(["store"]), Registry)
