import glob
import threading
from collections import Counter
from contextlib import contextmanager
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakeload.operators import catalog, sinks
from lakeload.operators.sinks import FormatUnavailable
from lakeload.plans import load as loads
from lakeload.plans.load import LoadFailed, load_all, load_table, reconcile_all, reconcile_load
from lakeload.plans.schemas import tpcds
from lakeload.plans.spec import LoadSpec
from lakeload.sources import delimited
from lakeload.sources.delimited import Layout

INVENTORY = ["1|10|5|100|", "2|20|6|200|", "3|30|7||"]
REASON = ["1|AAAA|Did not fit|", "2|BBBB|Wrong size|"]


@pytest.fixture
def spec(lines, namespace, tmp_path):
    lines("inventory", INVENTORY)
    root = lines("reason", REASON)
    return LoadSpec(
        root,
        namespace,
        table_root=str(tmp_path / "tables"),
        registry=tpcds().only(["inventory", "reason"]),
    )


def rows(spark, spec, table="inventory"):
    return sorted(map(tuple, catalog.read_table(spark, spec.table_name(table)).collect()))


LOADED = [(1, 10, 5, 100), (2, 20, 6, 200), (3, 30, 7, None)]


@pytest.mark.parametrize("mode", ["managed", "external"])
@pytest.mark.parametrize("fmt", ["parquet", "orc"])
@pytest.mark.parametrize("malformed", ["null", "reject", "fail"])
def test_load_table(spark, spec, mode, fmt, malformed):
    spec = replace(spec, mode=mode, format=fmt, malformed=malformed)
    result = load_table(spark, "inventory", spec)
    assert rows(spark, spec) == LOADED
    table = catalog.read_table(spark, spec.table_name("inventory"))
    assert table.dtypes == [(f.name, f.dataType.simpleString()) for f in tpcds()["inventory"]]
    assert (result.status, result.row_count, result.rejected) == ("ok", 3, 0)
    assert (result.null_violations, result.partitions, result.error) == (0, 1, None)
    assert result.seconds > 0


@pytest.mark.parametrize("mode", ["managed", "external"])
class TestIfExists:
    def test_fail_leaves_the_table_and_its_files(self, spark, spec, lines, mode):
        spec = replace(spec, mode=mode)
        load_table(spark, "inventory", spec)
        lines("inventory", ["9|9|9|9|"])
        with pytest.raises(LoadFailed, match="TableExists"):
            load_table(spark, "inventory", spec)
        spark.catalog.refreshTable(spec.table_name("inventory"))
        assert rows(spark, spec) == LOADED

    def test_skip(self, spark, spec, lines, mode):
        spec = replace(spec, mode=mode, if_exists="skip")
        assert load_table(spark, "inventory", spec).status == "ok"
        lines("inventory", ["9|9|9|9|"])
        assert load_table(spark, "inventory", spec).status == "skipped"
        assert rows(spark, spec) == LOADED

    def test_replace_more_than_once(self, spark, spec, lines, mode):
        spec = replace(spec, mode=mode, if_exists="replace")
        load_table(spark, "inventory", spec)
        for n in (7, 8):
            lines("inventory", [f"{n}|{n}|{n}|{n}|"])
            assert load_table(spark, "inventory", spec).row_count == 1
            assert rows(spark, spec) == [(n, n, n, n)]

    def test_a_failed_replacement_leaves_the_table(self, spark, spec, lines, mode):
        spec = replace(spec, mode=mode, if_exists="replace", malformed="fail")
        load_table(spark, "inventory", spec)
        lines("inventory", ["x|9|9|9|"])
        with pytest.raises(LoadFailed, match="1 lines do not fit"):
            load_table(spark, "inventory", spec)
        assert rows(spark, spec) == LOADED


@pytest.mark.parametrize("mode", ["managed", "external"])
def test_leftovers_of_an_interrupted_load_do_not_stop_the_next(spark, spec, tmp_path, mode):
    for root in ("namespace", "tables"):
        left = tmp_path / root / "inventory" / "_temporary" / "0"
        left.mkdir(parents=True)
        (left / "part-0").write_text("half a file")
    result = load_table(spark, "inventory", replace(spec, mode=mode, malformed="fail"))
    assert (result.status, result.row_count) == ("ok", 3)
    assert rows(spark, spec) == LOADED


def test_load_all_in_registry_order(spark, spec):
    results = load_all(spark, spec)
    assert [(r.table_name, r.row_count) for r in results] == [("inventory", 3), ("reason", 2)]
    assert sorted(r.tableName for r in catalog.list_tables(spark, spec.namespace).collect()) == [
        "inventory",
        "reason",
    ]


def test_one_bad_table_does_not_stop_the_others(spark, spec, namespace):
    audit = f"{namespace}.load_audit"
    spec = replace(
        spec, registry=tpcds().only(["item", "inventory", "reason"]), audit_table=audit
    )
    with pytest.raises(LoadFailed, match="item: .*PATH_NOT_FOUND") as failure:
        load_all(spark, spec)
    assert [r.status for r in failure.value.results] == ["failed", "ok", "ok"]
    written = {r.table_name: r for r in catalog.read_table(spark, audit).collect()}
    assert {t: r.status for t, r in written.items()} == {
        "item": "failed",
        "inventory": "ok",
        "reason": "ok",
    }
    assert "PATH_NOT_FOUND" in written["item"].error
    assert written["inventory"].row_count == 3
    assert rows(spark, spec, "reason") == [(1, "AAAA", "Did not fit"), (2, "BBBB", "Wrong size")]


def test_each_load_adds_to_the_audit(spark, spec, namespace):
    audit = f"{namespace}.load_audit"
    spec = replace(spec, audit_table=audit, if_exists="skip")
    load_all(spark, spec)
    load_all(spark, spec)
    statuses = Counter(r.status for r in catalog.read_table(spark, audit).collect())
    assert statuses == {"ok": 2, "skipped": 2}


def test_rejects_are_kept_as_raw_lines(spark, spec, lines):
    lines("inventory", INVENTORY + ["x|1|1|1|", "4|1|1|", "5|1|1|1|1|"])
    spec = replace(spec, malformed="reject", if_exists="replace")
    result = load_table(spark, "inventory", spec)
    assert (result.row_count, result.rejected) == (3, 3)
    assert rows(spark, spec) == LOADED
    kept = catalog.read_table(spark, spec.rejects_name("inventory")).collect()
    assert {r[0] for r in kept} == {"x|1|1|1|", "4|1|1|", "5|1|1|1|1|"}

    lines("inventory", INVENTORY)  # a clean load leaves no rejects from the one before
    assert load_table(spark, "inventory", spec).rejected == 0
    assert not spark.catalog.tableExists(spec.rejects_name("inventory"))


def test_fail_on_malformed_leaves_no_table(spark, spec, lines):
    lines("inventory", INVENTORY + ["x|1|1|1|"])
    with pytest.raises(LoadFailed, match="1 lines do not fit"):
        load_table(spark, "inventory", replace(spec, malformed="fail"))
    assert not spark.catalog.tableExists(spec.table_name("inventory"))


@pytest.mark.parametrize("malformed", ["null", "reject"])
def test_nulls_in_declared_columns(spark, spec, lines, malformed):
    lines("inventory", INVENTORY + ["|1||1|", "|1|1|1|"])
    spec = replace(spec, malformed=malformed)
    result = load_table(spark, "inventory", spec)
    assert (result.row_count, result.null_violations) == (5, 3)


def test_fail_on_nulls_leaves_no_table(spark, spec, lines):
    lines("inventory", INVENTORY + ["|1|1|1|"])
    with pytest.raises(LoadFailed, match="1 nulls in columns declared non-null"):
        load_table(spark, "inventory", replace(spec, nulls="fail"))
    assert not spark.catalog.tableExists(spec.table_name("inventory"))


def test_32_bit_keys_need_an_override(spark, spec, lines):
    lines("inventory", ["1|3000000000|1|1|"])
    assert load_table(spark, "inventory", spec).null_violations == 1
    wide = spec.registry.override({"inventory": {"inv_item_sk": "bigint"}})
    load_table(spark, "inventory", replace(spec, registry=wide, if_exists="replace"))
    assert rows(spark, spec) == [(1, 3000000000, 1, 1)]


@pytest.mark.parametrize("malformed", ["null", "reject"])
@pytest.mark.parametrize("content", [[], [""]])
def test_an_empty_source_gives_an_empty_table(spark, spec, lines, malformed, content):
    lines("inventory", content)
    spec = replace(spec, malformed=malformed, digest=True)
    result = load_table(spark, "inventory", spec)
    assert (result.status, result.row_count, result.rejected) == ("ok", 0, 0)
    assert rows(spark, spec) == []
    assert reconcile_load(spark, "inventory", spec, result=result).head().table_rows == 0


def test_keys_that_do_not_fit_are_seen_before_the_load(spark, spec, lines):
    lines("inventory", [*INVENTORY, "4|3000000000|5|x|"])
    fitted = loads.source_fit(spark, "inventory", spec).collect()
    found = {r.column_name: (r.fitted, r.declared, r.holds) for r in fitted}
    assert found == {
        "inv_date_sk": ("tinyint", "int", True),
        "inv_item_sk": ("bigint", "int", False),
        "inv_warehouse_sk": ("tinyint", "int", True),
        "inv_quantity_on_hand": ("string", "int", False),
    }
    wider = replace(spec, registry=spec.registry.override({"inventory": {"inv_item_sk": "bigint"}}))
    holds = {r.column_name: r.holds for r in loads.source_fit(spark, "inventory", wider).collect()}
    assert holds["inv_item_sk"]


def test_decimals_dates_and_encoding(spark, spec, lines):
    line = "1|AAAA|2001-10-27||café|3.15|2.10||||||||||||||||"
    lines("item", f"{line}\n".encode("latin-1"))
    spec = replace(
        spec, registry=tpcds().only(["item"]), layout=Layout(encoding="ISO-8859-1")
    )
    load_table(spark, "item", spec)
    row = catalog.read_table(spark, spec.table_name("item")).head()
    assert row.i_item_desc == "café"
    assert row.i_current_price == Decimal("3.15")
    assert (str(row.i_rec_start_date), row.i_rec_end_date) == ("2001-10-27", None)


def test_split_size_sets_the_number_of_files_and_is_put_back(spark, lines, spec, namespace):
    lines("inventory", [f"{n}|1|1|1|" for n in range(5000)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    many = replace(spec, split_bytes=10_000, mode="external")
    assert load_table(spark, "inventory", many).partitions >= 4
    one = replace(spec, split_bytes=512 * 1024 * 1024, mode="external", if_exists="replace")
    assert load_table(spark, "inventory", one).partitions == 1
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None
    # Only the version that the name points at is left.
    assert len(glob.glob(f"{spec.table_root}/{spec.namespace}/inventory*")) == 1
    assert spark.table(spec.table_name("inventory")).count() == 5000


@pytest.mark.parametrize("mode", ["managed", "external"])
def test_replacing_leaks_nothing_and_keeps_type_and_options(spark, lines, spec, namespace, mode):
    lines("inventory", [f"{n}|1|1|1|" for n in range(50)])
    first = replace(spec, mode=mode, options={"compression": "zstd"})

    def described():
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {spec.table_name('inventory')}").collect()
        return {r.col_name: r.data_type for r in rows if r.col_name in ("Type", "Storage Properties")}

    load_table(spark, "inventory", first)
    before = described()
    for _ in range(3):
        load_table(spark, "inventory", replace(first, if_exists="replace"))
    assert described() == before and spark.table(spec.table_name("inventory")).count() == 50
    root = sinks.location_of(spark, spec.table_name("inventory")).removeprefix("file:").rpartition("/")[0]
    assert len(glob.glob(f"{root}/inventory*")) == 1
    lines("inventory", ["1|2|3|4|", "x|2|3|4|"])
    refused = replace(first, if_exists="replace", malformed="fail")
    with pytest.raises(Exception):
        load_table(spark, "inventory", refused)
    assert len(glob.glob(f"{root}/inventory*")) == 1
    assert spark.table(spec.table_name("inventory")).count() == 50


def test_two_namespaces_with_one_table_root(spark, lines, spec, namespace, tmp_path):
    lines("inventory", ["1|1|1|1|"])
    load_table(spark, "inventory", replace(spec, mode="external"))
    other = replace(spec, mode="external", namespace=f"{namespace}_b", namespace_location=str(tmp_path / "b"))
    lines("inventory", ["7|7|7|7|", "x|7|7|7|"])
    with pytest.raises(Exception):
        load_table(spark, "inventory", replace(other, malformed="fail"))
    load_table(spark, "inventory", replace(other, malformed="null"))
    assert spark.table(spec.table_name("inventory")).count() == 1
    assert spark.table(other.table_name("inventory")).count() == 2


def test_refused_settings(spec):
    with pytest.raises(ValueError, match="iceberg"):
        replace(spec, mode="external", format="iceberg")
    with pytest.raises(ValueError, match="multiLine"):
        delimited.Layout(options={"multiLine": "true"})


@pytest.mark.parametrize("options, text", [
    ({"lineSep": ";"}, b"1|1|1|1|;2|2|2|2|;"),
    ({"header": "true"}, b"a|b|c|d|\n1|1|1|1|\n2|2|2|2|\n"),
    ({"comment": "#"}, b"# none\n1|1|1|1|\n2|2|2|2|\n"),
])
@pytest.mark.parametrize("malformed", ["null", "reject", "fail"])
def test_line_options_hold_for_both_readers(spark, lines, spec, namespace, options, text, malformed):
    lines("inventory", text)
    layout = delimited.Layout(options=options)
    result = load_table(spark, "inventory", replace(spec, layout=layout, malformed=malformed))
    assert (result.row_count, result.rejected) == (2, 0)


def test_staged_text_keeps_blanks_and_refuses_line_breaks(spark, tmp_path):
    schema = "a string, b string"
    rows = spark.createDataFrame([(" a ", "b"), ("", " ")], schema)
    delimited.write_delimited(rows, str(tmp_path / "t"))
    back = delimited.scan(spark, str(tmp_path / "t"), rows.schema)
    assert back.where("a = ' a '").count() == 1
    with pytest.raises(Exception, match="line break"):
        delimited.write_delimited(spark.createDataFrame([("x\ny", "b")], schema), str(tmp_path / "u"))


def test_unknown_table_and_missing_module_stop_before_any_work(spark, spec):
    with pytest.raises(KeyError):
        load_table(spark, "nothing", spec)
    with pytest.raises(FormatUnavailable):
        load_table(spark, "inventory", replace(spec, format="avro"))


def test_reconcile_load(spark, spec):
    load_all(spark, spec)
    assert sorted(map(tuple, reconcile_all(spark, spec).collect())) == [
        ("inventory", 3, 3, 0, 0),
        ("reason", 2, 2, 0, 0),
    ]
    spark.sql(f"INSERT INTO {spec.table_name('reason')} VALUES (2, 'BBBB', 'Wrong size')")
    found = reconcile_load(spark, "reason", spec, exact=True).head()
    assert tuple(found) == ("reason", 2, 3, 0, 1)


@pytest.mark.parametrize("malformed", ["null", "reject"])
def test_digest_leaves_the_source_unread_unless_the_table_changed(spark, spec, lines, malformed):
    lines("inventory", INVENTORY + INVENTORY[:1] + ["1|2|x|4|"])
    spec = replace(spec, digest=True, malformed=malformed)
    results = load_all(spark, spec)
    kept = 5 if malformed == "null" else 4

    def reconciled():
        return sorted(map(tuple, reconcile_all(spark, spec, results=results).collect()))

    same = ("reason", 2, 2, 0, 0)
    assert reconciled() == [("inventory", kept, kept, 0, 0), same]
    lines("inventory", ["5|5|5|5|"])  # not looked at while the table is as written
    assert reconciled() == [("inventory", kept, kept, 0, 0), same]
    spark.sql(f"INSERT INTO {spec.table_name('inventory')} VALUES (5, 5, 5, 5)")
    assert reconciled() == [("inventory", 1, kept + 1, 0, kept), same]


def test_jobs_side_by_side_keep_their_own_properties(spark):
    together = threading.Barrier(3, timeout=60)

    def job(item):
        spark.sparkContext.setLocalProperty("lakeload.test", item)
        together.wait()
        return spark.sparkContext.getLocalProperty("lakeload.test")

    assert loads.side_by_side(spark, job, ["a", "b", "c"], 3) == ["a", "b", "c"]
    assert spark.sparkContext.getLocalProperty("lakeload.test") is None


def test_the_load_plan_has_no_shuffle(spark, spec):
    for malformed in ("null", "reject"):
        rows, _, _ = loads._observed(spark, "inventory", replace(spec, malformed=malformed))
        assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
        assert rows.select(F.col("inv_date_sk")).columns == ["inv_date_sk"]


def test_text_that_does_not_stay_is_there_while_its_table_loads(spark, spec, lines, tmp_path):
    seen = []

    @contextmanager
    def landed(table):
        lines(table, {"inventory": INVENTORY, "reason": REASON}[table])
        yield seen.append(table)
        (tmp_path / f"{table}.dat").unlink()

    for table in ("inventory", "reason"):
        (tmp_path / f"{table}.dat").unlink()
    results = load_all(spark, spec, ["reason", "inventory"], landed)
    assert [(r.table_name, r.row_count) for r in results] == [("reason", 2), ("inventory", 3)]
    assert sorted(seen) == ["inventory", "reason"] and not glob.glob(f"{tmp_path}/*.dat")
    assert rows(spark, spec) == LOADED
    load_all(spark, replace(spec, if_exists="skip"), landed=landed)  # needs no text
    assert len(seen) == 2
