"""The edge rows of FIXTURES.md, on both readers."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeload.plans.schemas import data_type
from lakeload.sources import delimited
from lakeload.sources.delimited import Layout

SCHEMA = T.StructType(
    [
        T.StructField(name, data_type(t))
        for name, t in [("k", "int"), ("a", "decimal(7,2)"), ("d", "date"), ("t", "string")]
    ]
)
DAY = dt.date(2020, 1, 1)
EDGE = [  # line, fields, malformed
    ("1|12.34|2020-01-01|x|", (1, D("12.34"), DAY, "x"), False),
    ("2|1.005|2020-01-01|round|", (2, D("1.01"), DAY, "round"), False),
    ("3|99999999.99|2020-01-01|decover|", (3, None, DAY, "decover"), True),
    ("3000000000|1|2020-01-01|intover|", (None, D("1.00"), DAY, "intover"), True),
    ("5|1|bad|date|", (5, D("1.00"), None, "date"), True),
    ("6||||", (6, None, None, None), False),
    ("7|1|2020-01-01", (7, D("1.00"), DAY, None), True),
    ("8|1|2020-01-01|x|y|z|", (8, D("1.00"), DAY, "x"), True),
    ('9|1|2020-01-01|"a|b"|', (9, D("1.00"), DAY, "a|b"), False),
    ("10|1|2020-01-01| sp |", (10, D("1.00"), DAY, " sp "), False),
    ('11|1|2020-01-01|"a""b"|', (11, D("1.00"), DAY, '"a""b"'), False),
    ('12|1|2020-01-01|"open|', (12, D("1.00"), DAY, "open|"), True),
    ("13|1|2020-02-30|x|", (13, D("1.00"), None, "x"), True),
    ("14|1|2020-01-01|x", (14, D("1.00"), DAY, "x"), True),
    ("15|1|2020-01-01|x|y", (15, D("1.00"), DAY, "x"), True),
]
BLANK = ["", "   ", "\t"]


@pytest.fixture
def path(lines):
    return lines("edge", [line for line, _, _ in EDGE] + BLANK) + "/edge.dat"


def by_text(rows):
    return sorted((tuple(r) for r in rows), key=str)


def test_scan_gives_null_for_fields_that_do_not_parse(spark, path):
    rows = delimited.scan(spark, path, SCHEMA).collect()
    assert by_text(rows) == by_text(fields for _, fields, _ in EDGE)


def test_scan_keeps_column_order_and_types(spark, path):
    scan = delimited.scan(spark, path, SCHEMA)
    assert [(f.name, f.dataType) for f in scan.schema] == [(f.name, f.dataType) for f in SCHEMA]


def test_parse_marks_malformed_lines_and_keeps_their_text(spark, path):
    rows = delimited.parse(spark, path, SCHEMA).collect()
    found = {r[delimited.LINE]: (tuple(r)[:4], r[delimited.MALFORMED]) for r in rows}
    assert found == {line: (fields, malformed) for line, fields, malformed in EDGE}


def test_well_formed_and_rejects_split_every_line(spark, path):
    parsed = delimited.parse(spark, path, SCHEMA)
    good = delimited.well_formed(parsed).collect()
    assert by_text(good) == by_text(fields for _, fields, bad in EDGE if not bad)
    assert delimited.well_formed(parsed).columns == SCHEMA.names
    bad = {r[delimited.LINE] for r in delimited.rejects(parsed).collect()}
    assert bad == {line for line, _, malformed in EDGE if malformed}


def test_rejects_do_not_depend_on_the_columns_selected(spark, path):
    parsed = delimited.parse(spark, path, SCHEMA)
    bad = sum(malformed for _, _, malformed in EDGE)
    assert parsed.where(delimited.MALFORMED).count() == bad
    assert parsed.where(delimited.MALFORMED).select("k").count() == bad
    assert parsed.select("k").where(F.col("k") > 0).count() == len(EDGE) - 1
    assert delimited.well_formed(parsed).count() == len(EDGE) - bad


def test_each_line_is_parsed_once(spark, path):
    good = delimited.well_formed(delimited.parse(spark, path, SCHEMA))
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv(") == 1


def test_scan_reads_only_the_columns_selected(spark, path):
    plan = delimited.scan(spark, path, SCHEMA).select("k", "t")
    assert "ReadSchema: struct<k:int,t:string>" in plan._jdf.queryExecution().toString()


def test_files_without_a_trailing_separator(spark, lines):
    layout = Layout(trailing_separator=False)
    path = lines("plain", ["1|2|2020-01-01|x", "2|2|2020-01-01|x|y", "3|2|2020-01-01"])
    parsed = delimited.parse(spark, f"{path}/plain.dat", SCHEMA, layout)
    assert {r.k: r[delimited.MALFORMED] for r in parsed.collect()} == {1: False, 2: True, 3: True}
    assert delimited.scan(spark, f"{path}/plain.dat", SCHEMA, layout).count() == 3


@pytest.mark.parametrize("reader", [delimited.scan, delimited.parse])
def test_latin_1_text(spark, lines, reader):
    schema = T.StructType([T.StructField("k", data_type("int")), T.StructField("t", data_type("string"))])
    path = lines("latin", "1|café|\n2|Ægir|\n".encode("latin-1"))
    rows = reader(spark, f"{path}/latin.dat", schema, Layout(encoding="ISO-8859-1")).collect()
    assert {r.k: r.t for r in rows} == {1: "café", 2: "Ægir"}


def test_a_directory_of_chunks_is_one_table(spark, tmp_path):
    (tmp_path / "t.dat").mkdir()
    for n in range(3):
        (tmp_path / "t.dat" / f"t_{n}.dat").write_text(f"{n}|1|2020-01-01|x|\n")
    assert delimited.scan(spark, str(tmp_path / "t.dat"), SCHEMA).count() == 3


def test_other_separators(spark, lines):
    path = lines("tabs", ["1\t2\t2020-01-01\tx"]) + "/tabs.dat"
    layout = Layout(separator="\t", trailing_separator=False)
    assert delimited.scan(spark, path, SCHEMA, layout).collect() == [(1, D("2.00"), DAY, "x")]


def test_reserved_names_raise(spark):
    schema = T.StructType([T.StructField("_pad", T.StringType())])
    with pytest.raises(ValueError):
        delimited.scan(spark, "/nowhere", schema)


def test_written_text_reads_back(spark, tmp_path):
    rows = spark.sql(
        "SELECT 1 AS k, 'a|b' AS t, timestamp_ntz'2020-01-01 01:02:03.000456' AS s UNION ALL "
        "SELECT 2, '\"q\"', NULL UNION ALL SELECT NULL, NULL, timestamp_ntz'1999-12-31 00:00:00'"
    )
    delimited.write_delimited(rows, str(tmp_path / "t.dat"))
    back = delimited.scan(spark, str(tmp_path / "t.dat"), rows.schema)
    assert by_text(back.collect()) == by_text(rows.collect())


def test_the_empty_string_reads_as_null(spark, tmp_path):
    rows = spark.sql("SELECT 1 AS k, '' AS t")
    delimited.write_delimited(rows, str(tmp_path / "t.dat"))
    assert delimited.scan(spark, str(tmp_path / "t.dat"), rows.schema).collect() == [(1, None)]


def test_compressed_files_hold_the_same_rows_and_few_each(spark, tmp_path):
    rows = spark.range(0, 2500, 1, 1).selectExpr("id", "concat(' ', id, '|') AS t")
    path = str(tmp_path / "packed.dat")
    delimited.write_delimited(rows, path, compression="gzip", file_rows=1000)
    assert len(list((tmp_path / "packed.dat").glob("*.csv.gz"))) == 3
    for read in (
        delimited.scan(spark, path, rows.schema),
        delimited.well_formed(delimited.parse(spark, path, rows.schema)),
    ):
        assert sorted(map(tuple, read.collect())) == sorted(map(tuple, rows.collect()))
