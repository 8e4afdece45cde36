from pyspark.sql import types as T

from lakeload.operators import fit

CASES = {
    "tiny": (["1", "-128", None, ""], "tinyint"),
    "small": (["128", "-32768"], "smallint"),
    "wide": (["2147483647", "-2147483648"], "int"),
    "key": (["2147483648", "7"], "bigint"),
    "huge": (["9223372036854775808"], "decimal(19,0)"),
    "price": (["12.5", "-0.125", "1000"], "decimal(7,3)"),
    "zeros": (["000", "0"], "tinyint"),
    "too_long": (["9" * 39], "string"),
    "day": (["2024-02-29", "1999-12-31"], "date"),
    "no_day": (["2023-02-29"], "string"),
    "mixed": (["1", "2024-02-29"], "string"),
    "empty": ([None, ""], None),
    "exponent": (["1e5"], "string"),
    "a.b": (["x"], "string"),
}


def frame(spark, columns):
    longest = max(map(len, columns.values()))
    rows = [[(v + [None] * longest)[i] for v in columns.values()] for i in range(longest)]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.createDataFrame(rows, schema).repartition(3)


def test_narrowest_types(spark):
    found = fit.type_fit(frame(spark, {c: v for c, (v, _) in CASES.items()}))
    assert {r.column_name: r.fitted for r in found.collect()} == {c: t for c, (_, t) in CASES.items()}


def test_no_rows_fit_any_type(spark):
    declared = T.StructType([T.StructField("k", T.IntegerType())])
    found = fit.type_fit(frame(spark, {"k": ["1"]}).limit(0), declared).collect()
    assert [(r.filled, r.fitted, r.holds) for r in found] == [(0, None, True)]


def test_declared_types(spark):
    rows = frame(spark, {c: v for c, (v, _) in CASES.items()})
    for column, of, holds in (
        ("key", T.IntegerType(), False), ("key", T.LongType(), True), ("wide", T.IntegerType(), True),
        ("tiny", T.ByteType(), True), ("small", T.ByteType(), False), ("price", T.DecimalType(7, 3), True),
        ("price", T.DecimalType(7, 2), False), ("price", T.DecimalType(6, 3), False), ("price", T.DoubleType(), True),
        ("day", T.DateType(), True), ("no_day", T.DateType(), False), ("mixed", T.StringType(), True),
        ("exponent", T.VarcharType(3), True), ("exponent", T.VarcharType(2), False), ("day", T.TimestampType(), None),
        ("too_long", T.LongType(), False), ("empty", T.ShortType(), True),
    ):
        found = fit.type_fit(rows, T.StructType([T.StructField(column, of)]))
        row = found.where(found.column_name == column).first()
        assert (row.declared, row.holds) == (of.simpleString(), holds), (column, of)


def test_one_exchange(spark):
    plan = fit.type_fit(frame(spark, {"k": ["1"], "v": ["2"]}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange SinglePartition") == 1
