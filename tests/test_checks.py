from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeload.functions.columns import clean_path, row_hash
from lakeload.operators import checks
from lakeload.sources import files


def test_null_counts(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 'a'), (NULL, 'b'), (NULL, NULL) AS t(k, v)")
    found = {r.column_name: r.null_count for r in checks.null_counts(df, ["k", "v"]).collect()}
    assert found == {"k": 2, "v": 1}
    assert checks.null_counts(df, []).columns == ["column_name", "null_count"]
    assert checks.null_counts(df.limit(0), ["k"]).collect() == [("k", 0)]


def test_require_not_null(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 'a'), (NULL, 'b') AS t(k, v)")
    checks.require_not_null(df, ["v"])
    with pytest.raises(checks.NullsFound, match="k: 1"):
        checks.require_not_null(df, ["k", "v"])


def test_null_counts_read_only_the_columns_checked(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT id AS k, id AS v, id AS w FROM range(10)").write.parquet(path)
    plan = checks.null_counts(spark.read.parquet(path), ["k", "w"])
    assert "ReadSchema: struct<k:bigint,w:bigint>" in plan._jdf.queryExecution().toString()


def test_partition_profile(spark):
    df = spark.range(0, 100, numPartitions=4)
    assert checks.partition_count(df) == 4
    profile = checks.partition_profile(df).collect()
    assert sorted(map(tuple, profile)) == [(n, 25) for n in range(4)]


def test_column_profile(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 'b'), (NULL, 'a'), (3, 'c') AS t(k, `v w`)")
    assert list(map(tuple, checks.column_profile(df, "t's").collect())) == [
        ("t's", 1, "k", "int", 3, 1, "1", "3"),
        ("t's", 2, "v w", "string", 3, 0, "a", "c"),
    ]


def test_swapped_nulls_hash_apart(spark):
    df = spark.sql("SELECT * FROM VALUES (NULL, 'a'), ('a', NULL), (NULL, NULL) AS t(x, y)")
    for salt in (0, 1):
        assert df.select(row_hash(["x", "y"], salt)).distinct().count() == 3


def test_nulls_in_wide_rows_hash_apart(spark):
    columns = [f"c{i}" for i in range(130)]
    df = spark.range(130).select(
        *[F.when(F.col("id") != i, F.lit(1)).alias(c) for i, c in enumerate(columns)]
    )
    assert df.select(row_hash(columns)).distinct().count() == 130


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, v string")


ROWS = st.lists(
    st.tuples(st.none() | st.integers(0, 3), st.none() | st.sampled_from(["a", "b"])), max_size=12
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(ROWS, ROWS)
def test_reconcile_agrees_with_counting(spark, left, right):
    expected = (
        "t",
        len(left),
        len(right),
        sum((Counter(left) - Counter(right)).values()),
        sum((Counter(right) - Counter(left)).values()),
    )
    a, b = frame(spark, left), frame(spark, right)
    assert tuple(checks.reconcile(a, b, "t").head()) == expected
    assert tuple(checks.reconcile(a, b, "t", exact=True).head()) == expected


def test_differences_inside_one_group(spark, monkeypatch):
    """With one group only, rows must be compared, not just counted."""
    monkeypatch.setattr(checks, "BUCKETS", 1)
    a = frame(spark, [(1, "a"), (1, "a"), (2, "b"), (3, "c")])
    b = frame(spark, [(1, "a"), (2, "b"), (3, "d"), (4, "e")])
    assert tuple(checks.reconcile(a, b, "t").head()) == ("t", 4, 4, 2, 2)


def test_one_row_repeated_very_often(spark):
    """A third of the rows equal: they merge in each task and the sums still hold."""
    many = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k")
    )
    assert tuple(checks.reconcile(many, many, "t").head()) == ("t", 300_000, 300_000, 0, 0)
    fewer = many.where("k <> -1").unionAll(spark.range(7).selectExpr("-1L AS k"))
    assert tuple(checks.reconcile(many, fewer, "t").head()) == (
        "t",
        300_000,
        200_007,
        99_993,
        0,
    )


def test_row_differences(spark):
    a, b = frame(spark, [(1, "a"), (1, "a"), (2, "b")]), frame(spark, [(1, "a"), (3, None)])
    assert sorted(map(str, map(tuple, checks.row_differences(a, b).collect()))) == [
        "(1, 'a', 2, 1)",
        "(2, 'b', 1, 0)",
        "(3, None, 0, 1)",
    ]


def test_reconcile_refuses_other_columns(spark):
    with pytest.raises(checks.SchemaMismatch):
        checks.reconcile(spark.range(1), spark.range(1).toDF("other"), "t")
    with pytest.raises(checks.SchemaMismatch):
        checks.reconcile(spark.range(1), spark.sql("SELECT 1 AS id"), "t")


def test_clean_path_drops_one_trailing_slash(spark):
    paths = ["a/", "a//", "a", "/", "", "a/b/", None]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    cleaned = [r[0] for r in df.select(clean_path("p")).collect()]
    assert cleaned == ["a", "a/", "a", "", "", "a/b", None]


@pytest.fixture
def tree(tmp_path):
    sizes = {"a/1.txt": 3, "a/b c/2%20.txt": 5, "d/3": 1, "top": 7}
    for key, size in {**sizes, "a/empty": 0, "a/_SUCCESS": 0}.items():
        (tmp_path / key).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / key).write_bytes(b"x" * size)
    return str(tmp_path), sizes


@pytest.mark.parametrize("form", ["{}", "{}/", "file:{}", "file://{}/"])
def test_list_files(spark, tree, form):
    root, sizes = tree
    listed = files.list_files(spark, form.format(root)).collect()
    assert {r.key: r.length for r in listed} == sizes
    assert {r.key: r.prefix for r in listed} == {
        "a/1.txt": "a",
        "a/b c/2%20.txt": "a",
        "d/3": "d",
        "top": None,
    }


def test_prefixes_and_sizes(spark, tree):
    root, _ = tree
    assert sorted(r.prefix for r in files.list_prefixes(spark, root).collect()) == ["a", "d"]
    assert {r.key for r in files.list_keys(spark, root, "a/").collect()} == {
        "a/1.txt",
        "a/b c/2%20.txt",
    }
    sizes = {r.prefix: (r.file_count, r.total_bytes) for r in files.prefix_sizes(spark, root).collect()}
    assert sizes == {"a": (2, 8), "d": (1, 1), None: (1, 7)}


def test_listing_reads_no_content(spark, tree):
    plan = files.list_files(spark, tree[0])._jdf.queryExecution().executedPlan().toString()
    assert "file_listing" in plan and "FileScan" not in plan
    plan = files._listed_by_spark(spark, tree[0])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,modificationTime:timestamp,length:bigint>" in plan
