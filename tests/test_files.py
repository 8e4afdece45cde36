"""Listings by tasks against a walk over the folder."""

import os

import pytest
from pyspark.sql import functions as F

from lakeload.sources import files


@pytest.fixture
def tree(tmp_path):
    for key in ("a/1", "a/b/c/2", "a/b/_3", "_h/4", ".i/5", "e/6", "top", "_top", "ü x/7|é", "e/empty", "e/_sub/8"):
        path = tmp_path / key
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"" if key.endswith("empty") else key.encode())
    (tmp_path / "no_files").mkdir()
    return tmp_path


def walked(root, everything):
    found = {}
    for folder, _, names in os.walk(root):
        for name in names:
            key = os.path.relpath(os.path.join(folder, name), root)
            size = os.path.getsize(os.path.join(folder, name))
            if everything or size and not any(p.startswith(("_", ".")) for p in key.split("/")):
                prefix = key.split("/")[0] if "/" in key else None
                found[key] = (prefix, size)
    return found


@pytest.mark.parametrize("everything", [False, True])
def test_all_files_are_listed(spark, tree, everything):
    rows = files.list_files(spark, str(tree), everything).collect()
    assert {r.key: (r.prefix, r.length) for r in rows} == walked(tree, everything)
    assert len(rows) == len(walked(tree, everything))
    for r in rows:
        assert r.path == f"file:{tree}/{r.key}" and r.modificationTime is not None
    assert {r.prefix for r in files.list_prefixes(spark, f"{tree}/").collect()} == {"a", "e", "ü x"}
    assert {r.key for r in files.list_keys(spark, str(tree), "a/").collect()} == {"a/1", "a/b/c/2"}


def test_many_files_in_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "_BATCH", 7)
    for p in range(5):
        (tmp_path / f"p{p}").mkdir()
        for i in range(1, 40 * p + 1):
            (tmp_path / f"p{p}" / f"f{i}").write_bytes(b"x" * i)
    sizes = {r.prefix: (r.file_count, r.total_bytes) for r in files.prefix_sizes(spark, str(tmp_path)).collect()}
    assert sizes == {f"p{p}": (40 * p, sum(range(40 * p + 1))) for p in range(1, 5)}


def test_a_partition_is_a_prefix(spark, tree):
    listed = files.list_files(spark, str(tree))
    parts = listed.groupBy(F.spark_partition_id()).agg(F.count_distinct("prefix").alias("n"))
    assert listed.rdd.getNumPartitions() == 5 and all(r.n <= 1 for r in parts.collect())


def test_missing_and_empty_roots(spark, tmp_path):
    assert files.list_files(spark, str(tmp_path)).count() == 0
    with pytest.raises(Exception, match="missing"):
        files.list_files(spark, str(tmp_path / "missing")).count()


def test_other_stores_are_listed_by_spark(spark, tree):
    rows = files._listed_by_spark(spark, f"file:{tree}").collect()
    assert {r.key: (r.prefix, r.length) for r in rows} == walked(tree, False)
