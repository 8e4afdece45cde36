import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("lakeload-tests")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(work / "warehouse"))
        .config("spark.checkpoint.dir", str(work / "checkpoints"))
        .getOrCreate()
    )
    yield session
    session.stop()


@pytest.fixture
def namespace(spark, tmp_path):
    from lakeload.operators.catalog import create_namespace

    name = f"ns_{os.path.basename(tmp_path)}".replace("-", "_")
    create_namespace(spark, name, str(tmp_path / "namespace"))
    return name


@pytest.fixture
def lines(tmp_path):
    """Write lines, or raw bytes, as ``{table}.dat``; returns the data root."""

    def write(table, content):
        if not isinstance(content, bytes):
            content = "".join(f"{line}\n" for line in content).encode()
        (tmp_path / f"{table}.dat").write_bytes(content)
        return str(tmp_path)

    return write
