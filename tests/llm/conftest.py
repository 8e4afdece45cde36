import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_samples import AWKWARD, CLASHES, DOCS, SF_DIR  # noqa: E402


@pytest.fixture(scope="session")
def given(spark):
    from lakeload.llm.common import ship

    ship(spark)
    return lambda table: spark.read.parquet(f"{SF_DIR}/{table}.parquet")


@pytest.fixture(scope="session")
def make(spark):
    """A documents table of (doc_id, text) or (doc_id, text, source), with clashing columns."""
    from lakeload.llm.common import ship

    ship(spark)

    def table(rows, clash=True):
        rows = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        frame = spark.createDataFrame(rows, DOCS)
        for name in CLASHES if clash else ():
            frame = frame.withColumn(name, F.lit("x"))
        return frame

    return table


@pytest.fixture(scope="session")
def awkward(make):
    """Nulls, empty and very long texts, repeated rows, null and repeated ids."""
    return make([(i, t, None if i in (4, 8) else "s") for i, t in AWKWARD])


@pytest.fixture(scope="session")
def nothing(make):
    return make([])
