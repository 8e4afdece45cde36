"""Where intermediate data goes: the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


_local: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.

    Executors on other machines must see it, so a temporary local folder is only used
    where the setting is unset and the master is local, as in tests.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local:
        _local[context.applicationId] = tempfile.mkdtemp(prefix="lakeload-")
    return _local[context.applicationId]


def new_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path under the scratch root; the first write creates it."""
    return f"{scratch_root(spark)}/lakeload-{label}-{uuid.uuid4().hex[:12]}"
