"""Sessions for plain files, a Hive catalog, Iceberg or Delta.

Addresses come from the environment. Credentials are never set here: S3A and S3FileIO
find them through their own provider chain.
"""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import SparkSession

PROFILES = ("plain", "hive", "iceberg", "delta")

# Retry and wait long enough to ride out lost executors and busy networks.
RESILIENCE = {
    "spark.shuffle.io.maxRetries": "10",
    "spark.shuffle.io.retryWait": "15s",
    "spark.network.timeout": "300s",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def s3a_conf(env: Mapping[str, str]) -> dict[str, str]:
    """Object-store settings, if the environment names an endpoint."""
    endpoint = env.get("AWS_ENDPOINT_URL_S3") or env.get("AWS_ENDPOINT_URL")
    if not endpoint:
        return {}
    conf = {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(
            not endpoint.startswith("http://")
        ).lower(),
        "spark.hadoop.fs.s3a.fast.upload": "true",
        "spark.hadoop.fs.s3a.committer.name": "magic",
        "spark.hadoop.fs.s3a.committer.magic.enabled": "true",
    }
    if region := env.get("AWS_REGION"):
        conf["spark.hadoop.fs.s3a.endpoint.region"] = region
    return conf


def cloud_commit_conf() -> dict[str, str]:
    """Makes file writes use the S3A committer named above.

    Without it Spark renames files into place, which on an object store copies them.
    The classes are in Spark's hadoop-cloud module, which must be on the class path.
    """
    return {
        "spark.sql.sources.commitProtocolClass": (
            "org.apache.spark.internal.io.cloud.PathOutputCommitProtocol"
        ),
        "spark.sql.parquet.output.committer.class": (
            "org.apache.spark.internal.io.cloud.BindingParquetOutputCommitter"
        ),
    }


def _iceberg(env: Mapping[str, str], catalog: str) -> dict[str, str]:
    prefix = f"spark.sql.catalog.{catalog}"
    conf = {
        "spark.sql.extensions": (
            "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions"
        ),
        "spark.sql.catalog.spark_catalog": "org.apache.iceberg.spark.SparkSessionCatalog",
        prefix: "org.apache.iceberg.spark.SparkCatalog",
        f"{prefix}.type": "hive",
        "spark.sql.defaultCatalog": catalog,
    }
    if endpoint := env.get("AWS_ENDPOINT_URL_S3") or env.get("AWS_ENDPOINT_URL"):
        conf[f"{prefix}.io-impl"] = "org.apache.iceberg.aws.s3.S3FileIO"
        conf[f"{prefix}.s3.endpoint"] = endpoint
    return conf


def session_conf(
    profile: str = "plain",
    env: Mapping[str, str] | None = None,
    catalog: str = "lake",
    metastore_uri: str | None = None,
    warehouse: str | None = None,
    packages: str | None = None,
    default_fs: str | None = None,
    event_log_dir: str | None = None,
    cloud_committer: bool = False,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """The settings of a profile. ``extra`` wins; memory and cores belong there."""
    if profile not in PROFILES:
        raise ValueError(f"profile must be one of {', '.join(PROFILES)}, not {profile!r}")
    env = os.environ if env is None else env
    conf = {**RESILIENCE, **s3a_conf(env)}
    if profile != "plain":
        conf["spark.sql.catalogImplementation"] = "hive"
        if metastore_uri:
            conf["spark.hadoop.hive.metastore.uris"] = metastore_uri
    if profile == "iceberg":
        conf.update(_iceberg(env, catalog))
        if metastore_uri:
            conf[f"spark.sql.catalog.{catalog}.uri"] = metastore_uri
        if warehouse:
            conf[f"spark.sql.catalog.{catalog}.warehouse"] = warehouse
    elif warehouse:
        conf["spark.sql.warehouse.dir"] = warehouse
    if profile == "delta":
        conf["spark.sql.extensions"] = "io.delta.sql.DeltaSparkSessionExtension"
        conf["spark.sql.catalog.spark_catalog"] = "org.apache.spark.sql.delta.catalog.DeltaCatalog"
    if packages:
        conf["spark.jars.packages"] = packages
    if default_fs:
        conf["spark.hadoop.fs.defaultFS"] = default_fs
    if event_log_dir:
        conf["spark.eventLog.enabled"] = "true"
        conf["spark.eventLog.dir"] = event_log_dir
    if cloud_committer:
        conf.update(cloud_commit_conf())
    return {**conf, **(extra or {})}


def build_session(
    profile: str = "plain", app_name: str = "lakeload", master: str | None = None, **settings
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    return builder.config(map=session_conf(profile, **settings)).getOrCreate()
