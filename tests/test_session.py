import pytest

from lakeload.session import build_session, cloud_commit_conf, session_conf

STORE = {"AWS_ENDPOINT_URL": "http://store.example:9000", "AWS_REGION": "us-east-1"}


def test_plain_profile_names_no_catalog_or_store():
    conf = session_conf("plain", env={})
    assert not [k for k in conf if "catalog" in k or "s3a" in k]


def test_store_settings_come_from_the_environment():
    conf = session_conf("plain", env=STORE)
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store.example:9000"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.endpoint.region"] == "us-east-1"
    assert conf["spark.hadoop.fs.s3a.committer.name"] == "magic"
    secure = session_conf("plain", env={"AWS_ENDPOINT_URL_S3": "https://store.example"})
    assert secure["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "true"


def test_credentials_never_reach_the_settings():
    env = {**STORE, "AWS_ACCESS_KEY_ID": "my-id", "AWS_SECRET_ACCESS_KEY": "my-secret"}
    for profile in ("plain", "hive", "iceberg", "delta"):
        assert not {"my-id", "my-secret"} & set(session_conf(profile, env=env).values())


def test_iceberg_profile():
    conf = session_conf(
        "iceberg",
        env=STORE,
        catalog="c",
        metastore_uri="thrift://meta.example:9083",
        warehouse="s3a://bucket/wh",
    )
    assert conf["spark.sql.catalog.c"] == "org.apache.iceberg.spark.SparkCatalog"
    assert conf["spark.sql.catalog.c.type"] == "hive"
    assert conf["spark.sql.catalog.c.uri"] == "thrift://meta.example:9083"
    assert conf["spark.sql.catalog.c.warehouse"] == "s3a://bucket/wh"
    assert conf["spark.sql.catalog.c.io-impl"] == "org.apache.iceberg.aws.s3.S3FileIO"
    assert conf["spark.sql.catalog.c.s3.endpoint"] == "http://store.example:9000"
    assert conf["spark.sql.defaultCatalog"] == "c"
    assert conf["spark.sql.extensions"].endswith("IcebergSparkSessionExtensions")
    assert conf["spark.sql.catalogImplementation"] == "hive"


def test_delta_profile():
    conf = session_conf("delta", env={}, packages="io.delta:delta-spark_2.13:4.0.0")
    assert conf["spark.sql.catalog.spark_catalog"].endswith("DeltaCatalog")
    assert conf["spark.sql.extensions"] == "io.delta.sql.DeltaSparkSessionExtension"
    assert conf["spark.jars.packages"] == "io.delta:delta-spark_2.13:4.0.0"


def test_hive_profile_event_log_committer_and_overrides():
    conf = session_conf(
        "hive",
        env={},
        metastore_uri="thrift://m:9083",
        warehouse="/wh",
        default_fs="s3a://bucket/",
        event_log_dir="/logs",
        cloud_committer=True,
        extra={"spark.network.timeout": "600s", "spark.executor.memory": "62G"},
    )
    assert conf["spark.hadoop.hive.metastore.uris"] == "thrift://m:9083"
    assert conf["spark.sql.warehouse.dir"] == "/wh"
    assert conf["spark.hadoop.fs.defaultFS"] == "s3a://bucket/"
    assert conf["spark.eventLog.enabled"] == "true"
    assert cloud_commit_conf().items() <= conf.items()
    assert conf["spark.network.timeout"] == "600s"
    assert conf["spark.executor.memory"] == "62G"


def test_unknown_profile_raises():
    with pytest.raises(ValueError):
        session_conf("hudi")


def test_built_session_has_the_settings(spark):
    built = build_session("plain", env={}, extra={"spark.sql.orc.filterPushdown": "true"})
    assert built.conf.get("spark.sql.adaptive.enabled") == "true"
