"""Building sessions: settings are plain dicts that add up."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Connector coordinates for Scala 2.13, never run here: the Iceberg runtime named is the one for Spark
# 4.0, unverified on 4.1.  Pass others to package_settings where a cluster needs them.
KAFKA_PACKAGE = "org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2"
ICEBERG_PACKAGE = "org.apache.iceberg:iceberg-spark-runtime-4.0_2.13:1.10.0"
S3A_PACKAGE = "org.apache.hadoop:hadoop-aws:3.4.2"

# ANSI stays on (the Spark 4 default): every conversion that may fail is a try_ expression.
BASE_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}

# Silver keeps one state row per trade for ever, so state belongs on disk, with uploads of
# changes instead of whole snapshots at every commit.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Messages are long texts alike: zstd makes files of them that are about a third smaller than snappy's.
FILE_SETTINGS = {"spark.sql.parquet.compression.codec": "zstd"}


def package_settings(*coordinates: str, ivy: str | None = None) -> dict[str, str]:
    """Connector jars, fetched before the session starts."""
    settings = {"spark.jars.packages": ",".join(coordinates)}
    if ivy:
        settings["spark.jars.ivy"] = ivy
    return settings


def iceberg_settings(catalog: str, uri: str, warehouse: str, s3_endpoint: str | None = None) -> dict[str, str]:
    """An Iceberg REST catalog, with S3 file IO where an endpoint is given.

    Credentials are not part of it: they come from the environment of the process.
    """
    prefix = f"spark.sql.catalog.{catalog}"
    settings = {
        "spark.sql.extensions": "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions",
        prefix: "org.apache.iceberg.spark.SparkCatalog",
        f"{prefix}.type": "rest",
        f"{prefix}.uri": uri,
        f"{prefix}.warehouse": warehouse,
    }
    if s3_endpoint:
        settings |= {
            f"{prefix}.io-impl": "org.apache.iceberg.aws.s3.S3FileIO",
            f"{prefix}.s3.endpoint": s3_endpoint,
            f"{prefix}.s3.path-style-access": "true",
        }
    return settings


def s3a_settings(endpoint: str) -> dict[str, str]:
    """Object store access for checkpoints, which go through the Hadoop file system."""
    return {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(endpoint.startswith("https")).lower(),
    }


def build_session(
    app_name: str,
    settings: Mapping[str, str] | None = None,
    master: str | None = None,
    log_level: str = "WARN",
) -> SparkSession:
    """A session with the base settings, overridden by ``settings``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(log_level)
    return spark


@contextmanager
def session_conf(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Set runtime settings for the body only.

    A streaming query copies the session when it starts, so it keeps what the body set.
    """
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
