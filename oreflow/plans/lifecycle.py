"""Creating, changing, replacing and dropping tables.  Every step is safe to repeat."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from oreflow.operators.layout import gathered, rebalanced
from oreflow.plans.specs import TableSpec
from oreflow.session import FILE_SETTINGS, session_conf


# How long a replaced version of a table stays readable.
KEEP_SECONDS = 3600.0


def create_statements(spec: TableSpec) -> list[str]:
    """Namespace and table, each only where missing."""
    place = f" LOCATION '{spec.namespace_location}'" if spec.namespace_location else ""
    stored = {**spec.columns, **dict.fromkeys(spec.day_columns, "date")}
    columns = ", ".join(f"{name} {kind}" for name, kind in stored.items())
    table = f"CREATE TABLE IF NOT EXISTS {spec.name} ({columns}) USING {spec.format}"
    if spec.partition_by:
        table += f" PARTITIONED BY ({', '.join(spec.partition_columns)})"
    if spec.location:
        table += f" LOCATION '{spec.location}'"
    if spec.properties:
        table += f" TBLPROPERTIES ({_pairs(spec.properties)})"
    return [f"CREATE NAMESPACE IF NOT EXISTS {spec.namespace}{place}", table]


def change_statements(spec: TableSpec, columns: Iterable[str], partitions: Iterable[str]) -> list[str]:
    """What takes a table with these columns and partition fields to ``spec``.

    Raises where the layout differs and the format cannot change it in place; see
    ``repartition_table`` for that.
    """
    columns, partitions = set(columns), list(partitions)
    statements = []
    missing = [f"{name} {kind}" for name, kind in spec.columns.items() if name not in columns]
    if missing:
        statements.append(f"ALTER TABLE {spec.name} ADD COLUMNS ({', '.join(missing)})")
    dropped = [name for name in partitions if name in spec.retired_partitions]
    added = [name for name in spec.partition_by if name not in partitions]
    if spec.is_iceberg:
        statements += [f"ALTER TABLE {spec.name} DROP PARTITION FIELD {name}" for name in dropped]
        statements += [f"ALTER TABLE {spec.name} ADD PARTITION FIELD {name}" for name in added]
    elif partitions != list(spec.partition_by):
        raise ValueError(
            f"{spec.name} is partitioned by {partitions}, not {list(spec.partition_by)}; "
            f"a {spec.format} table must be rewritten with repartition_table"
        )
    if spec.properties:
        statements.append(f"ALTER TABLE {spec.name} SET TBLPROPERTIES ({_pairs(spec.properties)})")
    return statements


def _pairs(properties: Mapping[str, str]) -> str:
    return ", ".join(f"'{key}' = '{value}'" for key, value in properties.items())


def partition_fields(spark: SparkSession, table: str) -> list[str]:
    """Partition fields of a table as its DDL writes them, such as ``days(ts)``."""
    ddl = spark.sql(f"SHOW CREATE TABLE {table}").first()[0]
    clause = re.search(r"^PARTITIONED BY \((.*)\)$", ddl, re.MULTILINE)
    fields = re.findall(r"[^,(\s]+(?:\([^)]*\))?", clause.group(1)) if clause else []
    return [name.replace("`", "") for name in fields]


def ensure_table(spark: SparkSession, spec: TableSpec) -> None:
    """Make the table exist with the columns, layout and properties of ``spec``."""
    namespace, table = create_statements(spec)
    spark.sql(namespace)
    if is_streamed(spark, spec) and not spark.catalog.tableExists(spec.name):
        # Over the folder of a stream, as after a restart without a metastore, Spark would
        # guess the type of the partition columns; so the table is made apart and moved there.
        spark.sql(create_statements(replace(spec, location=f"{spec.location}-new"))[1])
        spark.sql(f"ALTER TABLE {spec.name} SET LOCATION '{spec.location}'")
    else:
        spark.sql(table)
    have, fields = spark.table(spec.name).columns, partition_fields(spark, spec.name)
    if not spec.is_iceberg:
        fields = [spec.partition_field(name) for name in fields]
    for statement in change_statements(spec, have, fields):
        spark.sql(statement)
    if spec.location and not spec.is_iceberg:
        # A stream can only follow a folder that is there.
        fs, folder = _folder(spark, spec.location)
        fs.mkdirs(folder)


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def is_streamed(spark: SparkSession, spec: TableSpec) -> bool:
    """Whether a stream has written files to the table and so keeps the list of them.

    From then on only the files on that list are read.
    """
    if spec.is_iceberg or not spec.location:
        return False
    fs, log = _folder(spark, f"{spec.location}/_spark_metadata")
    return fs.exists(log)


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Columns of ``spec`` by name, in its order and types; what ``df`` lacks is NULL."""
    return df.select(
        *(
            (F.col(name) if name in df.columns else F.lit(None)).cast(kind).alias(name)
            for name, kind in spec.columns.items()
        )
    )


def laid_out(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """``rows`` with the date columns that the table keeps for ``days(...)`` partition fields."""
    days = {name: F.to_date(source) for name, source in spec.day_columns.items()}
    return rows.withColumns(days) if days else rows


def append_table(df: DataFrame, spec: TableSpec) -> None:
    """Add rows in one batch, in even files per partition; the table must exist.

    A file table takes rows from batches or from a stream, not from both.
    """
    if is_streamed(df.sparkSession, spec):
        raise ValueError(f"{spec.name} is written by a stream, which would hide rows added by a batch")
    rows = conform(df, spec)
    if spec.is_iceberg:
        rows.writeTo(spec.name).append()
        return
    rows = laid_out(rows, spec)
    writer = rebalanced(rows, *spec.partition_columns).write.format(spec.format).mode("append")
    with session_conf(df.sparkSession, FILE_SETTINGS):
        writer.partitionBy(*spec.partition_columns).saveAsTable(spec.name)


def repartition_table(spark: SparkSession, source: str, target: TableSpec) -> None:
    """Copy a table into a new one laid out as ``target``; the source stays as it is.

    Adds, drops or replaces partition fields, ``days(...)`` among them, where the format cannot do
    so in place.
    """
    ensure_table(spark, target)
    append_table(spark.table(source), target)


def drop_table(spark: SparkSession, spec: TableSpec) -> None:
    """Drop a table, or a published view with all its versions."""
    if spark.catalog.tableExists(spec.name) and spark.catalog.getTable(spec.name).tableType == "VIEW":
        spark.sql(f"DROP VIEW IF EXISTS {spec.name}")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {spec.name}")
    for version in _versions(spark, spec):
        _discard(spark, spec, version)


def publish(
    df: DataFrame, spec: TableSpec, keep_seconds: float = KEEP_SECONDS, spread: int | None = None
) -> None:
    """Replace the whole content of a table; readers see the old rows or the new ones.

    Iceberg replaces in one commit.  A Parquet table cannot, so the rows go to a new table
    and the name readers use is a view that is then pointed at it.  Every attempt writes a
    table of its own: a batch that runs again never touches what readers are looking at.  Its
    partitions are listed in the catalog, so a reader that asks for some of them, through the view too, opens
    no other folder; its statistics are taken before it is shown.
    A version stays for ``keep_seconds`` after it was replaced, for queries already running,
    however many come after it.  ``spread`` is that of ``gathered``, which arranges the write where
    there is no adaptive execution, as in a stream with state.
    """
    spark = df.sparkSession
    rows = conform(df, spec)
    if spec.is_iceberg:
        rows.writeTo(spec.name).overwrite(F.lit(True))
        return
    version = f"{spec.name}__v{time.time_ns() // 1_000_000:013d}_{uuid.uuid4().hex[:8]}"
    adaptive = spark.conf.get("spark.sql.adaptive.enabled") == "true"
    rows = rebalanced(rows, *spec.partition_by) if adaptive else gathered(rows, spec.partition_by, spec.key, spread)
    with session_conf(spark, FILE_SETTINGS):
        rows.write.format(spec.format).partitionBy(*spec.partition_by).saveAsTable(version)
    spark.sql(f"ANALYZE TABLE {version} COMPUTE STATISTICS")
    _point(spark, spec, version)
    for name in _outdated(spark, spec, version, keep_seconds):
        _discard(spark, spec, name)


def ensure_published(spark: SparkSession, spec: TableSpec) -> None:
    """Make a replaced table readable before its next content arrives.

    Where the catalog does not know it, as after a restart without a metastore, the newest
    version in the folder is taken up again; where there is none the table starts empty.
    """
    if spec.is_iceberg:
        ensure_table(spark, spec)
        return
    spark.sql(create_statements(spec)[0])
    if spark.catalog.tableExists(spec.name):
        return
    finished = [marker.getParent() for marker in _found(spark, f"{spec.location}__v*/_SUCCESS")]
    if not finished:
        publish(spark.createDataFrame([], ", ".join(f"{n} {k}" for n, k in spec.columns.items())), spec)
        return
    newest = max(finished, key=lambda folder: folder.getName())
    version = replace(spec, name=f"{spec.namespace}.{newest.getName()}", location=newest.toString())
    spark.sql(create_statements(version)[1])
    if spec.partition_by:
        spark.sql(f"MSCK REPAIR TABLE {version.name}")
    _point(spark, spec, version.name)


def _point(spark: SparkSession, spec: TableSpec, version: str) -> None:
    """From now on readers of ``spec`` get this version."""
    spark.sql(f"CREATE OR REPLACE VIEW {spec.name} AS SELECT {', '.join(spec.columns)} FROM {version}")


def _versions(spark: SparkSession, spec: TableSpec) -> list[str]:
    """Versions behind a published view, oldest first, in the catalog or only in the folder."""
    if spec.is_iceberg or not spark.catalog.databaseExists(spec.namespace):
        return []
    short = spec.name.rpartition(".")[2]
    names = {row.tableName for row in spark.sql(f"SHOW TABLES IN {spec.namespace} LIKE '{short}__v*'").collect()}
    names |= {folder.getName() for folder in _found(spark, f"{spec.location}__v*")}
    return [f"{spec.namespace}.{name}" for name in sorted(names)]


def _outdated(spark: SparkSession, spec: TableSpec, current: str, keep_seconds: float) -> list[str]:
    """Versions before the current one that were replaced, or given up, ``keep_seconds`` ago."""
    finished = {
        marker.getPath().getParent().getName(): marker.getModificationTime()
        for marker in _statuses(spark, f"{spec.location}__v*/_SUCCESS")
    }
    limit = time.time() * 1000 - keep_seconds * 1000
    out, replaced = [], None
    for name in reversed(_versions(spark, spec)):
        short = name.rpartition(".")[2]
        if name < current:
            # An attempt that was never finished counts from its start, which its name holds.
            since = replaced if short in finished else int(short.rpartition("__v")[2].partition("_")[0])
            if since is not None and since <= limit:
                out.append(name)
        if short in finished and name <= current:
            replaced = finished[short]
    return out


def _discard(spark: SparkSession, spec: TableSpec, version: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {version}")
    fs, folder = _folder(spark, f"{spec.namespace_location}/{version.rpartition('.')[2]}")
    fs.delete(folder, True)


def _found(spark: SparkSession, pattern: str) -> list:
    return [status.getPath() for status in _statuses(spark, pattern)]


def _statuses(spark: SparkSession, pattern: str) -> list:
    fs, path = _folder(spark, pattern)
    return list(fs.globStatus(path) or [])
