"""Tables as sources."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from oreflow.plans.specs import TableSpec


def read_table(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """The table as it is now, in the column order of its spec."""
    if not spec.is_iceberg:
        # The session may remember the files of an earlier read.
        spark.catalog.refreshTable(spec.name)
    return spark.table(spec.name).select(*spec.columns)


def read_between(spark: SparkSession, spec: TableSpec, column: str, first: str, end: str) -> DataFrame:
    """Rows of the table with ``first <= column < end``, both timestamps.

    In a table laid out by the days of ``column`` only the folders of those days are opened.  Iceberg
    derives that from the plain condition.
    """
    lo, hi = (F.lit(t).cast("timestamp") for t in (first, end))
    wanted = (F.col(column) >= lo) & (F.col(column) < hi)
    for day, source in spec.day_columns.items():
        if source == column:
            wanted &= (F.col(day) >= F.to_date(lo)) & (F.col(day) <= F.to_date(hi))
    if not spec.is_iceberg:
        spark.catalog.refreshTable(spec.name)
    return spark.table(spec.name).where(wanted).select(*spec.columns)


def stream_table(spark: SparkSession, spec: TableSpec, options: Mapping[str, str] | None = None) -> DataFrame:
    """Rows as they are appended to the table, from its first row on."""
    reader = spark.readStream.options(**(options or {}))
    if spec.is_iceberg:
        return reader.format("iceberg").load(spec.name)
    return reader.table(spec.name).select(*spec.columns)
