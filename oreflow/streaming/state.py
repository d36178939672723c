"""The state of the silver stream, laid out anew: the same ids in another number of state partitions."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from oreflow.operators.silver import LATENESS
from oreflow.plans import TableSpec

log = logging.getLogger("oreflow")

#: Rows that take an id into the state of a new checkpoint: the id and the time it counts from.
SEED_SCHEMA = "trade_id string, trade_timestamp timestamp"
# Names of the operators in Spark's description of a checkpoint (fixed values).
_FOR_EVER, _FOR_A_TIME = "dedupe", "dedupeWithinWatermark"


def seed_folder(checkpoint: str) -> str:
    return f"{checkpoint}-seed"


def operators(spark: SparkSession, checkpoint: str) -> dict[str, tuple[int, int]]:
    """The operators with state of a checkpoint: their number and state partitions, by name."""
    rows = spark.read.format("state-metadata").load(checkpoint).collect()
    return {r.operatorName: (r.operatorId, r.numPartitions) for r in rows}


def committed(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``batch, watermark``: each batch a checkpoint holds as done, with the watermark (ms) after it."""
    logs = spark.read.option("wholetext", "true").text(f"{checkpoint}/commits/[0-9]*")
    told = F.regexp_extract("value", r"(\{[\s\S]*\})", 1)
    return logs.select(
        F.col("_metadata.file_name").cast("long").alias("batch"),
        F.get_json_object(told, "$.nextBatchWatermarkMs").cast("long").alias("watermark"),
    )


def dedup_seeds(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What the deduplication of a checkpoint remembers, as rows of ``SEED_SCHEMA``.

    Read with Spark's state data source, in as many tasks as there are state partitions.  Ids kept for
    ever come without a time; ids kept for a while come with the time that gives them the same
    end again.  A row without id brings the watermark.
    """
    found = operators(spark, checkpoint)
    name = _FOR_EVER if _FOR_EVER in found else _FOR_A_TIME
    state = spark.read.format("statestore").option("operatorId", found[name][0]).load(checkpoint)
    time = F.lit(None).cast("timestamp")
    if name == _FOR_A_TIME:
        time = F.timestamp_micros(F.col("value.expiresAtMicros")) - F.expr(f"INTERVAL {LATENESS}")
    ids = state.select(F.col("key.trade_id").alias("trade_id"), time.alias("trade_timestamp"))
    last = committed(spark, checkpoint).agg(F.max_by("watermark", "batch").alias("watermark"))
    end = F.timestamp_millis("watermark") + F.expr(f"INTERVAL {LATENESS}")
    mark = last.where("watermark > 0").select(F.lit(None).cast("string").alias("trade_id"), end.alias("trade_timestamp"))
    return ids.unionByName(mark)


def files_in(spark: SparkSession, spec: TableSpec) -> int:
    """A number that changes when rows are added to the table."""
    if spec.is_iceberg:
        return spark.table(f"{spec.name}.snapshots").count()
    folder = spark._jvm.org.apache.hadoop.fs.Path(spec.location)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getFileCount()


def seeded(trades: DataFrame, folder: str, schema: Mapping[str, str], skip: bool) -> DataFrame:
    """``trades`` after the seeds in ``folder``, told apart by ``seed``; with ``skip`` the trades are read past."""
    spark = trades.sparkSession
    seeds = spark.readStream.schema(SEED_SCHEMA).parquet(folder)
    lacking = [F.lit(None).cast(kind).alias(name) for name, kind in schema.items() if name not in seeds.columns]
    seeds = seeds.select("*", *lacking, F.lit(True).alias("seed")).select(*schema, "seed")
    live = trades.select(*schema, F.lit(False).alias("seed"))
    return seeds.union(live.where(F.lit(False)) if skip else live)
