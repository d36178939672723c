"""Topics: Kafka, or a folder of Parquet files that logs one with the same columns."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from oreflow.schemas import TOPIC_SCHEMA
from oreflow.scratch import path_exists
from oreflow.session import FILE_SETTINGS, session_conf


#: Name of the observation that counts the files a stream over a Parquet log has read.
FILES_READ = "files_read"


@dataclass(frozen=True)
class Topic:
    """A topic by name, at Kafka ``servers`` or as Parquet files in ``path``.

    ``options`` go to the source as they are.  For a Kafka partition that holds much more
    than the others, ``maxRecordsPerPartition`` splits it over several tasks.
    """

    name: str
    servers: str | None = None
    path: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if (self.servers is None) == (self.path is None):
            raise ValueError("a topic needs either Kafka servers or a path")

    def source_options(self) -> dict[str, str]:
        """Missing data is passed over rather than failing the query."""
        if self.path:
            return {"ignoreMissingFiles": "true", **self.options}
        return {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.name,
            "failOnDataLoss": "false",
            **self.options,
        }


def read_topic(
    spark: SparkSession, topic: Topic, ending: str | None = None, since_millis: int | None = None
) -> DataFrame:
    """The topic from its start to ``ending``, by default what is there now.

    ``since_millis`` leaves out what is older, without reading it: Kafka finds the offsets by time, a
    Parquet log skips files by their statistics.
    """
    options = topic.source_options()
    if topic.path:
        log = spark.read.schema(TOPIC_SCHEMA).options(**options).parquet(topic.path)
        return log if since_millis is None else log.where(F.col("timestamp") >= F.timestamp_millis(F.lit(since_millis)))
    if since_millis is None:
        options["startingOffsets"] = "earliest"
    else:
        options["startingTimestamp"] = str(since_millis)
        options["startingOffsetsByTimestampStrategy"] = "latest"
    if ending:
        options["endingOffsets"] = ending
    return spark.read.format("kafka").options(**options).load()


def stream_topic(
    spark: SparkSession, topic: Topic, starting: str = "earliest", checkpoint: str | None = None
) -> DataFrame:
    """The topic as a stream, from its start or, with ``latest``, from its current end.

    For files the current end is the newest modification time among them and the files that have
    it, as the listing of the folder tells it; no file is opened for it.  As with Kafka it counts at
    the first start only: it is kept in the folder ``checkpoint`` and taken up again from there, so
    that what is written while the stream is stopped is not passed over.
    """
    if starting not in ("earliest", "latest"):
        raise ValueError(f"starting must be earliest or latest, not {starting}")
    options = topic.source_options()
    if not topic.path:
        return spark.readStream.format("kafka").options(**options, startingOffsets=starting).load()
    stream = spark.readStream.schema(TOPIC_SCHEMA).options(**options).parquet(topic.path)
    # A file that is gone when its batch is read is passed over; its first row is then not seen.
    stream = stream.observe(FILES_READ, F.count_if(F.col("_metadata.row_index") == 0).alias("files"))
    if starting == "earliest":
        return stream
    mark = f"{checkpoint.rstrip('/')}/oreflow-end" if checkpoint else None
    if mark and path_exists(spark, f"{mark}/_SUCCESS"):
        end = spark.read.schema(_END).parquet(mark).collect()
    else:
        end = _files_at_end(spark, topic).collect()
        if mark:
            spark.createDataFrame(end, _END).coalesce(1).write.mode("overwrite").parquet(mark)
    if not end:
        return stream
    written = F.unix_micros("_metadata.file_modification_time")
    later = (written == end[0]["written"]) & ~F.col("_metadata.file_path").isin([r["file"] for r in end])
    return stream.where((written > end[0]["written"]) | later)


def admitted(spark: SparkSession, checkpoint: str, after: int, upto: int) -> DataFrame:
    """``path`` of the files that a stream over a Parquet log took up with its batches ``after`` < number <= ``upto``.

    As its checkpoint lists them, with the number of the source's batch.
    """
    entries = spark.read.text(f"{checkpoint}/sources/0").where(F.col("value").startswith("{"))
    of = lambda name: F.get_json_object("value", f"$.{name}")
    named = entries.select(of("path").alias("path"), of("batchId").cast("long").alias("batch")).distinct()
    return named.where((F.col("batch") > after) & (F.col("batch") <= upto)).select("path")


# The newest modification time in a folder, with each file that has it.
_END = "written long, file string"


def _files_at_end(spark: SparkSession, topic: Topic) -> DataFrame:
    listing = spark.read.format("binaryFile").load(topic.path)
    files = listing.select(
        F.unix_micros("modificationTime").alias("written"), F.col("_metadata.file_path").alias("file")
    )
    newest = files.agg(F.max("written").alias("written"))
    return files.join(F.broadcast(newest), "written")


def write_topic(df: DataFrame, topic: Topic) -> None:
    """Append messages; ``df`` has a value and may have a key.

    A Parquet log keeps the columns of ``TOPIC_SCHEMA`` that ``df`` brings.  Those it lacks
    are filled in: the task is the partition, and offsets count on from the time of the
    write, so that they grow from one write to the next.
    """
    if not topic.path:
        columns = [name for name in ("key", "value") if name in df.columns]
        (
            df.select(*columns)
            .write.format("kafka")
            .option("kafka.bootstrap.servers", topic.servers)
            .option("topic", topic.name)
            .save()
        )
        return
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    start = F.shiftleft(F.unix_millis(F.current_timestamp()), 20)
    missing = {
        "key": F.lit(None),
        "topic": F.lit(topic.name),
        "partition": F.spark_partition_id(),
        "offset": start + row,
        "timestamp": F.current_timestamp(),
        "timestampType": F.lit(0),
    }
    columns = [
        (F.col(f.name) if f.name in df.columns else missing[f.name]).cast(f.dataType).alias(f.name)
        for f in TOPIC_SCHEMA
    ]
    with session_conf(df.sparkSession, FILE_SETTINGS):
        df.select(*columns).write.mode("append").parquet(topic.path)


#: How far the clocks of the topic and of this process may be apart.
CLOCK_SKEW_MILLIS = 600_000


def round_trip(messages: DataFrame, topic: Topic) -> int:
    """Write messages and count those that cannot be read back; 0 means the topic works.

    Every message carries the name of this run in front, so what was in the topic before, from an
    earlier check too, cannot stand for it.  Only messages from the time of the run are read, and
    only those of the run are compared.
    """
    run = f"run-{uuid.uuid4().hex}"
    named = [F.concat_ws(" ", F.lit(run), F.col(c).cast("string")).alias(c) for c in ("key", "value")]
    sent = messages.select(*named)
    started = time.time_ns() // 1_000_000
    write_topic(sent, topic)
    log = read_topic(messages.sparkSession, topic, "latest", started - CLOCK_SKEW_MILLIS)
    seen = log.select(F.col("key").cast("string"), F.col("value").cast("string"))
    return sent.exceptAll(seen.where(F.col("key").startswith(run))).count()
