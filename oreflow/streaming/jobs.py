"""The jobs: each makes its table, starts one streaming query and returns it.

``trigger`` takes the arguments of ``DataStreamWriter.trigger``; without it a batch starts as
soon as the one before is done.  ``AVAILABLE`` works off what is there and stops.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from dataclasses import replace as changed
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from oreflow.operators import dedup_stream, message_log, parse, positions, to_bronze, typed, usable
from oreflow.operators.layout import gathered, rebalanced, state_partitions
from oreflow.plans import (
    KEEP_SECONDS,
    TableSpec,
    Warehouse,
    conform,
    ensure_published,
    ensure_table,
    is_streamed,
    laid_out,
    publish,
)
from oreflow.schemas import SILVER_COLUMNS
from oreflow.scratch import path_exists, remove_folder
from oreflow.session import STATE_SETTINGS, session_conf
from oreflow.sources import Topic, read_table, stream_table, stream_topic
from oreflow.streaming.state import dedup_seeds, files_in, seed_folder, seeded

AVAILABLE = {"availableNow": True}

log = logging.getLogger("oreflow")

# Names of the checkpoints.  A job whose keys or sums change needs a new name, since the state of
# the earlier version no longer fits; it then reads its source from the start.
BRONZE_JOB = "bronze_trades"
SILVER_JOB = "silver_trades"
GOLD_JOB = "gold_positions"


def _announce(spark: SparkSession, checkpoint: str) -> None:
    """Says at the first start what cannot be changed afterwards."""
    if not path_exists(spark, f"{checkpoint}/offsets"):
        log.warning(
            "first start of %s: %d state partitions, for good", checkpoint, state_partitions(spark)
        )


def _known(spark: SparkSession, spec: TableSpec) -> TableSpec:
    """``spec``, its table taken up again where the catalog does not know it, as after a restart without a metastore."""
    if not spark.catalog.tableExists(spec.name):
        ensure_table(spark, spec)
    return spec


def _writer(df: DataFrame, checkpoint: str, mode: str, trigger: Mapping | None) -> DataStreamWriter:
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger) if trigger else writer


def _append(df: DataFrame, spec: TableSpec, checkpoint: str, trigger: Mapping | None) -> StreamingQuery:
    writer = _writer(laid_out(df, spec), checkpoint, "append", trigger).format(spec.format)
    if not spec.is_iceberg:
        spark = df.sparkSession
        if not is_streamed(spark, spec) and not read_table(spark, spec).isEmpty():
            raise ValueError(f"{spec.name} was filled by a batch; a stream would hide those rows")
        writer = writer.partitionBy(*spec.partition_columns)
    # The sink of a stream goes by its options, not by the settings of the session that it starts from.
    return writer.options(**spec.file_options).toTable(spec.name)


def run_bronze(
    spark: SparkSession,
    topic: Topic,
    warehouse: Warehouse,
    trigger: Mapping | None = None,
    rebalance: bool = True,
    spec: TableSpec | None = None,
) -> StreamingQuery:
    """Append the topic to the bronze table, or one of another shape (``spec``).

    A column that ``spec`` has and the table lacks is added before the stream goes on; rows from before
    have NULL there.  ``rebalance`` shuffles by ticker for few and even files, splitting a busy ticker; without
    it every task writes a file per ticker.  Iceberg does this by itself.
    """
    spec = spec or warehouse.bronze
    ensure_table(spark, spec)
    rows = conform(to_bronze(stream_topic(spark, topic)), spec)
    if rebalance and not spec.is_iceberg:
        rows = rebalanced(rows, *(name for name in spec.partition_by if name in spec.columns))
    return _append(rows, spec, warehouse.checkpoint(BRONZE_JOB), trigger)


def run_silver(
    spark: SparkSession,
    warehouse: Warehouse,
    trigger: Mapping | None = None,
    bounded: bool = False,
    salts: int | None = None,
    spread: int | None = None,
    source_options: Mapping[str, str] | None = None,
    state_settings: Mapping[str, str] = STATE_SETTINGS,
    seeding: bool = False,
) -> StreamingQuery:
    """Append new trades to the silver table, one row per trade id.

    In a later generation of the warehouse the ids of the one before are known from its seeds;
    ``seeding`` is the run that takes them in, see ``repartition_state``.

    ``bounded`` and ``salts`` are those of ``dedup_stream``, ``spread`` is that of ``gathered``.  The
    number of state partitions is ``spark.sql.shuffle.partitions`` at the first start and stays
    with the checkpoint; as many tasks write the files.  Iceberg arranges its writes by itself.
    """
    spec = warehouse.silver
    ensure_table(spark, spec)
    trades = usable(typed(parse(stream_table(spark, _known(spark, warehouse.bronze), source_options))))
    if warehouse.generation > 1:
        folder = seed_folder(warehouse.checkpoint(SILVER_JOB))
        trades = seeded(trades, folder, SILVER_COLUMNS, skip=seeding)
        new = dedup_stream(trades, bounded=bounded, salts=salts).where("NOT seed")
    else:
        new = dedup_stream(trades, bounded=bounded, salts=salts)
    rows = conform(new, spec)
    if not spec.is_iceberg:
        rows = gathered(rows, spec.partition_by, spec.key, spread)
    _announce(spark, warehouse.checkpoint(SILVER_JOB))
    with session_conf(spark, state_settings):
        return _append(rows, spec, warehouse.checkpoint(SILVER_JOB), trigger)


def repartition_state(
    spark: SparkSession,
    warehouse: Warehouse,
    partitions: int,
    bounded: bool = False,
    salts: int | None = None,
    source_options: Mapping[str, str] | None = None,
) -> Warehouse:
    """The warehouse of the next generation, whose silver stream has its state in ``partitions`` partitions.

    The number of state partitions is fixed in a checkpoint, so the next generation gets a new one:
    the old stream is run to its end, the ids it remembers and its watermark are read from its
    state, and a first run of the new stream takes them in and reads past the bronze rows that the old
    one has read.  Neither silver rows nor bronze texts are read again.  No other job may add to
    bronze meanwhile; that is checked, and the attempt is then to be repeated.  ``bounded`` and
    ``salts`` are those of ``run_silver``, the same before and after.
    """
    following = changed(warehouse, generation=warehouse.generation + 1)
    checkpoint = following.checkpoint(SILVER_JOB)
    if path_exists(spark, f"{checkpoint}/offsets"):
        raise ValueError(f"{checkpoint} is in use already")
    before = files_in(spark, warehouse.bronze)
    run_silver(spark, warehouse, AVAILABLE, bounded, salts, source_options=source_options).awaitTermination()
    seeds = dedup_seeds(spark, warehouse.checkpoint(SILVER_JOB))
    seeds.write.mode("overwrite").parquet(seed_folder(checkpoint))
    with session_conf(spark, {"spark.sql.shuffle.partitions": str(partitions)}):
        run_silver(spark, following, AVAILABLE, bounded, salts, seeding=True).awaitTermination()
    if files_in(spark, warehouse.bronze) != before:
        remove_folder(spark, checkpoint)
        raise RuntimeError("bronze has grown meanwhile: stop the jobs that write it and repeat")
    return following


def run_gold(
    spark: SparkSession,
    warehouse: Warehouse,
    trigger: Mapping | None = None,
    spread: int | None = None,
    keep_seconds: float = KEEP_SECONDS,
    source_options: Mapping[str, str] | None = None,
    state_settings: Mapping[str, str] = STATE_SETTINGS,
    published: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Keep the gold table at the current positions: every batch replaces all of it.

    ``spread`` is that of ``gathered``; a replaced version stays for ``keep_seconds``.  ``published`` is
    called with the number of a batch once readers see it and before it counts as done; a batch
    that is run again after a failure calls it again.  Trades come from the silver tables of all
    generations; the checkpoint of a later one is new, as it has more sources, and reads them from the start.
    """
    spec = warehouse.gold
    ensure_published(spark, spec)

    def replace(batch: DataFrame, batch_id: int) -> None:
        publish(batch, spec, keep_seconds, spread)
        if published:
            published(batch_id)

    parts = [stream_table(spark, _known(spark, table), source_options) for table in warehouse.silver_tables]
    current = positions(reduce(DataFrame.union, parts))
    _announce(spark, warehouse.checkpoint(GOLD_JOB))
    with session_conf(spark, state_settings):
        writer = _writer(current, warehouse.checkpoint(GOLD_JOB), "complete", trigger)
        return writer.foreachBatch(replace).start()


def run_tail(
    spark: SparkSession,
    topic: Topic,
    starting: str = "latest",
    sink: str = "console",
    options: Mapping[str, str] | None = None,
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Show messages as they arrive, untruncated; or write them to another ``sink``.

    With a checkpoint in ``options`` a tail that starts again goes on where it stopped, whatever
    ``starting`` says.
    """
    mark = (options or {}).get("checkpointLocation")
    writer = message_log(stream_topic(spark, topic, starting, mark)).writeStream.outputMode("append")
    writer = writer.format(sink).options(**({"truncate": "false"} if sink == "console" else {}), **(options or {}))
    return (writer.trigger(**trigger) if trigger else writer).start()


def run_for(query: StreamingQuery, seconds: float) -> None:
    """Let a query run for a time, then stop it; raises if the query failed meanwhile."""
    query.awaitTermination(seconds)
    query.stop()
