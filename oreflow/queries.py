"""The registered queries: each runs one part of the pipeline over the whole ``lineitem`` table.

Amounts are DECIMAL in the pipeline and its tables.  The results here show them as text, which has
every digit and the scale, because the two engines of the check hand out decimals of different width.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from oreflow.fixtures import OFFSET, TOPIC_NAME, messages_from_lineitem
from oreflow.functions import signed_quantity
from oreflow.operators import (
    dedup_batch,
    message_log,
    message_text,
    parse,
    positions,
    to_bronze,
    typed,
    usable,
)
from oreflow.plans import (
    Warehouse,
    append_table,
    drop_table,
    ensure_table,
    publish,
    repartition_table,
)
from oreflow.scratch import scratch_folder
from oreflow.session import FILE_SETTINGS, session_conf
from oreflow.sources import Topic, read_between, read_table, read_topic, write_topic
from oreflow.streaming import (
    LossCounter,
    drop_read,
    listening,
    repartition_state,
    run_bronze,
    run_gold,
    run_silver,
    run_tail,
    run_until_idle,
    supervised,
    uncommitted,
)
from oreflow.streaming.jobs import AVAILABLE, BRONZE_JOB, SILVER_JOB

# All files in one micro-batch, so that no row is behind a watermark.
ONE_BATCH = {"maxFilesPerTrigger": str(2**31 - 1)}


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as text."""
    return df.select(
        *(
            F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema
        )
    )


# ---- batch ---------------------------------------------------------------------------


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_bronze(messages_from_lineitem(spark, sf_dir))


# Where a message stands in the topic: its order of arrival.
ARRIVAL = ("partition", "offset")


def _arrived(messages: DataFrame) -> DataFrame:
    """The first usable trade per id, with its place in the topic."""
    bronze = to_bronze(messages, keep=ARRIVAL)
    return dedup_batch(usable(typed(parse(bronze, keep=ARRIVAL))), arrival=ARRIVAL)


def _first_copies(messages: DataFrame) -> DataFrame:
    """The messages that ``_arrived`` is made of.

    They go through the ranking whole, usable ones only: messages are read once, and those that are no
    first copy are not shuffled for a join.  Equals in the order of arrival all stay; a trade whose first
    copy has no known place is left out.
    """
    carried = (*ARRIVAL, "message")
    whole = messages.withColumn("message", F.struct(*messages.columns))
    trades = usable(typed(parse(to_bronze(whole, keep=carried), keep=carried)))
    place = F.rank().over(Window.partitionBy("trade_id").orderBy(*ARRIVAL))
    first = trades.withColumn("place", place).where("place = 1 AND message.key = CAST(trade_id AS binary)")
    return first.dropna(subset=list(ARRIVAL)).select("message.*")


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _arrived(messages_from_lineitem(spark, sf_dir)).drop(*ARRIVAL)


def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bronze(spark, sf_dir).select("key", "value", "ticker")


def bronze_ticker_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bronze(spark, sf_dir).groupBy("ticker").agg(F.count("*").alias("n_messages"))


def message_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return message_log(messages_from_lineitem(spark, sf_dir))


def message_short_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return message_text(messages_from_lineitem(spark, sf_dir))


def silver_parse_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse(_bronze(spark, sf_dir)).withColumnRenamed("trade_timestamp", "time_text")


def silver_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed(parse(_bronze(spark, sf_dir))).select("trade_id", "trade_timestamp")


def silver_typed_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["trade_id", "ticker", "side", "quantity", "price", "fees", "trade_value"]
    return _plain(typed(parse(_bronze(spark, sf_dir))).select(*columns))


def silver_quality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(usable(typed(parse(_bronze(spark, sf_dir)))))


def silver_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_silver(spark, sf_dir))


def gold_signed_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    signed = signed_quantity().alias("signed_quantity")
    return _plain(_silver(spark, sf_dir).select("trade_id", "side", "quantity", signed))


def gold_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(positions(_silver(spark, sf_dir)))


# ---- tables --------------------------------------------------------------------------


def _warehouse(spark: SparkSession, label: str) -> Warehouse:
    """Tables of one run, apart from those of every other run."""
    return Warehouse(scratch_folder(spark, label), suffix=f"_{uuid.uuid4().hex[:12]}")


def table_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bronze table from before the ticker: add the column, lay it out anew, go on writing."""
    warehouse = _warehouse(spark, "evolution")
    bronze = _bronze(spark, sf_dir)
    new = warehouse.bronze
    with_ticker = replace(new, name=f"{new.name}_old", location=f"{new.location}_old", partition_by=())
    columns = {name: kind for name, kind in new.columns.items() if name != "ticker"}
    old = replace(with_ticker, columns=columns)
    ensure_table(spark, old)
    append_table(bronze.drop("ticker"), old)
    ensure_table(spark, with_ticker)
    repartition_table(spark, with_ticker.name, new)
    drop_table(spark, old)
    ensure_table(spark, replace(new, properties={"layout": "ticker"}))
    append_table(bronze, new)
    layout = spark.sql(f"SHOW TBLPROPERTIES {new.name} ('layout')").first()["value"]
    return read_table(spark, new).select("key", "value", "ticker", F.lit(layout).alias("layout"))


def gold_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions with copies counted, replaced by those without; readers see the latter only."""
    gold = _warehouse(spark, "replace").gold
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {gold.namespace} LOCATION '{gold.namespace_location}'")
    publish(positions(usable(typed(parse(_bronze(spark, sf_dir))))), gold)
    publish(positions(_silver(spark, sf_dir)), gold)
    return _plain(read_table(spark, gold))


def gold_bi_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a dashboard would ask of the gold table."""
    gold = _warehouse(spark, "read").gold
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {gold.namespace} LOCATION '{gold.namespace_location}'")
    publish(positions(_silver(spark, sf_dir)), gold)
    return _plain(
        spark.sql(
            f"""SELECT ticker, count(*) AS n_portfolios, sum(net_quantity) AS net_quantity,
                       sum(total_fees) AS total_fees, sum(total_value) AS total_value
                FROM {gold.name} GROUP BY ticker"""
        )
    )


def gold_pruned_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The positions of one ticker, through the view that readers use; one folder is opened for it."""
    gold = _warehouse(spark, "pruned").gold
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {gold.namespace} LOCATION '{gold.namespace_location}'")
    publish(positions(_silver(spark, sf_dir)), gold)
    return _plain(read_table(spark, gold).where("ticker = 'TKR3'"))


def days_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A year of trades from a table laid out by day, and from what that is after the day was dropped."""
    silver = _warehouse(spark, "days").silver
    days = replace(
        silver, name=f"{silver.name}_days", location=f"{silver.location}_days", partition_by=("days(trade_timestamp)",)
    )
    ensure_table(spark, days)
    append_table(_silver(spark, sf_dir), days)
    repartition_table(spark, days.name, silver)
    both = [
        read_between(spark, table, "trade_timestamp", "1998-01-01", "1999-01-01").withColumn("layout", F.lit(layout))
        for table, layout in ((days, "day"), (silver, "ticker"))
    ]
    return _plain(both[0].union(both[1]))


# ---- topics and streams --------------------------------------------------------------


def _topic(spark: SparkSession, sf_dir: str, folder: str) -> Topic:
    """The messages of the fixture as a topic of their own."""
    topic = Topic(TOPIC_NAME, path=f"{folder}/topic", options=ONE_BATCH)
    write_topic(messages_from_lineitem(spark, sf_dir), topic)
    return topic


def _state_partitions(spark: SparkSession):
    """One state partition per core of the cluster."""
    return session_conf(spark, {"spark.sql.shuffle.partitions": str(spark.sparkContext.defaultParallelism)})


def topic_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and values written to a topic and read back."""
    topic = Topic(TOPIC_NAME, path=f"{scratch_folder(spark, 'roundtrip')}/topic")
    write_topic(messages_from_lineitem(spark, sf_dir).select("key", "value"), topic)
    return to_bronze(read_topic(spark, topic)).select("key", "value", "ticker")


def stream_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Follow a topic from its current end: messages from before are not shown."""
    folder = scratch_folder(spark, "tail")
    topic = _topic(spark, sf_dir, folder)
    out = {"path": f"{folder}/out", "checkpointLocation": f"{folder}/checkpoint"}
    # The end is taken when the stream is made, so the first run finds nothing to show.
    run_tail(spark, topic, sink="parquet", options=out, trigger=AVAILABLE).awaitTermination()
    after = messages_from_lineitem(spark, sf_dir).withColumn("topic", F.lit("later"))
    write_topic(after, topic)
    run_tail(spark, topic, sink="parquet", options=out, trigger=AVAILABLE).awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("key", "topic", "partition", "offset", "value")


def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = _warehouse(spark, "bronze")
    run_bronze(spark, _topic(spark, sf_dir, warehouse.root), warehouse, AVAILABLE).awaitTermination()
    return read_table(spark, warehouse.bronze).select("key", "value", "ticker")


def _silver_of(
    spark: SparkSession, warehouse: Warehouse, parts: list[DataFrame | Callable[[Topic], DataFrame]], **options
) -> DataFrame:
    """The silver table after topics with these messages, one after the other; some are made from the topic so far."""
    ensure_table(spark, warehouse.bronze)
    topic = Topic(TOPIC_NAME, path=f"{warehouse.root}/topic", options=ONE_BATCH)
    for part in parts:
        write_topic(part(topic) if callable(part) else part, topic)
        run_bronze(spark, topic, warehouse, AVAILABLE).awaitTermination()
        with _state_partitions(spark):
            query = run_silver(spark, warehouse, AVAILABLE, source_options=ONE_BATCH, **options)
        query.awaitTermination()
    return _plain(read_table(spark, warehouse.silver))


def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first copies of all trades, then all messages: no copy comes out a second time."""
    warehouse = _warehouse(spark, "silver")
    messages = messages_from_lineitem(spark, sf_dir)
    return _silver_of(spark, warehouse, [_first_copies(messages), messages])


def stream_silver_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with bounded state; of the second run all usable trades are behind the watermark.

    A copy in front of it whose id is forgotten would come out again, which one being up to the run.
    """
    warehouse = _warehouse(spark, "bounded")
    messages = messages_from_lineitem(spark, sf_dir)

    def late(topic: Topic) -> DataFrame:
        fed = usable(typed(parse(to_bronze(read_topic(spark, topic)))))
        end = fed.agg((F.max("trade_timestamp") - F.expr("INTERVAL 2 HOURS")).alias("end"))
        return messages.join(F.broadcast(end), F.col("timestamp") <= F.col("end")).drop("end")

    return _silver_of(spark, warehouse, [_first_copies(messages), late], bounded=True)


def stream_silver_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages in two runs: what comes second is dropped where it is behind the watermark.

    First come the trades before the year 2000 but for line 7 of each order; so of the second
    run those of a line 7 are late if they are old, and the newer ones are not.  Each run has the
    first copy of each of its trades only, so that it is known which one stays.
    """
    warehouse = _warehouse(spark, "late")
    messages = messages_from_lineitem(spark, sf_dir)
    early = F.expr("coalesce(timestamp < '2000-01-01' AND CAST(key AS string) NOT LIKE '%-7', false)")
    parts = [_first_copies(messages.where(early)), _first_copies(messages.where(~early))]
    return _silver_of(spark, warehouse, parts)


def stream_silver_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows the runs of ``stream_silver_late`` took in and how many of them were dropped as late."""
    with listening(spark, LossCounter()) as counter:
        rows = stream_silver_late(spark, sf_dir)
        counter.wait_idle(spark)
    n_new = rows.count()
    return spark.createDataFrame([(n_new, sum(counter.late.values()))], "n_new long, n_late long")


#: Files of each part that one micro-batch takes in.
PACE = 4
_PART = """CASE WHEN timestamp < '1997-01-01' THEN 0 WHEN timestamp < '1999-01-01' THEN 1
    WHEN timestamp < '2000-07-01' THEN 2 ELSE 3 END
    + CASE WHEN CAST(key AS string) LIKE '%-7' THEN 1 WHEN CAST(key AS string) LIKE '%-6' THEN 2 ELSE 0 END"""


def stream_silver_paced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four micro-batches in one run, by the number of files each may take; the watermark moves in between.

    A part is the trades of some years but for lines 7 and 6, which come one and two parts later.  A batch
    drops what is behind the watermark of the batch before it, which knows the parts up to two
    before: lines 6 are late, lines 7 are not.  Parts have the first copy of each of their trades only.
    """
    warehouse = _warehouse(spark, "paced")
    bronze = replace(warehouse.bronze, partition_by=())
    ensure_table(spark, bronze)
    messages = messages_from_lineitem(spark, sf_dir).withColumn("part", F.least(F.expr(_PART), F.lit(3)))
    for part in range(4):
        rows = to_bronze(_first_copies(messages.where(F.col("part") == part)))
        files = rows.repartition(PACE, "key").select(*bronze.columns)
        with session_conf(spark, FILE_SETTINGS):
            files.write.format(bronze.format).mode("append").saveAsTable(bronze.name)
    with _state_partitions(spark):
        query = run_silver(spark, warehouse, AVAILABLE, source_options={"maxFilesPerTrigger": str(PACE)})
    query.awaitTermination()
    return _plain(read_table(spark, warehouse.silver))


def stream_silver_repartitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State made with 8 partitions goes on with 32: ids it knows do not come out again.

    First come the old trades; after the state was laid out anew all copies of those, and the new ones.
    """
    warehouse = _warehouse(spark, "repartitioned")
    messages = messages_from_lineitem(spark, sf_dir)
    path = f"{warehouse.root}/first"
    write_topic(_first_copies(messages), Topic(TOPIC_NAME, path=path))
    first = read_topic(spark, Topic(TOPIC_NAME, path=path))
    old, new = first.where("timestamp < '2000-01-01'"), first.where("timestamp >= '2000-01-01'")
    again = messages.join(old.select("key"), "key", "left_semi").select(*messages.columns)
    ensure_table(spark, warehouse.bronze)
    topic = Topic(TOPIC_NAME, path=f"{warehouse.root}/topic", options=ONE_BATCH)
    write_topic(old, topic)
    run_bronze(spark, topic, warehouse, AVAILABLE).awaitTermination()
    with session_conf(spark, {"spark.sql.shuffle.partitions": "8"}):
        run_silver(spark, warehouse, AVAILABLE, source_options=ONE_BATCH, salts=4).awaitTermination()
        following = repartition_state(spark, warehouse, 32, salts=4)
    write_topic(new.unionByName(again), topic)
    run_bronze(spark, topic, following, AVAILABLE).awaitTermination()
    run_silver(spark, following, AVAILABLE, source_options=ONE_BATCH, salts=4).awaitTermination()
    earlier, later = (read_table(spark, table) for table in following.silver_tables)
    return _plain(earlier.union(later))


def stream_silver_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze and silver die when their sinks have a batch that is not yet marked as done; both start again."""
    warehouse = _warehouse(spark, "recovered")
    messages = messages_from_lineitem(spark, sf_dir)
    topic = Topic(TOPIC_NAME, path=f"{warehouse.root}/topic", options=ONE_BATCH)
    for part in (_first_copies(messages), messages):
        write_topic(part, topic)
        for _ in range(2):
            run_bronze(spark, topic, warehouse, AVAILABLE).awaitTermination()
            uncommitted(spark, warehouse.checkpoint(BRONZE_JOB))
        with _state_partitions(spark):
            for _ in range(2):
                run_silver(spark, warehouse, AVAILABLE, source_options=ONE_BATCH).awaitTermination()
                uncommitted(spark, warehouse.checkpoint(SILVER_JOB))
    return _plain(read_table(spark, warehouse.silver))


def stream_gold_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first attempt at every batch fails when readers see its positions already; the job starts again."""
    warehouse = _warehouse(spark, "goldfail")
    ensure_table(spark, warehouse.silver)
    silver = _silver(spark, sf_dir).cache()
    seen: list[int] = []

    def fail_once(batch: int) -> None:
        seen.append(batch)
        if seen.count(batch) == 1:
            raise RuntimeError(f"first attempt at batch {batch}")

    for part in ("trade_timestamp < '1998-01-01'", "trade_timestamp >= '1998-01-01' OR trade_timestamp IS NULL"):
        append_table(silver.where(part), warehouse.silver)
        with _state_partitions(spark):
            # A run has a batch with the rows and may have one that only moves the watermark.
            supervised(lambda: run_gold(spark, warehouse, AVAILABLE, published=fail_once), attempts=4)
    silver.unpersist()
    return _plain(read_table(spark, warehouse.gold))


def stream_bronze_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream is stopped, its table gets a column, and it goes on: rows from before have NULL there."""
    warehouse = _warehouse(spark, "widened")
    wide = replace(warehouse.bronze, partition_by=())
    narrow = replace(wide, columns={name: kind for name, kind in wide.columns.items() if name != "ticker"})
    for spec in (narrow, wide, wide):
        topic = _topic(spark, sf_dir, warehouse.root)
        run_bronze(spark, topic, warehouse, AVAILABLE, spec=spec).awaitTermination()
        # Nothing else reads the topic, so that the disk need not hold on to what the table has.
        drop_read(spark, topic, warehouse.checkpoint(BRONZE_JOB))
    return read_table(spark, wide).select("key", "value", "ticker")


def stream_bronze_idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that would run for ever is stopped when it has found nothing new."""
    warehouse = _warehouse(spark, "idle")
    run_until_idle(spark, run_bronze(spark, _topic(spark, sf_dir, warehouse.root), warehouse))
    return read_table(spark, warehouse.bronze).select("key", "value", "ticker")


def stream_gold_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades in two runs, the newer ones first: positions count the late ones all the same."""
    warehouse = _warehouse(spark, "goldlate")
    ensure_table(spark, warehouse.silver)
    newer = "coalesce(trade_timestamp >= '2000-01-01', false)"
    silver = _silver(spark, sf_dir).cache()
    for part in (newer, f"NOT {newer}"):
        append_table(silver.where(part), warehouse.silver)
        with _state_partitions(spark):
            query = run_gold(spark, warehouse, AVAILABLE)
        query.awaitTermination()
    silver.unpersist()
    return _plain(read_table(spark, warehouse.gold))


def stream_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = _warehouse(spark, "gold")
    ensure_table(spark, warehouse.silver)
    append_table(_silver(spark, sf_dir), warehouse.silver)
    with _state_partitions(spark):
        query = run_gold(spark, warehouse, AVAILABLE)
    query.awaitTermination()
    return _plain(read_table(spark, warehouse.gold))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        bronze_ingest,
        bronze_ticker_extract,
        message_projection,
        message_short_projection,
        silver_parse_merge,
        silver_timestamps,
        silver_typed_value,
        silver_quality_filter,
        silver_dedup,
        gold_signed_quantity,
        gold_positions,
        table_evolution,
        gold_replace,
        gold_bi_read,
        topic_roundtrip,
        stream_tail,
        stream_bronze,
        stream_silver,
        stream_silver_bounded,
        stream_silver_late,
        stream_gold,
        stream_gold_late,
        gold_pruned_read,
        days_layout,
        stream_silver_losses,
        stream_silver_paced,
        stream_silver_repartitioned,
        stream_silver_recovered,
        stream_gold_recovered,
        stream_bronze_widened,
        stream_bronze_idle,
    )
}

# ---- the same in SQL, straight from lineitem -----------------------------------------

# What the messages say, and which of them silver can read: flat ones and payloads.  The
# other shapes stay in as rows whose fields are all NULL, as they do in the pipeline.
_MESSAGES = f"""
messages AS (
  SELECT cast(l_orderkey AS varchar) || '-' || cast(l_linenumber AS varchar) AS key,
         CASE l_orderkey % 5 WHEN 0 THEN 'flat' WHEN 1 THEN 'payload' WHEN 2 THEN 'after'
                             WHEN 3 THEN 'payload.after' ELSE 'tombstone' END AS shape,
         'tkr' || cast(l_partkey % 10 AS varchar) AS tkr, {OFFSET} AS "offset",
         cast(l_orderkey % 4 AS integer) AS "partition", *
  FROM lineitem),
trades AS (
  SELECT *, '{{"trade_id":"' || key || '","portfolio_id":"P' || l_suppkey || '","ticker":"' || tkr || '","side":"'
    || CASE l_returnflag WHEN 'A' THEN 'buy' WHEN 'R' THEN 'SELL' ELSE 'hold' END
    || '","quantity":' || cast(l_quantity + l_discount - 2 AS decimal(18,2))
    || ',"price":' || cast(l_extendedprice AS decimal(18,2)) || ',"fees":' || cast(l_tax AS decimal(18,2))
    || ',"trade_timestamp":' || CASE WHEN l_linenumber % 2 = 0 THEN cast(epoch_us(l_shipdate) AS varchar)
         ELSE strftime(l_shipdate, '"%Y-%m-%dT%H:%M:%SZ"') END || '}}' AS trade
  FROM messages),
bronze AS (
  SELECT *, CASE WHEN shape <> 'tombstone' THEN upper(tkr) END AS ticker,
         CASE shape WHEN 'flat' THEN trade WHEN 'payload' THEN '{{"schema":{{"type":"struct"}},"payload":' || trade || '}}'
                    WHEN 'after' THEN '{{"after":' || trade || '}}'
                    WHEN 'payload.after' THEN '{{"payload":{{"after":' || trade || '}}}}' END AS value
  FROM trades)"""

_READABLE = {
    "trade_id": "key",
    "portfolio_id": "'P' || cast(l_suppkey AS varchar)",
    "ticker": "tkr",
    "side": "CASE l_returnflag WHEN 'A' THEN 'buy' WHEN 'R' THEN 'SELL' ELSE 'hold' END",
    "quantity": "cast(cast(l_quantity + l_discount - 2 AS decimal(18,2)) AS double)",
    "price": "l_extendedprice",
    "fees": "l_tax",
    "time_text": "CASE WHEN l_linenumber % 2 = 0 THEN cast(epoch_us(l_shipdate) AS varchar) "
    "ELSE strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') END",
    "trade_timestamp": "l_shipdate",
}

_PARSED = f"""{_MESSAGES},
parsed AS (
  SELECT {", ".join(f"CASE WHEN shape IN ('flat', 'payload') THEN {sql} END AS {name}" for name, sql in _READABLE.items())},
         "partition", "offset"
  FROM messages)"""

_TYPED = f"""{_PARSED},
rounded AS (
  SELECT trade_id, portfolio_id, upper(ticker) AS ticker, upper(side) AS side,
         cast(quantity AS decimal(18,2)) AS quantity, cast(price AS decimal(18,2)) AS price,
         cast(fees AS decimal(18,2)) AS fees, trade_timestamp, "partition", "offset"
  FROM parsed),
typed AS (SELECT *, quantity * price AS trade_value FROM rounded)"""

_SILVER = f"""{_TYPED},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY trade_id ORDER BY "partition", "offset", portfolio_id,
                               ticker, side, quantity, price, fees, trade_timestamp) AS arrival
  FROM typed WHERE trade_id IS NOT NULL AND quantity > 0),
silver AS (SELECT * EXCLUDE (arrival) FROM ranked WHERE arrival = 1)"""

_GOLD = f"""{_SILVER},
gold AS (
  SELECT portfolio_id, ticker,
         sum(CASE side WHEN 'BUY' THEN quantity WHEN 'SELL' THEN -quantity ELSE 0 END) AS net_quantity,
         sum(fees) AS total_fees,
         sum(cast(trade_value AS decimal(18,2))) AS total_value
  FROM silver GROUP BY portfolio_id, ticker)"""


def _texts(*names: str) -> str:
    return ", ".join(f"cast({name} AS varchar) AS {name}" for name in names)


_AMOUNTS = _texts("quantity", "price", "fees", "trade_value")
_INGEST = f"WITH {_MESSAGES} SELECT key, value, ticker FROM bronze"
_TRADES = f"""trade_id, portfolio_id, ticker, side, trade_timestamp, {_AMOUNTS}"""
_ROWS = f"WITH {_SILVER} SELECT {_TRADES} FROM silver"
_LATE = f"""WITH {_TYPED},
fed AS (
  SELECT *, coalesce(trade_timestamp < '2000-01-01' AND trade_id NOT LIKE '%-7', false) AS early
  FROM typed WHERE trade_id IS NOT NULL AND quantity > 0),
firsts AS (
  SELECT *, row_number() OVER (PARTITION BY trade_id, early ORDER BY "partition", "offset", portfolio_id, ticker,
                               side, quantity, price, fees, trade_timestamp) AS arrival FROM fed),
mark AS (SELECT max(trade_timestamp) - INTERVAL 2 HOUR AS watermark FROM firsts WHERE early AND arrival = 1),
passed AS (
  SELECT *, row_number() OVER (PARTITION BY trade_id ORDER BY early DESC) AS run FROM firsts
  WHERE arrival = 1 AND (early OR trade_timestamp IS NULL OR trade_timestamp > (SELECT watermark FROM mark)))
SELECT {_TRADES} FROM passed WHERE run = 1"""
_LOST = f"""WITH {_LATE.removeprefix("WITH ").partition("SELECT " + _TRADES)[0]}
SELECT (SELECT count(*) FROM passed WHERE run = 1) AS n_new,
       (SELECT count(*) FROM firsts WHERE arrival = 1 AND NOT early AND trade_timestamp <= (SELECT watermark FROM mark)) AS n_late"""
_PACED = f"""WITH {_TYPED},
dealt AS (
  SELECT *, least(3, CASE WHEN trade_timestamp < '1997-01-01' THEN 0 WHEN trade_timestamp < '1999-01-01' THEN 1
                          WHEN trade_timestamp < '2000-07-01' THEN 2 ELSE 3 END
                     + CASE WHEN trade_id LIKE '%-7' THEN 1 WHEN trade_id LIKE '%-6' THEN 2 ELSE 0 END) AS part
  FROM typed WHERE trade_id IS NOT NULL AND quantity > 0),
firsts AS (
  SELECT *, row_number() OVER (PARTITION BY trade_id, part ORDER BY "partition", "offset", portfolio_id, ticker,
                               side, quantity, price, fees, trade_timestamp) AS arrival FROM dealt),
fed AS (SELECT * FROM firsts WHERE arrival = 1),
passed AS (
  SELECT *, row_number() OVER (PARTITION BY trade_id ORDER BY part) AS run FROM fed
  WHERE trade_timestamp IS NULL OR trade_timestamp > coalesce(
    (SELECT max(e.trade_timestamp) - INTERVAL 2 HOUR FROM fed e WHERE e.part <= fed.part - 2), '1900-01-01'))
SELECT {_TRADES} FROM passed WHERE run = 1"""
_YEAR = "trade_timestamp >= '1998-01-01' AND trade_timestamp < '1999-01-01'"
_POSITIONS = f"""WITH {_GOLD} SELECT portfolio_id, ticker,
    {_texts("net_quantity", "total_fees", "total_value")} FROM gold"""

ORACLE: dict[str, str] = {
    "bronze_ingest": _INGEST,
    "bronze_ticker_extract": f"WITH {_MESSAGES} SELECT ticker, count(*) AS n_messages FROM bronze GROUP BY ticker",
    "message_projection": f"""WITH {_MESSAGES} SELECT key, '{TOPIC_NAME}' AS topic, "partition", "offset",
        l_shipdate AS "timestamp", value FROM bronze""",
    "message_short_projection": f"""WITH {_MESSAGES} SELECT key, l_shipdate AS "timestamp", value FROM bronze""",
    "silver_parse_merge": f"WITH {_PARSED} SELECT * EXCLUDE (trade_timestamp, \"partition\", \"offset\") FROM parsed",
    "silver_timestamps": f"WITH {_TYPED} SELECT trade_id, trade_timestamp FROM typed",
    "silver_typed_value": f"WITH {_TYPED} SELECT trade_id, ticker, side, {_AMOUNTS} FROM typed",
    "silver_quality_filter": f"""WITH {_TYPED} SELECT trade_id, portfolio_id, ticker, side, trade_timestamp,
        {_AMOUNTS} FROM typed WHERE trade_id IS NOT NULL AND quantity > 0""",
    "silver_dedup": f"""WITH {_SILVER} SELECT trade_id, portfolio_id, ticker, side, trade_timestamp,
        {_AMOUNTS} FROM silver""",
    "gold_signed_quantity": f"""WITH {_SILVER} SELECT trade_id, side, {_texts("quantity")},
        cast(cast(CASE side WHEN 'BUY' THEN quantity WHEN 'SELL' THEN -quantity ELSE 0 END AS decimal(18,2)) AS varchar)
        AS signed_quantity
        FROM silver""",
    "gold_positions": _POSITIONS,
    "table_evolution": f"""WITH {_MESSAGES}
        SELECT key, value, CAST(NULL AS varchar) AS ticker, 'ticker' AS layout FROM bronze
        UNION ALL SELECT key, value, ticker, 'ticker' FROM bronze""",
    "gold_replace": _POSITIONS,
    "gold_bi_read": f"""WITH {_GOLD} SELECT ticker, count(*) AS n_portfolios,
        cast(sum(net_quantity) AS varchar) AS net_quantity, cast(sum(total_fees) AS varchar) AS total_fees,
        cast(sum(total_value) AS varchar) AS total_value FROM gold GROUP BY ticker""",
    "topic_roundtrip": _INGEST,
    "stream_tail": f"""WITH {_MESSAGES} SELECT key, 'later' AS topic, "partition", "offset", value
        FROM bronze""",
    "stream_bronze": _INGEST,
    "stream_silver": _ROWS,
    "stream_silver_bounded": _ROWS,
    "stream_silver_late": _LATE,
    "stream_gold": _POSITIONS,
    "stream_gold_late": _POSITIONS,
    "gold_pruned_read": f"{_POSITIONS} WHERE ticker = 'TKR3'",
    "days_layout": f"""WITH {_SILVER}
        SELECT {_TRADES}, layout FROM silver, (VALUES ('day'), ('ticker')) AS l(layout) WHERE {_YEAR}""",
    "stream_silver_losses": _LOST,
    "stream_silver_paced": _PACED,
    "stream_silver_repartitioned": _ROWS,
    "stream_silver_recovered": _ROWS,
    "stream_gold_recovered": _POSITIONS,
    "stream_bronze_widened": f"""WITH {_MESSAGES} SELECT key, value, CAST(NULL AS varchar) AS ticker FROM bronze
        UNION ALL SELECT key, value, ticker FROM bronze UNION ALL SELECT key, value, ticker FROM bronze""",
    "stream_bronze_idle": _INGEST,
}
