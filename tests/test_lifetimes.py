"""Streams over their lifetime: state laid out anew, failures, pace, idleness, losses; layouts by day."""

import re
import time
from collections import Counter
from dataclasses import replace
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from oreflow.plans import append_table, ensure_table, repartition_table
from oreflow.plans.lifecycle import change_statements, create_statements, partition_fields
from oreflow.queries import gold_pruned_read
from oreflow.schemas import TOPIC_SCHEMA
from oreflow.session import session_conf
from oreflow.sources import Topic, read_between, read_table, write_topic
from oreflow.streaming import (
    LossCounter,
    drop_read,
    listening,
    repartition_state,
    run_bronze,
    run_gold,
    run_silver,
    run_until_idle,
    supervised,
    uncommitted,
)
from oreflow.streaming.jobs import AVAILABLE, BRONZE_JOB, GOLD_JOB, SILVER_JOB
from oreflow.streaming.state import committed, dedup_seeds, operators
from tests.conftest import SF_SMALL
from tests.test_streaming import message


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def feed(spark, warehouse, rows, **more):
    """Messages through bronze; ``rows`` are arguments of ``message``."""
    topic = Topic("t", path=f"{warehouse.root}/topic")
    write_topic(spark.createDataFrame([message(*r) for r in rows], "key string, value string"), topic)
    run_bronze(spark, topic, warehouse, AVAILABLE, **more).awaitTermination()


def ids(spark, warehouse):
    return Counter(r.trade_id for table in warehouse.silver_tables for r in read_table(spark, table).collect())


def at(trade, time):
    return (trade, "p", "aaa", "buy", 1.0, time)


# ---- state ---------------------------------------------------------------------------


@pytest.mark.parametrize("salts", [1, 3])
def test_ids_and_watermark_go_over_to_another_number_of_partitions(spark, warehouse, salts):
    ensure_table(spark, warehouse.bronze)
    feed(spark, warehouse, [at(f"t{i}", "2024-01-01T10:00:00Z") for i in range(200)] + [at("end", "2024-01-02T00:00:00Z")])
    with session_conf(spark, {"spark.sql.shuffle.partitions": "2"}):
        run_silver(spark, warehouse, AVAILABLE, salts=salts).awaitTermination()
        following = repartition_state(spark, warehouse, 5, salts=salts)
    old, new = (w.checkpoint(SILVER_JOB) for w in (warehouse, following))
    assert old != new and operators(spark, old)["dedupe"][1] == 2 and operators(spark, new)["dedupe"][1] == 5
    assert dedup_seeds(spark, old).where("trade_id is not null").count() == 201
    marks = [committed(spark, c).agg(F.max("watermark")).first()[0] for c in (old, new)]
    assert marks[0] == marks[1] > 0
    # Known ids, one that is late, and a new one; with another number of partitions in the session.
    feed(spark, following, [at(f"t{i}", "2024-01-02T01:00:00Z") for i in range(200)] + [at("late", "2024-01-01T22:00:00Z"), at("new", "2024-01-02T02:00:00Z")])
    with session_conf(spark, {"spark.sql.shuffle.partitions": "3"}):
        run_silver(spark, following, AVAILABLE, salts=salts).awaitTermination()
    assert ids(spark, following) == Counter([*(f"t{i}" for i in range(200)), "end", "new"])
    with pytest.raises(ValueError, match="in use"):
        repartition_state(spark, warehouse, 7, salts=salts)
    # Gold counts the trades of both generations.
    with session_conf(spark, {"spark.sql.shuffle.partitions": "2"}):
        run_gold(spark, following, AVAILABLE).awaitTermination()
    assert read_table(spark, following.gold).agg(F.sum("net_quantity")).first()[0] == 202


def test_bounded_ids_keep_their_end(spark, warehouse):
    ensure_table(spark, warehouse.bronze)
    feed(spark, warehouse, [at("a", "2024-01-01T10:00:00Z"), at("b", "2024-01-01T11:30:00Z")])
    run_silver(spark, warehouse, AVAILABLE, bounded=True).awaitTermination()
    following = repartition_state(spark, warehouse, 3, bounded=True)
    # The watermark passes the end of a, 12:00, and not that of b, 13:30.
    feed(spark, following, [at("c", "2024-01-01T14:30:00Z")])
    run_silver(spark, following, AVAILABLE, bounded=True).awaitTermination()
    feed(spark, following, [at("a", "2024-01-01T14:31:00Z"), at("b", "2024-01-01T14:31:00Z")])
    run_silver(spark, following, AVAILABLE, bounded=True).awaitTermination()
    assert ids(spark, following) == Counter({"a": 2, "b": 1, "c": 1})


# ---- failures ------------------------------------------------------------------------


def test_a_batch_that_the_sink_has_is_not_written_again(spark, warehouse):
    rows = [at(f"t{i}", "2024-01-01T10:00:00Z") for i in range(20)]
    feed(spark, warehouse, rows)
    run_silver(spark, warehouse, AVAILABLE).awaitTermination()
    bronze, silver = read_table(spark, warehouse.bronze).count(), ids(spark, warehouse)
    assert uncommitted(spark, f"{warehouse.root}/nowhere") is None
    for job in (BRONZE_JOB, SILVER_JOB):
        assert uncommitted(spark, warehouse.checkpoint(job)) is not None
    feed(spark, warehouse, [])
    run_silver(spark, warehouse, AVAILABLE).awaitTermination()
    assert read_table(spark, warehouse.bronze).count() == bronze == 20
    assert ids(spark, warehouse) == silver == Counter(f"t{i}" for i in range(20))


def test_gold_goes_on_after_failures_and_gives_up_after_too_many(spark, warehouse):
    feed(spark, warehouse, [at(f"t{i}", "2024-01-01T10:00:00Z") for i in range(20)])
    run_silver(spark, warehouse, AVAILABLE).awaitTermination()
    calls = []

    def fail(batch):
        calls.append(batch)
        raise RuntimeError("no")

    with pytest.raises(StreamingQueryException, match="no"):
        supervised(lambda: run_gold(spark, warehouse, AVAILABLE, published=fail), attempts=2)
    assert calls == [0, 0]
    supervised(lambda: run_gold(spark, warehouse, AVAILABLE, published=calls.append))
    assert calls[2] == 0
    assert read_table(spark, warehouse.gold).agg(F.sum("net_quantity")).first()[0] == 20
    assert uncommitted(spark, warehouse.checkpoint(GOLD_JOB)) is not None
    run_gold(spark, warehouse, AVAILABLE).awaitTermination()
    assert read_table(spark, warehouse.gold).agg(F.sum("net_quantity")).first()[0] == 20


# ---- pace, idleness, losses ----------------------------------------------------------


def test_many_batches_in_a_run_and_the_watermark_between(spark, warehouse):
    spec = replace(warehouse.bronze, partition_by=())
    ensure_table(spark, spec)
    for hour in (12, 16, 20, 23):
        rows = [message(f"{hour}", time=f"2024-01-01T{hour:02}:00:00Z"), message(f"late{hour}", time=f"2024-01-01T{hour - 11:02}:00:00Z")]
        spark.createDataFrame(rows, "key string, value string").coalesce(1).selectExpr(
            "key", "value", "current_timestamp() AS ingest_timestamp", "'AAA' AS ticker"
        ).write.mode("append").saveAsTable(spec.name)
    query = run_silver(spark, warehouse, AVAILABLE, source_options={"maxFilesPerTrigger": "1"})
    query.awaitTermination()
    marks = [p["eventTime"].get("watermark") for p in query.recentProgress if p["numInputRows"]]
    assert len(marks) == 4 and marks == sorted(marks) and len(set(marks)) == 4
    # A batch drops what was behind the watermark of the batch before it.
    assert ids(spark, warehouse) == Counter(["12", "16", "20", "23", "late12", "late16"])


def test_a_running_stream_stops_when_idle(spark, warehouse):
    topic = Topic("t", path=f"{warehouse.root}/topic", options={"maxFilesPerTrigger": "1"})
    for i in range(4):
        write_topic(spark.createDataFrame([message(f"t{i}")], "key string, value string").coalesce(1), topic)
    query = run_bronze(spark, topic, warehouse)
    assert run_until_idle(spark, query, triggers=2) and not query.isActive
    assert read_table(spark, warehouse.bronze).count() == 4
    ended = run_bronze(spark, topic, warehouse, AVAILABLE)
    ended.awaitTermination()
    assert run_until_idle(spark, ended)


def test_a_busy_stream_is_not_stopped_by_the_clock(spark):
    rate = spark.readStream.format("rate").option("rowsPerSecond", 10).load()
    query = rate.writeStream.format("noop").trigger(processingTime="100 milliseconds").start()
    try:
        assert not run_until_idle(spark, query, triggers=1000, seconds=2) and query.isActive
    finally:
        query.stop()


def test_late_rows_are_counted(spark, warehouse):
    with listening(spark, LossCounter()) as counter:
        feed(spark, warehouse, [at("a", "2024-01-01T20:00:00Z")])
        run_silver(spark, warehouse, AVAILABLE).awaitTermination()
        feed(spark, warehouse, [at("b", "2024-01-01T10:00:00Z"), at("c", "2024-01-01T18:00:00Z"), at("d", "2024-01-01T18:00:01Z")])
        run_silver(spark, warehouse, AVAILABLE).awaitTermination()
        counter.wait_idle(spark)
    assert sum(counter.late.values()) == 2 and ids(spark, warehouse) == Counter(["a", "d"])


def test_lost_files_are_counted(spark, warehouse):
    """Two files are gone when the batch that took them up is run again after a failure."""
    topic = Topic("t", path=f"{warehouse.root}/topic")
    for i in range(5):
        write_topic(spark.createDataFrame([message(f"t{i}")], "key string, value string").coalesce(1), topic)
    gone = sorted(Path(topic.path).glob("part-*"))[:2]
    whole = [f.read_bytes() for f in gone]
    for f in gone:
        f.write_bytes(b"not a file of rows")
        f.with_name(f".{f.name}.crc").unlink(missing_ok=True)
    with pytest.raises(StreamingQueryException):
        run_bronze(spark, topic, warehouse, AVAILABLE).awaitTermination()
    for f in gone:
        f.unlink()
    assert len(whole) == 2
    with listening(spark, LossCounter()) as counter:
        query = run_bronze(spark, topic, warehouse, AVAILABLE)
        query.awaitTermination()
        write_topic(spark.createDataFrame([message("later")], "key string, value string").coalesce(1), topic)
        again = run_bronze(spark, topic, warehouse, AVAILABLE)
        again.awaitTermination()
        counter.wait_idle(spark)
    assert read_table(spark, warehouse.bronze).count() == 4
    assert counter.lost_files(spark, again, warehouse.checkpoint(BRONZE_JOB)) == 2


def test_what_a_stream_is_done_with_can_go(spark, warehouse):
    """Files of a batch that would run again stay, and so do those that no batch has taken up."""
    topic = Topic("t", path=f"{warehouse.root}/a topic %41")
    checkpoint = warehouse.checkpoint(BRONZE_JOB)

    def send(key):
        write_topic(spark.createDataFrame([message(key)], "key string, value string").coalesce(1), topic)

    def left():
        return sorted(r.key.decode() for r in spark.read.schema(TOPIC_SCHEMA).parquet(topic.path).collect())

    def run():
        run_bronze(spark, topic, warehouse, AVAILABLE).awaitTermination()

    send("t0")
    assert drop_read(spark, topic, checkpoint) == 0 and left() == ["t0"]
    run()
    send("t1")
    assert drop_read(spark, topic, checkpoint) == 1 and left() == ["t1"]
    run()
    send("t2")
    uncommitted(spark, checkpoint)
    assert drop_read(spark, topic, checkpoint) == 0 and left() == ["t1", "t2"]
    run()
    assert drop_read(spark, topic, checkpoint) == 2 and left() == []
    assert drop_read(spark, topic, checkpoint) == 0
    run()
    assert Counter(r.key for r in read_table(spark, warehouse.bronze).collect()) == {"t0": 1, "t1": 1, "t2": 1}
    with pytest.raises(ValueError, match="Kafka"):
        drop_read(spark, Topic("t", servers="host:9092"), checkpoint)


# ---- layouts -------------------------------------------------------------------------


def silver_rows(spark):
    days = [datetime(2024, 1, 1 + i % 5, i % 24) for i in range(60)] + [None]
    rows = [(f"t{i}", f"T{i % 3}", t) for i, t in enumerate(days)]
    return spark.createDataFrame(rows, "trade_id string, ticker string, trade_timestamp timestamp")


def test_days_as_a_partition_field_and_without(spark, warehouse):
    days = replace(warehouse.silver, partition_by=("days(trade_timestamp)", "ticker"))
    ensure_table(spark, days)
    ensure_table(spark, days)
    append_table(silver_rows(spark), days)
    assert [days.partition_field(c) for c in partition_fields(spark, days.name)] == list(days.partition_by)
    assert read_table(spark, days).columns == list(days.columns) and read_table(spark, days).count() == 61
    part = read_between(spark, days, "trade_timestamp", "2024-01-02 03:00:00", "2024-01-03")
    want = [r for r in silver_rows(spark).collect() if r[2] and datetime(2024, 1, 2, 3) <= r[2] < datetime(2024, 1, 3)]
    assert sorted(r.trade_id for r in part.collect()) == sorted(r[0] for r in want)
    filters = re.search(r"PartitionFilters: \[([^\]]*)", plan(part)).group(1)
    assert "trade_timestamp_day" in filters
    assert {f.split("trade_timestamp_day=")[1].split("/")[0] for f in part.inputFiles()} <= {"2024-01-02", "2024-01-03"}
    # The field is dropped, and added, by a copy.
    plain = replace(days, name=f"{days.name}_plain", location=f"{days.location}_plain", partition_by=("ticker",))
    repartition_table(spark, days.name, plain)
    assert partition_fields(spark, plain.name) == ["ticker"] and "trade_timestamp_day" not in spark.table(plain.name).columns
    again = replace(days, name=f"{days.name}_again", location=f"{days.location}_again", partition_by=("days(trade_timestamp)",))
    repartition_table(spark, plain.name, again)
    for table in (plain, again):
        rows = read_between(spark, table, "trade_timestamp", "2024-01-02 03:00:00", "2024-01-03").collect()
        assert sorted(r.trade_id for r in rows) == sorted(r[0] for r in want)
    with pytest.raises(ValueError, match="repartition_table"):
        ensure_table(spark, replace(days, partition_by=("ticker",)))


def test_days_in_iceberg_statements(warehouse):
    spec = replace(warehouse.silver, format="iceberg", partition_by=("days(trade_timestamp)",))
    assert "PARTITIONED BY (days(trade_timestamp))" in create_statements(spec)[1]
    assert "trade_timestamp_day" not in create_statements(spec)[1] and spec.day_columns == {}
    dropped = replace(spec, partition_by=("ticker",), retired_partitions=("days(trade_timestamp)",))
    text = " ".join(change_statements(dropped, spec.columns, ["days(trade_timestamp)"]))
    assert "DROP PARTITION FIELD days(trade_timestamp)" in text and "ADD PARTITION FIELD ticker" in text


def test_a_stream_writes_into_folders_by_day(spark, warehouse):
    topic = Topic("t", path=f"{warehouse.root}/topic")
    write_topic(spark.createDataFrame([message("a"), message("b")], "key string, value string"), topic)
    spec = replace(warehouse.bronze, partition_by=("days(ingest_timestamp)",))
    run_bronze(spark, topic, warehouse, AVAILABLE, spec=spec).awaitTermination()
    today = spark.sql("SELECT current_date()").first()[0]
    table = read_between(spark, spec, "ingest_timestamp", f"{today} 00:00:00", "2100-01-01")
    assert read_table(spark, spec).count() == 2 and table.count() in (0, 2)


def test_a_column_is_added_under_a_stream(spark, warehouse):
    topic = Topic("t", path=f"{warehouse.root}/topic")
    wide = replace(warehouse.bronze, partition_by=())
    narrow = replace(wide, columns={c: k for c, k in wide.columns.items() if c != "ticker"})
    for i, spec in enumerate((narrow, wide, wide)):
        write_topic(spark.createDataFrame([message(f"t{i}")], "key string, value string"), topic)
        run_bronze(spark, topic, warehouse, AVAILABLE, spec=spec).awaitTermination()
    assert sorted((r.key, r.ticker) for r in read_table(spark, wide).collect()) == [("t0", None), ("t1", "AAA"), ("t2", "AAA")]


def test_one_ticker_is_read_from_one_folder(spark):
    rows = gold_pruned_read(spark, SF_SMALL)
    text = plan(rows)
    assert re.search(r"PartitionFilters: \[[^\]]*ticker[^\]]* = TKR3", text)
    assert rows.count() > 0 and {f.rsplit("/", 2)[1] for f in rows.inputFiles()} == {"ticker=TKR3"}
    # The statistics of the version are in the catalog before readers are sent to it.
    version = re.search(r"(gold_\w+)\.(portfolio_positions__v\w+)", text, re.IGNORECASE)
    stats = spark.sql(f"DESCRIBE EXTENDED {version.group(1)}.{version.group(2)}").where("col_name = 'Statistics'").first()
    assert "rows" in stats.data_type
