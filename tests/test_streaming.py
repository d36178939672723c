"""Streams: late data, copies, restarts, and the same result as in batch."""

import json
import os
from dataclasses import replace
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from oreflow.fixtures import messages_from_lineitem
from oreflow.operators import dedup_stream, positions
from oreflow.plans import append_table, ensure_table
from oreflow.session import STATE_SETTINGS, session_conf
from oreflow.sources import Topic, read_table, write_topic
from oreflow.streaming import run_bronze, run_for, run_gold, run_silver, run_tail
from oreflow.streaming.jobs import AVAILABLE, GOLD_JOB, SILVER_JOB
from tests.conftest import SF_SMALL

LATE_FILES = [
    [("1", "10:00:00"), ("2", "10:00:00"), ("1", "10:00:00")],
    [("3", "20:00:00"), ("1", "20:00:00")],
    [("4", "12:00:00"), ("5", None), ("2", "21:00:00"), ("6", "18:00:00"), ("7", "18:00:01")],
]
LATE_SCHEMA = "trade_id string, portfolio_id string, ticker string, side string, quantity decimal(18,2), \
fees decimal(18,2), trade_value decimal(38,4), trade_timestamp timestamp"


class Feed:
    """Feeds files one at a time to a query on one checkpoint."""

    def __init__(self, spark, tmp_path, transform, mode="append", files=1):
        self.spark, self.transform, self.mode, self.files = spark, transform, mode, files
        self.source, self.out, self.checkpoint = (str(tmp_path / name) for name in ("in", "out", "checkpoint"))
        self.progress = []

    def add(self, rows):
        one = Decimal(1)
        data = [
            (i, "p", "A", "BUY", one, one, one, t and datetime.fromisoformat(f"2024-01-01 {t}")) for i, t in rows
        ]
        rows = self.spark.createDataFrame(data, LATE_SCHEMA).repartition(self.files)
        rows.write.mode("append").parquet(self.source)
        result = self.transform(self.spark.readStream.schema(LATE_SCHEMA).parquet(self.source))
        writer = result.writeStream.option("checkpointLocation", self.checkpoint).trigger(availableNow=True)
        with session_conf(self.spark, STATE_SETTINGS):
            if self.mode == "append":
                query = writer.format("parquet").option("path", self.out).start()
            else:
                query = (
                    writer.outputMode("complete")
                    .foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(self.out))
                    .start()
                )
            query.awaitTermination()
        self.progress += [state for step in query.recentProgress for state in step["stateOperators"]]
        return self.spark.read.parquet(self.out).collect()

    def total(self, metric, operator):
        return sum(state[metric] for state in self.progress if state["operatorName"] == operator)


def ids(rows):
    return sorted(row.trade_id for row in rows)


@pytest.mark.parametrize("salts", [1, 8])
def test_late_rows_and_copies(spark, tmp_path, salts):
    feed = Feed(spark, tmp_path, lambda s: dedup_stream(s, salts=salts))
    assert ids(feed.add(LATE_FILES[0])) == ["1", "2"]
    assert ids(feed.add(LATE_FILES[1])) == ["1", "2", "3"]
    assert ids(feed.add(LATE_FILES[2])) == ["1", "2", "3", "5", "7"]
    assert feed.total("numRowsRemoved", "dedupe") == 0
    first = "dedupe" if salts == 1 else "dedupeWithinWatermark"
    assert feed.total("numRowsDroppedByWatermark", first) == 2


def test_bounded_state_lets_an_id_in_again(spark, tmp_path):
    feed = Feed(spark, tmp_path, lambda s: dedup_stream(s, bounded=True))
    assert ids(feed.add(LATE_FILES[0])) == ["1", "2"]
    assert ids(feed.add(LATE_FILES[1])) == ["1", "2", "3"]
    assert ids(feed.add(LATE_FILES[2])) == ["1", "2", "2", "3", "5", "7"]
    assert feed.total("numRowsDroppedByWatermark", "dedupeWithinWatermark") == 2
    assert feed.total("numRowsRemoved", "dedupeWithinWatermark") >= 3


@pytest.mark.parametrize("fillers", [0, 5])
def test_bounded_ids_do_not_depend_on_the_task_that_reads_them(spark, tmp_path, fillers):
    """The second copy is dropped whichever task reads it; the third finds the id forgotten."""
    feed = Feed(spark, tmp_path, lambda s: dedup_stream(s, bounded=True))
    feed.add([("x", "10:00:00")])
    feed.add([(f"f{i}", "20:00:00") for i in range(fillers)] + [("x", "20:00:00")])
    rows = feed.add([("x", "20:30:00")])
    assert [i for i in ids(rows) if i == "x"] == ["x", "x"]
    with pytest.raises(ValueError, match="salts"):
        Feed(spark, tmp_path / "salted", lambda s: dedup_stream(s, bounded=True, salts=4)).add([("x", None)])


def test_positions_count_late_rows(spark, tmp_path):
    feed = Feed(spark, tmp_path, positions, mode="complete")
    totals = [feed.add(rows)[0].net_quantity for rows in LATE_FILES]
    assert totals == [Decimal(3), Decimal(5), Decimal(10)]
    assert feed.total("numRowsDroppedByWatermark", "stateStoreSave") == 0


def test_one_id_in_most_rows_is_spread(spark, tmp_path):
    """The hot id reaches the second pass at most once per salt, and over several salts."""
    rows = [("hot", "10:00:00")] * 3000 + [(f"cold{i}", "10:00:00") for i in range(500)]
    feed = Feed(spark, tmp_path, lambda s: dedup_stream(s, salts=3), files=16)
    assert ids(feed.add(rows)) == sorted(["hot"] + [f"cold{i}" for i in range(500)])
    first = [s for s in feed.progress if s["operatorName"] == "dedupeWithinWatermark"]
    assert max(s["numRowsUpdated"] for s in first) == 503
    second = [s for s in feed.progress if s["operatorName"] == "dedupe"]
    assert max(s["numRowsUpdated"] for s in second) == 501


def test_salts_follow_the_state_partitions(spark, tmp_path):
    (tmp_path / "in").mkdir()
    with session_conf(spark, {"spark.sql.shuffle.partitions": "77"}):
        stream = spark.readStream.schema(LATE_SCHEMA).parquet(str(tmp_path / "in"))
        salted, bounded = dedup_stream(stream), dedup_stream(stream, bounded=True)
    text = [df._jdf.queryExecution().analyzed().toString() for df in (salted, bounded)]
    assert "% 77" in text[0] and "%" not in text[1]


def test_state_is_in_rocksdb(spark, warehouse):
    ensure_table(spark, warehouse.bronze)
    append_table(spark.createDataFrame([("{}",)], "value string"), warehouse.bronze)
    query = run_silver(spark, warehouse, AVAILABLE)
    query.awaitTermination()
    assert any("rocksdb" in name for name in query.lastProgress["stateOperators"][0]["customMetrics"])
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


# ---- the jobs ------------------------------------------------------------------------


def message(trade_id, portfolio="p", ticker="aaa", side="buy", quantity=1.0, time="2024-01-01T10:00:00Z"):
    value = {
        "trade_id": trade_id,
        "portfolio_id": portfolio,
        "ticker": ticker,
        "side": side,
        "quantity": quantity,
        "price": 2.0,
        "fees": 0.5,
        "trade_timestamp": time,
    }
    return (trade_id, json.dumps(value))


def run_all(spark, topic, warehouse):
    for job in (
        lambda: run_bronze(spark, topic, warehouse, AVAILABLE),
        lambda: run_silver(spark, warehouse, AVAILABLE),
        lambda: run_gold(spark, warehouse, AVAILABLE),
    ):
        job().awaitTermination()


def gold(spark, warehouse):
    return {(r.portfolio_id, r.ticker): tuple(map(float, r[2:])) for r in read_table(spark, warehouse.gold).collect()}


def test_restarts_neither_lose_nor_double(spark, warehouse, tmp_path):
    topic = Topic("t", path=str(tmp_path / "topic"))

    def send(*messages):
        write_topic(spark.createDataFrame(list(messages), "key string, value string"), topic)
        run_all(spark, topic, warehouse)

    send(message("1"), message("2", side="sell", quantity=0.25), ("x", None), ("y", "{oops"))
    assert gold(spark, warehouse) == {("p", "AAA"): (0.75, 1.0, 2.5)}
    send(message("1", quantity=50.0), message("3", ticker="bbb"))
    assert gold(spark, warehouse) == {("p", "AAA"): (0.75, 1.0, 2.5), ("p", "BBB"): (1.0, 0.5, 2.0)}
    run_all(spark, topic, warehouse)
    assert read_table(spark, warehouse.bronze).count() == 6
    assert read_table(spark, warehouse.silver).count() == 3
    assert len(gold(spark, warehouse)) == 2


def test_tables_outlive_the_catalog(spark, warehouse, tmp_path):
    """After a restart without a metastore the folders are taken up again."""
    topic = Topic("t", path=str(tmp_path / "topic"))
    write_topic(spark.createDataFrame([message("1", ticker="007")], "key string, value string"), topic)
    run_all(spark, topic, warehouse)
    restarted = replace(warehouse, suffix=f"{warehouse.suffix}_again")
    run_all(spark, topic, restarted)
    assert gold(spark, restarted) == {("p", "007"): (1.0, 0.5, 2.0)}
    more = [message("1", ticker="007"), message("2", ticker="7")]
    write_topic(spark.createDataFrame(more, "key string, value string"), topic)
    run_all(spark, topic, restarted)
    assert read_table(spark, restarted.bronze).count() == 3
    assert gold(spark, restarted) == {("p", "007"): (1.0, 0.5, 2.0), ("p", "7"): (1.0, 0.5, 2.0)}


def test_an_update_or_a_delete_changes_nothing(spark, warehouse, tmp_path):
    topic = Topic("t", path=str(tmp_path / "topic"))
    deleted = json.dumps(json.loads(message("1")[1]) | {"__deleted": "true"})
    for rows in ([message("1", quantity=3.0)], [message("1", quantity=9.0)], [("1", deleted), ("1", None)]):
        write_topic(spark.createDataFrame(rows, "key string, value string"), topic)
        run_all(spark, topic, warehouse)
    assert [float(r.quantity) for r in read_table(spark, warehouse.silver).collect()] == [3.0]
    assert gold(spark, warehouse) == {("p", "AAA"): (3.0, 0.5, 6.0)}


def test_three_streams_equal_batch(spark, warehouse, tmp_path):
    topic = Topic("t", path=str(tmp_path / "topic"))
    write_topic(messages_from_lineitem(spark, SF_SMALL), topic)
    run_all(spark, topic, warehouse)
    silver = read_table(spark, warehouse.silver)
    assert silver.count() == silver.select("trade_id").distinct().count()
    in_batch = positions(silver)
    streamed = read_table(spark, warehouse.gold).select(in_batch.columns)
    assert streamed.count() > 0
    assert in_batch.exceptAll(streamed).isEmpty() and streamed.exceptAll(in_batch).isEmpty()


def test_gold_over_many_batches(spark, warehouse):
    """Small steps give the totals of one step."""
    ensure_table(spark, warehouse.silver)
    row = "'{0}' trade_id, 'p' portfolio_id, 'T{1}' ticker, 'BUY' side, 1 quantity, 1 price, 1 fees, now() trade_timestamp, 1 trade_value"
    for i in range(4):
        append_table(spark.sql(f"SELECT {row.format(i, i % 2)}"), warehouse.silver)
    query = run_gold(spark, warehouse, AVAILABLE, source_options={"maxFilesPerTrigger": "1"})
    query.awaitTermination()
    assert query.lastProgress["batchId"] >= 3
    assert gold(spark, warehouse) == {("p", "T0"): (2.0, 2.0, 2.0), ("p", "T1"): (2.0, 2.0, 2.0)}


def test_gold_can_be_read_before_its_first_batch(spark, warehouse):
    ensure_table(spark, warehouse.silver)
    run_gold(spark, warehouse, AVAILABLE).awaitTermination()
    assert read_table(spark, warehouse.gold).count() == 0


def test_a_table_is_filled_by_batches_or_by_a_stream(spark, warehouse, tmp_path):
    topic = Topic("t", path=str(tmp_path / "topic"))
    write_topic(spark.createDataFrame([message("1")], "key string, value string"), topic)
    run_bronze(spark, topic, warehouse, AVAILABLE).awaitTermination()
    rows = spark.createDataFrame([("{}",)], "value string")
    with pytest.raises(ValueError, match="stream"):
        append_table(rows, warehouse.bronze)
    ensure_table(spark, warehouse.silver)
    append_table(rows, warehouse.silver)
    with pytest.raises(ValueError, match="batch"):
        run_silver(spark, warehouse, AVAILABLE)


def test_rows_keep_their_numeric_looking_ticker(spark, warehouse, tmp_path):
    topic = Topic("t", path=str(tmp_path / "topic"))
    rows = [message("1", ticker="007"), message("2", ticker="7"), message("3", ticker=None)]
    write_topic(spark.createDataFrame(rows, "key string, value string"), topic)
    run_all(spark, topic, warehouse)
    for spec in (warehouse.bronze, warehouse.silver, warehouse.gold):
        table = read_table(spark, spec)
        assert table.schema["ticker"].dataType.simpleString() == "string"
        assert {r.ticker for r in table.collect()} == {"007", "7", None}


def test_a_task_writes_few_tickers_and_a_ticker_is_spread(spark, warehouse, tmp_path):
    topic = Topic("t", path=str(tmp_path / "topic"))
    write_topic(messages_from_lineitem(spark, SF_SMALL), topic)
    run_bronze(spark, topic, warehouse, AVAILABLE, rebalance=False).awaitTermination()
    with session_conf(spark, {"spark.sql.shuffle.partitions": "25"}):
        run_silver(spark, warehouse, AVAILABLE).awaitTermination()
        run_gold(spark, warehouse, AVAILABLE).awaitTermination()
    silver = read_table(spark, warehouse.silver)
    assert silver.count() == silver.select("trade_id").distinct().count() > 0
    name = F.input_file_name().alias("file")
    files = silver.select("ticker", name).distinct().groupBy("ticker").count()
    assert 1 < files.agg(F.max("count")).first()[0] <= 5
    # Two batches; 250 files in each were one for every task and ticker.
    assert files.agg(F.sum("count")).first()[0] <= 2 * 50
    assert read_table(spark, warehouse.gold).select(name).distinct().count() <= 50


def test_checkpoints_are_apart(warehouse):
    assert warehouse.checkpoint(SILVER_JOB) != warehouse.checkpoint(GOLD_JOB)
    assert warehouse.checkpoint(GOLD_JOB).startswith(warehouse.folder("gold"))


def test_tail_starts_at_the_end(spark, tmp_path):
    topic = Topic("t", path=str(tmp_path / "topic"))
    write_topic(spark.createDataFrame([("k0", "old")], "key string, value string"), topic)
    query = run_tail(spark, topic, sink="memory", options={"queryName": "tail"}, trigger={"processingTime": "0 seconds"})
    write_topic(spark.createDataFrame([("k1", "new")], "key string, value string"), topic)
    query.processAllAvailable()
    run_for(query, 0.1)
    assert not query.isActive
    assert [(r.topic, r.key, r.value) for r in spark.table("tail").collect()] == [("t", "k1", "new")]


def test_tail_to_the_console(spark, tmp_path):
    topic = Topic("t", path=str(tmp_path / "topic"))
    write_topic(spark.createDataFrame([("k", "v" * 200)], "key string, value string"), topic)
    query = run_tail(spark, topic, starting="earliest", trigger=AVAILABLE)
    query.awaitTermination()
    assert sum(step["numInputRows"] for step in query.recentProgress) == 1 and query.exception() is None


def test_a_tail_that_was_stopped_shows_what_came_meanwhile(spark, tmp_path):
    topic = Topic("t", path=str(tmp_path / "topic"))
    out = {"path": str(tmp_path / "out"), "checkpointLocation": str(tmp_path / "checkpoint")}

    def send(text):
        write_topic(spark.createDataFrame([(text,)], "value string"), topic)

    def tail():
        run_tail(spark, topic, sink="parquet", options=out, trigger=AVAILABLE).awaitTermination()
        return sorted(r.value for r in spark.read.schema("value string").parquet(out["path"]).collect())

    send("before")
    assert tail() == []
    send("stopped")
    assert tail() == ["stopped"]
    send("later")
    assert tail() == ["later", "stopped"]


def test_a_tail_shows_a_file_as_old_as_the_newest(spark, tmp_path):
    topic = Topic("t", path=str(tmp_path / "topic"))
    out = {"path": str(tmp_path / "out"), "checkpointLocation": str(tmp_path / "checkpoint")}

    def send(text):
        write_topic(spark.createDataFrame([(text,)], "value string"), topic)
        for file in (tmp_path / "topic").glob("*.parquet"):
            os.utime(file, (1_700_000_000, 1_700_000_000))

    send("before")
    run_tail(spark, topic, sink="parquet", options=out, trigger=AVAILABLE).awaitTermination()
    send("same second")
    run_tail(spark, topic, sink="parquet", options=out, trigger=AVAILABLE).awaitTermination()
    assert [r.value for r in spark.read.parquet(out["path"]).collect()] == ["same second"]
