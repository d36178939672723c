"""Topics, tables, sessions and scratch folders."""

import pytest
from pyspark.sql import functions as F

from oreflow import session
from oreflow.fixtures import messages_from_lineitem
from oreflow.operators import message_log, message_text
from oreflow.schemas import TOPIC_SCHEMA
from oreflow.scratch import scratch_folder
from oreflow.sources import Topic, read_topic, round_trip, stream_topic, topics, write_topic
from tests.conftest import SF_SMALL

@pytest.fixture
def topic(tmp_path):
    return Topic("orders", path=str(tmp_path / "topic"))


@pytest.fixture
def few(spark):
    """Three messages of the fixture, as text."""
    texts = message_text(messages_from_lineitem(spark, SF_SMALL)).where("value IS NOT NULL")
    rows = [(r.key, r.value) for r in texts.orderBy("value").limit(3).collect()]
    return spark.createDataFrame(rows, "key string, value string")


def test_messages_come_back(spark, topic, few):
    write_topic(few, topic)
    back = read_topic(spark, topic)
    assert back.schema == TOPIC_SCHEMA
    assert message_log(back).columns == ["topic", "partition", "offset", "timestamp", "key", "value"]
    assert sorted((r.key, r.value) for r in message_text(back).collect()) == sorted(map(tuple, few.collect()))
    assert {r.topic for r in back.collect()} == {"orders"}


def test_offsets_grow_and_do_not_repeat(spark, topic, few):
    write_topic(few.repartition(2), topic)
    last = read_topic(spark, topic).agg(F.max("offset")).first()[0]
    write_topic(few.repartition(2), topic)
    log = read_topic(spark, topic)
    assert log.count() == log.select("partition", "offset").distinct().count() == 6
    assert log.where(F.col("offset") > last).count() == 3


def test_round_trip_compares_messages(spark, topic, few):
    assert round_trip(few, topic) == 0
    assert round_trip(few, topic) == 0
    assert round_trip(few.union(few), topic) == 0
    other = Topic("other", path=topic.path + "-other", options={"pathGlobFilter": "nothing*"})
    assert round_trip(few, other) == 3


def test_round_trip_notices_a_write_that_does_nothing(spark, topic, few, monkeypatch):
    assert round_trip(few, topic) == 0
    monkeypatch.setattr(topics, "write_topic", lambda *_: None)
    assert round_trip(few, topic) == 3


def test_round_trip_reads_from_its_own_time_and_shuffles_its_own_messages(spark, topic, few):
    write_topic(few, topic)
    log = read_topic(spark, topic, "latest", since_millis=2_000_000_000_000)
    assert log.count() == 0
    text = log.where(F.col("key").cast("string").startswith("run"))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in text and "GreaterThanOrEqual(timestamp" in text


def test_bounded_kafka_read_from_a_time():
    class Reader:
        def format(self, name):
            return self

        def options(self, **options):
            self.given = options
            return self

        def load(self):
            return self.given

    class Session:
        read = Reader()

    kafka = Topic("t", servers="host:9092")
    options = read_topic(Session(), kafka, "latest", since_millis=5)
    assert options["startingTimestamp"] == "5" and options["endingOffsets"] == "latest"
    assert options["startingOffsetsByTimestampStrategy"] == "latest" and "startingOffsets" not in options
    assert read_topic(Session(), kafka)["startingOffsets"] == "earliest"


def test_messages_without_a_key(spark, topic):
    write_topic(spark.createDataFrame([("v",)], "value string"), topic)
    assert [(r.key, r.value) for r in message_text(read_topic(spark, topic)).collect()] == [(None, "v")]


def test_a_topic_is_kafka_or_files():
    with pytest.raises(ValueError):
        Topic("t")
    with pytest.raises(ValueError):
        Topic("t", servers="host:9092", path="/data")
    with pytest.raises(ValueError):
        stream_topic(None, Topic("t", path="/data"), starting="yesterday")


def test_kafka_options():
    topic = Topic("t", servers="host:9092", options={"maxRecordsPerPartition": "1000000"})
    assert topic.source_options() == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "t",
        "failOnDataLoss": "false",
        "maxRecordsPerPartition": "1000000",
    }
    assert Topic("t", servers="h", options={"failOnDataLoss": "true"}).source_options()["failOnDataLoss"] == "true"


def test_fixture_has_the_schema_of_a_topic(spark):
    messages = messages_from_lineitem(spark, SF_SMALL)
    assert [(f.name, f.dataType) for f in messages.schema] == [(f.name, f.dataType) for f in TOPIC_SCHEMA]


def test_settings_add_up():
    settings = session.iceberg_settings("rest", "http://host:8181", "s3://lake/", "http://store:9000")
    assert settings["spark.sql.catalog.rest.type"] == "rest"
    assert settings["spark.sql.catalog.rest.s3.endpoint"] == "http://store:9000"
    assert not any("key" in name or "secret" in name for name in settings)
    assert "spark.sql.catalog.rest.io-impl" not in session.iceberg_settings("rest", "u", "w")
    packages = session.package_settings(session.KAFKA_PACKAGE, session.ICEBERG_PACKAGE, ivy="/tmp/ivy")
    assert packages["spark.jars.packages"].count(",") == 1
    assert session.s3a_settings("https://s")["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "true"


def test_session_conf_is_put_back(spark):
    name, unset = "spark.sql.shuffle.partitions", "spark.sql.maxPlanStringLength"
    before = spark.conf.get(name)
    with session.session_conf(spark, {name: "3", "oreflow.test": "x", unset: "100"}):
        assert spark.conf.get(name) == "3"
        assert spark.conf.get("oreflow.test") == "x"
    assert spark.conf.get(name) == before
    assert spark.conf.get("oreflow.test", None) is None


def test_scratch_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_folder(spark, "a"), scratch_folder(spark, "a")
    assert first.startswith(shared) and first != second
