"""What the streams move and write: messages are made in compiled code, ranked once, and stored with zstd."""

import re
from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from oreflow import queries
from oreflow.fixtures import messages_from_lineitem
from oreflow.operators import to_bronze
from oreflow.plans import append_table, ensure_table
from oreflow.queries import _arrived, _first_copies
from oreflow.sources import Topic, write_topic
from oreflow.streaming import run_bronze, run_silver
from oreflow.streaming.jobs import AVAILABLE

LINE = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, \
    l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"


def lines(spark, folder, rows):
    spark.createDataFrame([(*row[:8], row[8], "O", None) for row in rows], LINE).withColumn(
        "l_shipdate", F.expr("TIMESTAMP_NTZ'1999-03-04 00:00:00'")
    ).write.parquet(f"{folder}/lineitem.parquet")
    return messages_from_lineitem(spark, folder)


def plan(df, mode):
    modes = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode
    return df._jdf.queryExecution().explainString(modes.fromString(mode))


def codecs(folder):
    files = [f for f in Path(folder).rglob("*.parquet") if f.is_file()]
    metas = [pq.ParquetFile(f).metadata for f in files]
    return {m.row_group(g).column(0).compression for m in metas for g in range(m.num_row_groups)}


def test_messages_leave_null_fields_out_in_every_shape(spark, tmp_path):
    rows = [(n, 12, 3, 1, 5.0, 10.5, 0.25, None, "A") for n in range(5)] + [(5, None, None, 2, None, 0.0, 0.0, 0.02, None)]
    texts = {r.key: r.value for r in to_bronze(lines(spark, str(tmp_path), rows)).collect()}
    trade = (
        '{{"trade_id":"{}-1","portfolio_id":"P3","ticker":"tkr2","side":"buy","quantity":3.25,"price":10.50,'
        '"trade_timestamp":"1999-03-04T00:00:00Z"}}'
    )
    shapes = ["{}", '{{"schema":{{"type":"struct"}},"payload":{}}}', '{{"after":{}}}', '{{"payload":{{"after":{}}}}}']
    assert [texts[f"{n}-1"] for n in range(4)] == [shape.format(trade.format(n)) for n, shape in enumerate(shapes)]
    assert texts["4-1"] is None
    assert texts["5-2"] == (
        '{"trade_id":"5-2","side":"hold","price":0.00,"fees":0.02,"trade_timestamp":920505600000000}'
    )


def test_messages_are_made_in_code_that_the_jvm_compiles(spark, tmp_path):
    """HotSpot leaves methods of more than 8000 bytes of code to its interpreter."""
    text = plan(lines(spark, str(tmp_path), [(5, 12, 3, 1, 5.0, 10.5, 0.0, 0.02, "A")]), "codegen")
    assert max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)) < 8000


def test_first_copies_are_found_without_a_join(spark, tmp_path):
    """Of the copies of a trade the usable one with the smallest offset, all that are equal, none without a place."""
    copies = [(5, part, 3, 1, quantity, 10.5, 0.0, 0.02, "A") for part, quantity in ((7, 5.0), (4, 1.0), (5, 6.0), (5, 6.0))]
    messages = lines(spark, str(tmp_path), [*copies, (10, 2, 3, 1, 9.0, 1.0, 0.0, 0.0, "R"), (7, 2, 3, 1, 9.0, 1.0, 0.0, 0.0, "R"), (15, None, 3, 1, 9.0, 1.0, 0.0, 0.0, "R"), (15, 2, 3, 1, 9.0, 1.0, 0.0, 0.0, "R")])
    first = _first_copies(messages)
    assert first.columns == messages.columns
    assert "Join" not in plan(first, "simple")
    found = _arrived(messages).select(F.col("trade_id").cast("binary").alias("key"), "partition", "offset")
    joined = messages.join(found, ["key", "partition", "offset"], "left_semi").select(*messages.columns)
    rows = sorted(map(str, first.collect()))
    assert rows == sorted(map(str, joined.collect())) and len(rows) == 3


def test_a_topic_holds_one_copy_while_its_table_gets_three(spark, tmp_path, monkeypatch):
    lines(spark, str(tmp_path), [(n, 12, 3, 1, 5.0, 10.5, 0.0, 0.02, "A") for n in range(4)])
    held, paths = [], []

    def counting(spark, topic, *args, **more):
        paths.append(Path(topic.path))
        held.append(sum(pq.ParquetFile(f).metadata.num_rows for f in paths[-1].glob("*.parquet")))
        return run_bronze(spark, topic, *args, **more)

    monkeypatch.setattr(queries, "run_bronze", counting)
    rows = queries.stream_bronze_widened(spark, str(tmp_path)).collect()
    assert held == [4, 4, 4] and not list(paths[-1].glob("*.parquet"))
    assert sorted((r.key, r.ticker or "") for r in rows) == sorted([(f"{n}-1", t) for n in range(4) for t in ("", "TKR2", "TKR2")])


def test_topics_and_tables_are_stored_with_zstd(spark, warehouse, tmp_path):
    topic = Topic("t", path=str(tmp_path / "topic"))
    write_topic(lines(spark, str(tmp_path), [(5, 12, 3, 1, 5.0, 10.5, 0.0, 0.02, "A")]), topic)
    run_bronze(spark, topic, warehouse, AVAILABLE).awaitTermination()
    run_silver(spark, warehouse, AVAILABLE).awaitTermination()
    ensure_table(spark, warehouse.gold)
    append_table(spark.createDataFrame([("p",)], "portfolio_id string"), warehouse.gold)
    for folder in (topic.path, warehouse.bronze.location, warehouse.silver.location, warehouse.gold.location):
        assert codecs(folder) == {"ZSTD"}, folder
    assert spark.conf.get("spark.sql.parquet.compression.codec") == "snappy"
