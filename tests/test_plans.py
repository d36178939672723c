"""What Spark makes of the transforms: one parse, no needless shuffle, combine before shuffle."""

from math import isqrt

import pytest

from oreflow.operators import dedup_batch, parse, positions, to_bronze, typed, usable
from oreflow.operators.layout import gathered, rebalanced
from oreflow.schemas import SILVER_COLUMNS, TOPIC_SCHEMA
from oreflow.session import session_conf


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("plans")
    empty = spark.createDataFrame([], TOPIC_SCHEMA)
    empty.write.parquet(str(folder / "topic"))
    to_bronze(empty).write.parquet(str(folder / "bronze"))
    silver = ", ".join(f"{name} {kind}" for name, kind in SILVER_COLUMNS.items())
    spark.createDataFrame([], silver).write.parquet(str(folder / "silver"))
    return {name: spark.read.parquet(str(folder / name)) for name in ("topic", "bronze", "silver")}


def test_bronze_is_narrow_and_reads_two_columns(files):
    text = plan(to_bronze(files["topic"]))
    assert "Exchange" not in text
    assert "ReadSchema: struct<key:binary,value:binary>" in text


def test_silver_parses_without_a_shuffle_and_not_again_in_the_filter(files):
    text = plan(usable(typed(parse(files["bronze"]))))
    assert text.count("from_json(") == 3, "once, and twice more for a faulty message"
    assert text.count("Generate") == 2
    assert "Exchange" not in text
    assert "ReadSchema: struct<value:string>" in text


def test_batch_dedup_keeps_one_row_per_id_before_the_shuffle(files):
    text = plan(dedup_batch(files["silver"], arrival=["trade_timestamp"]))
    assert text.count("Exchange") == 1
    before = text[text.index("Exchange") :]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_positions_combine_before_the_shuffle(files):
    text = plan(positions(files["silver"]))
    assert text.count("Exchange") == 1
    assert "partial_try_sum" in text[text.index("Exchange") :]
    assert "trade_id" not in text and "price" not in text, "columns it does not need are not read"


@pytest.mark.parametrize("partitions", [200, 1000])
def test_writers_are_as_many_as_state_partitions(spark, files, partitions):
    with session_conf(spark, {"spark.sql.shuffle.partitions": str(partitions)}):
        text = plan(gathered(files["silver"], ["ticker"], ["trade_id"]))
        salted = f"% {isqrt(partitions)}" in text or f", {isqrt(partitions)})" in text
    assert f"hashpartitioning(ticker" in text and f", {partitions})" in text and salted
    assert plan(gathered(files["silver"], [], ["trade_id"])).count("Exchange") == 0


def test_rebalance_is_left_to_adaptive_execution(files):
    text = plan(rebalanced(files["silver"], "ticker"))
    assert "AdaptiveSparkPlan" in text and "REBALANCE_PARTITIONS_BY_COL" in text
