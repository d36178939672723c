"""One message per odd case: what bronze finds and what silver keeps."""

import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from oreflow.operators import parse, to_bronze, typed, usable

EPOCH_MICRO = datetime(1970, 1, 1, 0, 0, 0, 1)
NOV_14 = datetime(2023, 11, 14, 22, 13, 20)


def body(trade_id=None, quantity=1, time=1, id_name="trade_id"):
    trade = {id_name: trade_id} if trade_id else {}
    return trade | {
        "portfolio_id": "p1",
        "ticker": "aapl",
        "side": "buy",
        "quantity": quantity,
        "price": 10.555,
        "fees": 0.01,
        "trade_timestamp": time,
    }


def text(message):
    return json.dumps(message)


# name: (message, bronze ticker, silver (id, quantity, time, value) or None)
CASES = {
    "flat, micros": (text(body("a", 1.5, 1700000000000000)), "AAPL", ("a", "1.50", NOV_14, "15.8400")),
    "payload, text time": (
        text({"schema": {}, "payload": body("b", 2, "2023-11-14T22:13:20Z")}),
        "AAPL",
        ("b", "2.00", NOV_14, "21.1200"),
    ),
    "after": (text({"after": body("c")}), "AAPL", None),
    "payload.after": (text({"payload": {"after": body("c2")}}), "AAPL", None),
    "quantity as text": (text(body("d", "3")), "AAPL", None),
    "bad JSON": ("{oops", None, None),
    "cut-off JSON": ('{"trade_id":"t","quantity":1,', None, None),
    "tombstone": (None, None, None),
    "array": (text([body("f")]), None, None),
    "payload is text": (text({"payload": "x"} | body("g")), "AAPL", ("g", "1.00", EPOCH_MICRO, "10.5600")),
    "payload is array": (text({"trade_id": "r", "payload": [1], "quantity": 1}), None, ("r", "1.00", None, None)),
    "quantity 0.004": (text(body("h", 0.004)), "AAPL", None),
    "quantity 0.005": (text(body("i", 0.005)), "AAPL", ("i", "0.01", EPOCH_MICRO, "0.1056")),
    "negative quantity": (text(body("j", -1)), "AAPL", None),
    "huge quantity": (text(body("k", 1e17)), "AAPL", None),
    "bad time": (text(body("l", time="abc")), "AAPL", ("l", "1.00", None, "10.5600")),
    "negative micros": (text(body("m", time=-5)), "AAPL", ("m", "1.00", None, "10.5600")),
    "20-digit time": (text(body("e", time="9" * 20)), "AAPL", ("e", "1.00", None, "10.5600")),
    "mixed shapes": (
        text({"trade_id": "n", "payload": body("zz", 4)}),
        "AAPL",
        ("n", "4.00", EPOCH_MICRO, "42.2400"),
    ),
    "field-name case": (text(body("o", id_name="Trade_ID")), "AAPL", None),
    "null ticker falls through": (
        text({"trade_id": "q", "ticker": None, "payload": {"ticker": "x"}, "quantity": 1}),
        "X",
        ("q", "1.00", None, None),
    ),
}


@pytest.fixture(scope="module")
def bronze(spark):
    rows = [(name, case[0]) for name, case in CASES.items()]
    topic = spark.createDataFrame(rows, "key string, value string")
    return to_bronze(topic.select(F.col("key").cast("binary"), F.col("value").cast("binary")))


def test_bronze_ticker(bronze):
    found = {row.key: row.ticker for row in bronze.collect()}
    assert found == {name: case[1] for name, case in CASES.items()}


def test_bronze_keeps_the_payload(bronze):
    assert {row.key: row.value for row in bronze.collect()} == {name: case[0] for name, case in CASES.items()}


def test_bronze_stamps_one_time_per_batch(bronze):
    assert bronze.select("ingest_timestamp").distinct().count() == 1


def test_silver_rows(bronze):
    rows = usable(typed(parse(bronze, keep=["key"]))).collect()
    found = {row.key: (row.trade_id, row.quantity, row.trade_timestamp, row.trade_value) for row in rows}
    expected = {
        name: (row[0], Decimal(row[1]), row[2], Decimal(row[3]) if row[3] else None)
        for name, (_, _, row) in CASES.items()
        if row
    }
    assert found == expected


def test_silver_reads_what_there_is(bronze):
    rows = {row.key: row for row in typed(parse(bronze, keep=["key"])).collect()}
    assert len(rows) == len(CASES)
    assert rows["flat, micros"].price == Decimal("10.56")
    assert rows["null ticker falls through"].ticker == "X"
    assert rows["null ticker falls through"].side is None
    assert rows["quantity as text"].quantity is None
    assert rows["after"].trade_id is None
    assert rows["field-name case"].trade_id is None


def test_deleted_rows_count_as_seen(spark):
    """An unwrapped delete is an ordinary message: nothing reads its mark."""
    value = text(body("a") | {"__deleted": "true"})
    bronze = spark.createDataFrame([(value,)], "value string")
    assert usable(typed(parse(bronze))).count() == 1
