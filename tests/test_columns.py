"""The expressions by themselves."""

from datetime import datetime
from decimal import Decimal

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from oreflow.functions import event_time, money, signed_quantity


def test_money_rounds_half_up_and_never_raises(spark):
    cases = {
        1.005: "1.01",
        10.555: "10.56",
        -1.005: "-1.01",
        0.004: "0.00",
        1e15: "1000000000000000.00",
        1e16: None,
        float("nan"): None,
        float("inf"): None,
        None: None,
    }
    rows = spark.createDataFrame([(v,) for v in cases], "v double").select(money(F.col("v"))).collect()
    assert [row[0] for row in rows] == [Decimal(v) if v else None for v in cases.values()]


def test_event_time(spark):
    cases = {
        "0": datetime(1970, 1, 1),
        "2024": datetime(1970, 1, 1, 0, 0, 0, 2024),
        "1700000000000000": datetime(2023, 11, 14, 22, 13, 20),
        "2024-01-02": datetime(2024, 1, 2),
        "2024-01-02 03:04:05.678": datetime(2024, 1, 2, 3, 4, 5, 678000),
        "2024-01-02T03:04:05+01:00": datetime(2024, 1, 2, 2, 4, 5),
        "-5": None,
        "+5": None,
        "1.5": None,
        "": None,
        " 7": None,
        "soon": None,
        "9" * 20: None,
        None: None,
    }
    rows = spark.createDataFrame([(v,) for v in cases], "v string").select(event_time(F.col("v"))).collect()
    assert dict(zip(cases, [row[0] for row in rows])) == cases


def test_signed_quantity(spark):
    sides = {"BUY": "1.00", "SELL": "-1.00", "HOLD": "0.00", " BUY": "0.00", "buy": "0.00", None: "0.00"}
    rows = spark.createDataFrame([(side, Decimal("1.00")) for side in sides], "side string, quantity decimal(18,2)")
    signed = rows.select(signed_quantity().alias("q"))
    assert signed.schema["q"].dataType.simpleString() == "decimal(18,2)"
    assert [row.q for row in signed.collect()] == [Decimal(v) for v in sides.values()]


@settings(max_examples=5, derandomize=True, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=30), min_size=200, max_size=400))
def test_no_text_raises(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "v string")
    assert rows.select(event_time(F.col("v")), money(F.col("v").try_cast("double"))).collect()
