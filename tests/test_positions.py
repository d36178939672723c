"""Rounding, grouping and order rules of silver and gold in batch."""

from decimal import Decimal

from pyspark.sql import functions as F

from oreflow.operators import dedup_batch, positions
from oreflow.schemas import GOLD_COLUMNS, SILVER_COLUMNS


def trades(spark, rows):
    schema = "trade_id string, portfolio_id string, ticker string, side string, q string, p string, f string, t string"
    return spark.createDataFrame(rows, schema).select(
        "trade_id",
        "portfolio_id",
        "ticker",
        "side",
        F.col("q").cast("decimal(18,2)").alias("quantity"),
        F.col("p").cast("decimal(18,2)").alias("price"),
        F.col("f").cast("decimal(18,2)").alias("fees"),
        F.col("t").cast("timestamp").alias("trade_timestamp"),
    ).withColumn("trade_value", F.col("quantity") * F.col("price"))


def test_types(spark):
    result = positions(trades(spark, [("1", "p", "A", "BUY", "1", "1", "0", None)]))
    assert dict(result.dtypes) == GOLD_COLUMNS


def test_values_are_rounded_one_by_one(spark):
    """0.15 * 0.03 = 0.0045 -> 0.00 each; a rounded total would be 0.01."""
    rows = [(str(i), "p", "A", "BUY", "0.15", "0.03", "0", None) for i in range(3)]
    assert positions(trades(spark, rows)).first().total_value == Decimal("0.00")


def test_totals(spark):
    rows = [
        ("1", "p", "A", "BUY", "5.50", "2.00", "0.10", None),
        ("2", "p", "A", "SELL", "2.25", "2.00", "0.20", None),
        ("3", "p", "A", "HOLD", "9.00", "1.00", None, None),
        ("4", "p", "A", None, "1.00", None, None, None),
        ("5", None, None, "SELL", "1.00", "1.00", None, None),
        ("6", None, None, "SELL", "1.00", "1.00", None, None),
    ]
    found = {(r.portfolio_id, r.ticker): tuple(r)[2:] for r in positions(trades(spark, rows)).collect()}
    assert found == {
        ("p", "A"): (Decimal("3.25"), Decimal("0.30"), Decimal("24.50")),
        (None, None): (Decimal("-2.00"), None, Decimal("2.00")),
    }


def test_a_value_that_does_not_fit_is_left_out(spark):
    rows = [
        ("1", "p", "A", "BUY", "1000000000.00", "1000000000.00", "0", None),
        ("2", "p", "A", "BUY", "1.00", "1.00", "0", None),
    ]
    assert positions(trades(spark, rows)).first().total_value == Decimal("1.00")


def test_first_arrival_wins(spark):
    copies = trades(
        spark,
        [
            ("1", "p", "A", "BUY", "3", "1", "0", "2024-01-03"),
            ("1", "p", "A", "BUY", "2", "1", "0", "2024-01-02"),
            ("2", "p", "A", "BUY", "1", "1", "0", "2024-01-01"),
        ],
    ).withColumn("offset", F.expr("CASE quantity WHEN 3 THEN 10 WHEN 2 THEN 11 ELSE 12 END"))
    by_offset = dedup_batch(copies, arrival=["offset"])
    assert {(r.trade_id, int(r.quantity)) for r in by_offset.collect()} == {("1", 3), ("2", 1)}
    by_time = dedup_batch(copies, arrival=["trade_timestamp"])
    assert {(r.trade_id, int(r.quantity)) for r in by_time.collect()} == {("1", 2), ("2", 1)}
    assert by_time.columns == [*SILVER_COLUMNS, "offset"]


def test_ties_do_not_depend_on_the_partitioning(spark):
    rows = [("1", f"p{i % 7}", "A", "BUY", str(i % 11 + 1), "1", "0", "2024-01-01") for i in range(500)]
    copies = trades(spark, rows)
    firsts = {tuple(dedup_batch(copies.repartition(n)).collect()) for n in (1, 3, 16)}
    assert len(firsts) == 1
