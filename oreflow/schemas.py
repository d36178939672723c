"""Column names and types shared by every layer.  All of them are fixed values."""

from __future__ import annotations

from pyspark.sql import types as T

# A topic as Spark's Kafka source shows it; a Parquet log of a topic has the same columns.
TOPIC_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

# Fields of a trade message.  Amounts travel as JSON doubles; the time stays text because
# it is either epoch microseconds or a timestamp string.
TRADE_FIELDS = {
    "trade_id": "string",
    "portfolio_id": "string",
    "ticker": "string",
    "side": "string",
    "quantity": "double",
    "price": "double",
    "fees": "double",
    "trade_timestamp": "string",
}

MONEY = "decimal(18,2)"

BRONZE_COLUMNS = {
    "key": "string",
    "value": "string",
    "ingest_timestamp": "timestamp",
    "ticker": "string",
}

SILVER_COLUMNS = {
    "trade_id": "string",
    "portfolio_id": "string",
    "ticker": "string",
    "side": "string",
    "quantity": MONEY,
    "price": MONEY,
    "fees": MONEY,
    "trade_timestamp": "timestamp",
    "trade_value": "decimal(38,4)",
}

GOLD_COLUMNS = {
    "portfolio_id": "string",
    "ticker": "string",
    "net_quantity": "decimal(28,2)",
    "total_fees": "decimal(28,2)",
    "total_value": "decimal(28,2)",
}


# Text of a message that is not quite what its schema says; NULL for a sound one.
FAULTY = "faulty"


def message_schemas() -> tuple[str, str, str]:
    """DDL that reads a flat trade, a ``payload`` envelope, and either one in a single pass."""
    flat = ", ".join(f"{name} {kind}" for name, kind in TRADE_FIELDS.items())
    nested = ", ".join(f"{name}: {kind}" for name, kind in TRADE_FIELDS.items())
    envelope = f"payload struct<{nested}>"
    return flat, envelope, f"{flat}, {envelope}, {FAULTY} string"
