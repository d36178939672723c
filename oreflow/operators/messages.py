"""Projections of a topic for reading by eye."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def message_log(topic: DataFrame) -> DataFrame:
    """Position, time, and the key and value as text (fixed columns and order)."""
    return topic.select(
        "topic",
        "partition",
        "offset",
        "timestamp",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
    )


def message_text(topic: DataFrame) -> DataFrame:
    """Key, value and time only."""
    return message_log(topic).select("key", "value", "timestamp")
