"""Topic -> bronze: the payload is kept as it came, only the ticker is looked up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from oreflow.functions import ticker_of


def to_bronze(topic: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Narrow projection: no shuffle, reads the key and value columns only.

    ``keep`` names columns of the topic to carry along, such as ``partition`` and ``offset``, the
    order of arrival; the table has no place for them.
    """
    value = F.col("value").cast("string")
    return topic.select(
        F.col("key").cast("string").alias("key"),
        value.alias("value"),
        F.current_timestamp().alias("ingest_timestamp"),
        ticker_of(value).alias("ticker"),
        *keep,
    )
