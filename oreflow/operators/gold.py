"""Silver -> gold: running position per portfolio and ticker."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from oreflow.functions import money, signed_quantity

# Has no effect on the totals: the groups hold no event time and the output is complete,
# so late trades are still counted (fixed value).
LATENESS = "15 minutes"


def positions(silver: DataFrame) -> DataFrame:
    """Net quantity, fees and gross value; each trade's value is rounded before the sum.

    Sums combine before the shuffle, so a busy portfolio or ticker sends one row per task.
    """
    trades = silver.withWatermark("trade_timestamp", LATENESS) if silver.isStreaming else silver
    return trades.groupBy("portfolio_id", "ticker").agg(
        F.try_sum(signed_quantity()).alias("net_quantity"),
        F.try_sum("fees").alias("total_fees"),
        F.try_sum(money(F.col("trade_value"))).alias("total_value"),
    )
