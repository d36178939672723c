"""Which task writes which row.

Every shuffle here goes by the content of the row.  A random or round-robin one would be even
too, but when a lost executor makes some tasks run again, rows could then move from a finished
task to a repeated one, or the other way, and be written twice or never.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

from pyspark.sql import DataFrame, SparkSession, functions as F


def rebalanced(df: DataFrame, *by: str) -> DataFrame:
    """Few, evenly sized files per value of ``by``; a frequent value is split at run time.

    Works where adaptive execution does: batch queries and streams without state.
    """
    return df.hint("rebalance", *by) if by else df


def state_partitions(spark: SparkSession) -> int:
    """Tasks of a stream with state that starts now; afterwards its checkpoint holds the number."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def gathered(df: DataFrame, by: Sequence[str], key: Sequence[str], spread: int | None = None) -> DataFrame:
    """The rows of a value of ``by`` in up to ``spread`` tasks, for streams with state.

    Without this every task writes a file for every value.  There are as many tasks as state
    partitions, so the write is as wide as what comes before.  ``key`` is unique and splits a
    frequent value evenly; ``spread`` is by default the square root of the state partitions,
    so that a batch with some ten values leaves about a file per task.
    """
    if not by:
        return df
    buckets = spread or max(1, isqrt(state_partitions(df.sparkSession)))
    return df.repartition(*by, F.pmod(F.xxhash64(*key), F.lit(buckets)))
