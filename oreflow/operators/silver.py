"""Bronze -> silver: parse, type, keep usable trades, one row per trade id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from oreflow.functions import event_time, money
from oreflow.operators.layout import state_partitions
from oreflow.schemas import FAULTY, SILVER_COLUMNS, TRADE_FIELDS, message_schemas

# How far behind the newest trade a trade may be (fixed value).
LATENESS = "2 hours"


def parse(bronze: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Trade fields of every message; each field is taken flat first, else from ``payload``.

    One schema covers both shapes, so that a sound message is parsed once.  On a faulty one,
    such as a message cut off inside the payload, that schema may find more than a schema
    for one shape would; only these are read again, shape by shape, and that reading counts.

    ``inline`` is a barrier: filters on the fields stay above it, where a plain struct
    projection would be copied below them and the text parsed again for every condition.
    ``keep`` names columns of the input to carry along, such as an order of arrival.
    """
    flat, envelope, either = message_schemas()
    once = F.from_json("value", either, {"columnNameOfCorruptRecord": FAULTY})
    again = F.struct(F.from_json(FAULTY, flat).alias("flat"), F.from_json(FAULTY, envelope).alias("envelope"))
    read = bronze.select(*keep, F.inline(F.array(once))).select(
        "*", F.inline(F.array(F.when(F.col(FAULTY).isNotNull(), again)))
    )
    return read.selectExpr(
        *(
            f"CASE WHEN {FAULTY} IS NULL THEN coalesce({name}, payload.{name}) "
            f"ELSE coalesce(flat.{name}, envelope.payload.{name}) END AS {name}"
            for name in TRADE_FIELDS
        ),
        *keep,
    )


def typed(parsed: DataFrame) -> DataFrame:
    """Silver column types.  Amounts are rounded before they are multiplied."""
    kept = [name for name in parsed.columns if name not in TRADE_FIELDS]
    return parsed.select(
        "trade_id",
        "portfolio_id",
        F.upper("ticker").alias("ticker"),
        F.upper("side").alias("side"),
        *(money(F.col(name)).alias(name) for name in ("quantity", "price", "fees")),
        event_time(F.col("trade_timestamp")).alias("trade_timestamp"),
        *kept,
    ).withColumn("trade_value", F.col("quantity") * F.col("price"))


def usable(trades: DataFrame) -> DataFrame:
    """Trades with an id and a positive (rounded) quantity."""
    return trades.where("trade_id IS NOT NULL AND quantity > 0")


def dedup_stream(
    trades: DataFrame,
    lateness: str = LATENESS,
    bounded: bool = False,
    salts: int | None = None,
) -> DataFrame:
    """First arrival per trade id in a stream; rows behind the watermark are dropped.

    By default an id is remembered for ever: the watermark does not clear the state, since
    the key holds no event time.  ``bounded`` forgets an id ``lateness`` after its event
    time and may then let it in again.

    One id may hold a large part of a batch (a replayed trade), and all rows of an id go to
    one task.  So copies are first thinned out on (id, salt), which spreads such an id over
    up to ``salts`` tasks and leaves at most that many rows of it; the second pass on the id
    alone decides.  There are as many salts as state partitions unless told otherwise.  The
    salt is the task that reads the row, which does not change when the task runs again.  The
    second pass never forgets, so the ids that come out do not depend on the salt.  The state
    of the first pass is cleared behind the watermark.  ``salts=1`` leaves the first pass out;
    leaving it out or taking it in needs a new checkpoint, another number of salts does not.

    With ``bounded`` there is no first pass: it could remember a copy that the second pass
    dropped, and which ids are let in again would then depend on which task read a row.
    """
    if bounded and salts not in (None, 1):
        raise ValueError("a bounded stream takes no salts")
    if salts is None:
        salts = 1 if bounded else state_partitions(trades.sparkSession)
    marked = trades.withWatermark("trade_timestamp", lateness)
    if salts > 1:
        marked = (
            marked.withColumn("salt", F.spark_partition_id() % salts)
            .dropDuplicatesWithinWatermark(["trade_id", "salt"])
            .drop("salt")
        )
    if bounded:
        return marked.dropDuplicatesWithinWatermark(["trade_id"])
    return marked.dropDuplicates(["trade_id"])


def dedup_batch(trades: DataFrame, arrival: Sequence[str] = ()) -> DataFrame:
    """First row per trade id, in the order of ``arrival`` and then of all other columns.

    Spark turns the rank filter into a limit of one row per id and task before the shuffle,
    so an id with very many copies sends one row per task.
    """
    columns = [name for name in SILVER_COLUMNS if name in trades.columns]
    order = [*arrival, *(name for name in columns if name not in (*arrival, "trade_id"))]
    rank = F.row_number().over(Window.partitionBy("trade_id").orderBy(*order))
    return trades.withColumn("rank", rank).where("rank = 1").drop("rank")
