"""Trade messages built by Spark from the ``lineitem`` table, in every message shape.

Used by the registered queries, the tests and the bench, so that input grows with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TOPIC_NAME = "trades"

# Grows with the order and line; copies of a trade differ in part or supplier.
OFFSET = "((l_orderkey * 8 + l_linenumber) * 1000003 + l_partkey % 1000003) * 97 + l_suppkey % 97"

# Fields of a trade as JSON text, NULL ones left out; it is digits and fixed words, so nothing needs an escape.
# A repeated (order, line) makes a repeated trade id.  Amounts have two places, so that every engine writes
# them alike.  Even lines carry their time as microseconds, odd ones as text.
_TRADE = """concat_ws(',',
    concat('"trade_id":"', concat_ws('-', l_orderkey, l_linenumber), '"'),
    concat('"portfolio_id":"P', l_suppkey, '"'),
    concat('"ticker":"tkr', l_partkey % 10, '"'),
    concat('"side":"', CASE l_returnflag WHEN 'A' THEN 'buy' WHEN 'R' THEN 'SELL' ELSE 'hold' END, '"'),
    concat('"quantity":', CAST(l_quantity + l_discount - 2 AS decimal(18,2))),
    concat('"price":', CAST(l_extendedprice AS decimal(18,2))),
    concat('"fees":', CAST(l_tax AS decimal(18,2))),
    CASE WHEN l_linenumber % 2 = 0 THEN concat('"trade_timestamp":', unix_micros(shipped))
         ELSE concat('"trade_timestamp":"', date_format(shipped, "yyyy-MM-dd'T'HH:mm:ss'Z'"), '"') END)"""

# Flat, in a payload, as a change event, as one in a payload, or a tombstone (NULL).  The trade is made once
# and put between these: with it in every branch the code of a row would be too long for the JVM to compile.
_SHAPED = """concat(
    CASE l_orderkey % 5 WHEN 0 THEN '{' WHEN 1 THEN '{"schema":{"type":"struct"},"payload":{'
                        WHEN 2 THEN '{"after":{' WHEN 3 THEN '{"payload":{"after":{' END,
    trade,
    CASE l_orderkey % 5 WHEN 0 THEN '}' WHEN 3 THEN '}}}' ELSE '}}' END)"""


def messages_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic as the Kafka source would show it, one message per line item.

    All messages of a trade are in one partition, and each of its copies has an offset of its own.
    """
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").drop("l_linestatus")
    return (
        lines.selectExpr("*", "CAST(l_shipdate AS timestamp) AS shipped")
        .selectExpr("*", f"{_TRADE} AS trade")
        .selectExpr(
            "CAST(concat_ws('-', l_orderkey, l_linenumber) AS binary) AS key",
            f"CAST({_SHAPED} AS binary) AS value",
            f"'{TOPIC_NAME}' AS topic",
            "CAST(l_orderkey % 4 AS int) AS partition",
            f"{OFFSET} AS offset",
            "shipped AS timestamp",
            "0 AS timestampType",
        )
    )
