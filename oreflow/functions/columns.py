"""Column expressions of the pipeline.  All are built-in, none raises on bad data."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from oreflow.schemas import MONEY

# Where each message shape keeps its ticker, in order of preference (fixed values).
TICKER_PATHS = ("$.ticker", "$.payload.ticker", "$.after.ticker", "$.payload.after.ticker")


def ticker_of(value: Column) -> Column:
    """Upper-case ticker of a JSON message; NULL where no shape has one.

    ``coalesce`` stops at the first hit, so a flat message is scanned once only.
    """
    return F.upper(F.coalesce(*(F.get_json_object(value, path) for path in TICKER_PATHS)))


def money(amount: Column) -> Column:
    """Two decimal places, rounded half up; NULL where the number does not fit."""
    return amount.try_cast(MONEY)


def event_time(text: Column) -> Column:
    """Digits are epoch microseconds, anything else is timestamp text; NULL if neither."""
    micros = F.timestamp_micros(text.try_cast("bigint"))
    return F.when(text.rlike("^[0-9]+$"), micros).otherwise(text.try_cast("timestamp"))


def signed_quantity() -> Column:
    """+quantity for a BUY, -quantity for a SELL, zero for any other or no side."""
    return F.expr(
        f"CASE side WHEN 'BUY' THEN quantity WHEN 'SELL' THEN -quantity ELSE CAST(0 AS {MONEY}) END"
    )
