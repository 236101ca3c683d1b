"""Ordering keys that pick the first and last event of a group."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_DIGITS, _ID_DIGITS, _PRICE_DIGITS = 38, 19, 11
# Natural logarithms of doubles lie within this distance of zero.
_LOG_RANGE = 750


def event_order(length_ms: int | None = None) -> Column:
    """Key that orders events by time, then trade id (a missing id sorts first), then price.

    The general form is a struct, which Spark can only aggregate after sorting its input. Where all
    rows of a group share one aligned interval of ``length_ms``, the key is one decimal of 38 digits,
    which hash-aggregates: the time within the interval, the id, and the logarithm of the price.
    The latter tells prices of one time and id apart down to eight significant digits for intervals
    of a day, fewer for longer ones.
    """
    trade_id = F.greatest(F.coalesce(F.col("trade_id"), F.lit(-1).cast("long")), F.lit(-1).cast("long"))
    if length_ms is None:
        return F.struct(F.col("event_time"), trade_id, F.col("last_price"))
    price_digits = min(_PRICE_DIGITS, _DIGITS - _ID_DIGITS - len(str(length_ms - 1)))
    if price_digits < 1:
        raise ValueError(f"interval too long for an ordering key: {length_ms} ms")
    offset = F.pmod(F.col("event_time"), F.lit(length_ms).cast("long")).cast("decimal(20,0)")
    steps = 10**price_digits / (2 * _LOG_RANGE)
    price = F.when(F.col("last_price") > 0, F.log("last_price") + _LOG_RANGE).otherwise(0.0)
    code = F.floor(price * (steps * (1 - 1e-9))).cast(f"decimal({price_digits},0)")
    by_time = offset * F.lit(Decimal(10) ** (_ID_DIGITS + price_digits))
    by_id = (trade_id.cast("decimal(20,0)") + 1) * F.lit(Decimal(10) ** price_digits)
    return (by_time + by_id + F.coalesce(code, F.lit(0))).cast("decimal(38,0)")
