"""Columns that clean and derive the fields of one market event."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Quote asset, leveraged-token suffixes and the largest millisecond timestamp.
QUOTE_ASSET = "USDT"
LEVERAGED_SUFFIXES = ("UPUSDT", "DOWNUSDT", "BULLUSDT", "BEARUSDT")
LARGEST_MILLISECONDS = 99_999_999_999_999


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def epoch_millis(column: Column | str) -> Column:
    """Epoch milliseconds from a long that holds milliseconds or microseconds."""
    value = _col(column)
    # Integral division; a detour through double would lose digits.
    in_millis = F.call_function("div", value, F.lit(1000).cast("long"))
    return F.when(F.abs(value) > LARGEST_MILLISECONDS, in_millis).otherwise(value)


def base_asset(symbol: Column | str) -> Column:
    return F.regexp_replace(_col(symbol), f"{QUOTE_ASSET}$", "")


def is_spot_symbol(symbol: Column | str, allow: tuple[str, ...] = ()) -> Column:
    """True for spot pairs in the quote asset; ``allow`` names pairs the suffix test would drop."""
    upper = F.upper(_col(symbol))
    leveraged = F.lit(False)
    for suffix in LEVERAGED_SUFFIXES:
        leveraged = leveraged | upper.endswith(suffix)
    spot = upper.endswith(QUOTE_ASSET) & ~leveraged
    return spot | upper.isin(*[name.upper() for name in allow]) if allow else spot


def symbol_list(text: Column | str) -> Column:
    """Distinct valid symbols of a comma-separated text; null when none is left."""
    parts = F.transform(F.split(_col(text), ","), lambda part: F.upper(F.trim(part)))
    kept = F.array_distinct(F.filter(parts, lambda part: is_spot_symbol(part)))
    return F.when(F.size(kept) > 0, kept)


def aggregate_trade_count(first_id: Column | str, last_id: Column | str) -> Column:
    """Number of trades an aggregate row stands for, never below one."""
    return F.greatest(F.lit(1).cast("long"), _col(last_id) - _col(first_id) + 1)


def aligned_start(time: Column | str, length_ms: int) -> Column:
    """Start of the epoch-aligned interval that holds ``time`` (floors before 1970 too)."""
    value = _col(time)
    return value - F.pmod(value, F.lit(length_ms).cast("long"))


def canonical_json(columns: tuple[str, ...] | list[str]) -> Column:
    """Compact JSON text with keys in alphabetical order."""
    return F.to_json(F.struct(*sorted(columns)))
