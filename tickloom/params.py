"""Tunable parameters of the engine, passed as arguments to the operators."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

# Published defaults of the data products.
DEFAULT_WINDOW = "5 minutes"
DEFAULT_MIN_RECORDS = 2
DEFAULT_REFRESH_SECONDS = 10
DEFAULT_MIN_LIQUIDITY = 10_000.0
DEFAULT_SPIKE_ZSCORE = 3.0
DEFAULT_SPIKE_RETURN_PCT = 1.5
DEFAULT_TOP_N = 10
DEFAULT_SYMBOLS = ("BTCUSDT", "ETHUSDT", "BNBUSDT", "SOLUSDT", "XRPUSDT")
DEFAULT_BUCKET_MS = 1_000
DEFAULT_STATE_RETENTION_SECONDS = 900
DEFAULT_SERVING_RETENTION_SECONDS = 86_400
DEFAULT_BASELINE_REFRESH_SECONDS = 300
DEFAULT_FRESHNESS_MS = 30_000
WEIGHT_VOLUME, WEIGHT_RETURN, WEIGHT_ACTIVITY = 0.45, 0.35, 0.20
ZERO_STDDEV = 1e-12
SCHEMA_VERSION = 2

_UNIT_MS = {
    "millisecond": 1,
    "second": 1_000,
    "minute": 60_000,
    "hour": 3_600_000,
    "day": 86_400_000,
    "week": 604_800_000,
}
_DURATION = re.compile(r"\s*(\d+)\s+(millisecond|second|minute|hour|day|week)s?\s*", re.IGNORECASE)


def duration_ms(text: str) -> int:
    """Length in milliseconds of a fixed duration such as ``"5 minutes"``."""
    match = _DURATION.fullmatch(text)
    if match is None or int(match.group(1)) == 0:
        raise ValueError(f"not a fixed, positive duration: {text!r}")
    return int(match.group(1)) * _UNIT_MS[match.group(2).lower()]


@dataclass(frozen=True)
class Params:
    """One set of thresholds and sizes; each operator also takes them one by one."""

    window: str = DEFAULT_WINDOW
    min_records: int = DEFAULT_MIN_RECORDS
    refresh_seconds: int = DEFAULT_REFRESH_SECONDS
    min_liquidity: float = DEFAULT_MIN_LIQUIDITY
    spike_zscore: float = DEFAULT_SPIKE_ZSCORE
    spike_return_pct: float = DEFAULT_SPIKE_RETURN_PCT
    top_n: int = DEFAULT_TOP_N
    symbols: tuple[str, ...] = field(default=DEFAULT_SYMBOLS)
    bucket_ms: int = DEFAULT_BUCKET_MS
    state_retention_seconds: int = DEFAULT_STATE_RETENTION_SECONDS
    serving_retention_seconds: int = DEFAULT_SERVING_RETENTION_SECONDS
    baseline_refresh_seconds: int = DEFAULT_BASELINE_REFRESH_SECONDS
    freshness_ms: int = DEFAULT_FRESHNESS_MS

    @property
    def window_ms(self) -> int:
        return duration_ms(self.window)
