"""Small inputs for tests."""

from __future__ import annotations

import random

from tickloom import schemas

START = 1_798_761_600_000
SYMBOLS = ("ABCUSDT", "XYZUSDT")


def event(symbol, time, price, volume=1.0, count=1, ingest=None, trade_id=None):
    ingest = time if ingest is None else ingest
    return (2, "aggTrade", symbol, symbol.removesuffix("USDT"), time, price, volume, count, ingest, trade_id)


def minute_rows():
    """Ten minutes of two symbols, an event per minute, from a seeded walk."""
    rng, rows = random.Random(42), []
    for number, symbol in enumerate(SYMBOLS):
        price = 40.0 * (number + 1)
        for i in range(10):
            price = round(price * rng.uniform(0.98, 1.03), 2)
            time, trade_id = START + i * 60_000, number * 50 + i
            volume = float(rng.randrange(20_000, 90_000))
            rows.append(event(symbol, time, price, volume, rng.randrange(5, 60), time + 350, trade_id))
    return rows


def frame(spark, rows):
    """Rows as events; ``None`` is allowed anywhere, as in files."""
    loose = schemas.T.StructType([schemas.T.StructField(f.name, f.dataType) for f in schemas.EVENT.fields])
    return spark.createDataFrame(rows, loose)


def random_rows(seed: int, n: int = 200, symbols: int = 3, span: int = 40_000, hot: bool = True):
    """Random events with ties in time, missing ids and one symbol with most of the rows."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        name = "HOTUSDT" if hot and rng.random() < 0.5 else f"S{rng.randrange(symbols)}USDT"
        time = rng.randrange(0, span, 250)
        trade_id = None if rng.random() < 0.1 else i
        rows.append(
            event(name, time, float(rng.randrange(1, 1000)), float(rng.randrange(0, 5000)),
                  rng.randrange(1, 9), time + rng.randrange(0, 900), trade_id)
        )
    rng.shuffle(rows)
    return rows


BASELINE = {
    "symbol": "ABCUSDT",
    "mean_return_5m": 0.5,
    "std_return_5m": 1.0,
    "mean_quote_volume_5m": 8_000.0,
    "std_quote_volume_5m": 4_000.0,
    "median_quote_volume_5m": 11_000.0,
    "sample_count": 40,
    "updated_at": "2027-01-02T03:04:05+00:00",
    "mean_trade_count_5m": 60.0,
    "std_trade_count_5m": 12.0,
}


def baseline(spark, **changes):
    row = {**BASELINE, **changes}
    return spark.createDataFrame(
        [tuple(row[name] for name in schemas.BASELINE.fieldNames())], schemas.BASELINE
    )


def as_dicts(df):
    return [row.asDict(recursive=True) for row in df.collect()]
