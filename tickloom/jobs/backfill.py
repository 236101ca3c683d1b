"""Fill the event folders of a span of days from downloaded trade archives.

    backfill.py ARCHIVE TARGET 2026-07-01..2026-07-31 BTCUSDT ETHUSDT [--replace]

Days that TARGET already holds are skipped unless they are to be replaced.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date

from pyspark.sql import functions as F

from tickloom.functions import events as fn
from tickloom.session import build_session, drop_scratch
from tickloom.sources import archive


def _span(text: str) -> tuple[date, date]:
    first, _, last = text.partition("..")
    return date.fromisoformat(first), date.fromisoformat(last or first)


def main(argv: Sequence[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("archive", help="CSV files in one folder per symbol")
    parser.add_argument("target", help="folder of the events, by symbol and date")
    parser.add_argument("days", type=_span, help="a day, or two days joined by ..")
    parser.add_argument("symbols", nargs="+")
    parser.add_argument("--replace", action="store_true", help="write days again that are there")
    args = parser.parse_args(argv)

    spark = build_session("tickloom-backfill")
    names = F.explode_outer(fn.symbol_list(F.lit(",".join(args.symbols))))
    symbols = spark.range(1).select(names.alias("symbol")).where("symbol IS NOT NULL")
    if symbols.isEmpty():
        raise ValueError(f"no spot symbol among {args.symbols}")
    there = archive.existing_outputs(spark, args.target)
    manifest = archive.backfill_manifest(symbols, *args.days, there, args.replace)
    archive.backfill(spark, args.archive, args.target, manifest)
    drop_scratch(spark)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
