"""Keep the hybrid view of arriving events and publish its top lists.

    speed.py EVENTS BASELINES TARGET [SETTINGS] [--records] [--source FORMAT] [--sliding] [--drain]

EVENTS is a folder that JSON Lines arrive in; lines that do not parse go to TARGET/quarantine. With
--records the lines are sharded records, base64 ``data`` with ``event_id`` and ``sequence_number``, and
a record of a sequence seen before counts once. With --source EVENTS is a JSON object of options for
that connector, whose rows have value, partition and offset; it begins with the newest ones. BASELINES
may be written anew at any time. SETTINGS is a JSON object with any field of ``tickloom.params.Params``.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence

from tickloom.operators.clean import clean_events
from tickloom.params import Params
from tickloom.session import build_session
from tickloom.sources.baselines import baseline_stamp, read_baselines
from tickloom.sources.events import read_line_stream, split_malformed
from tickloom.sources.messages import (
    decode_records,
    decode_stream_rows,
    read_record_files,
    read_record_stream,
)
from tickloom.streaming.hybrid import HybridView, Refreshing, start
from tickloom.streaming.serving import ServingRefresh
from tickloom.streaming.sinks import append_quarantine
from tickloom.streaming.state import recent_bucket_windows, recent_record_windows


def _settings(text: str) -> Params:
    return Params(**json.loads(text))


def main(argv: Sequence[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("events")
    parser.add_argument("baselines", help="file or folder, any JSON layout")
    parser.add_argument("target", help="folder for state, checkpoint and lists")
    parser.add_argument("settings", nargs="?", type=_settings, default=Params())
    parser.add_argument("--records", action="store_true", help="sharded records instead of events")
    parser.add_argument("--source", metavar="FORMAT", help="connector of a sharded stream")
    parser.add_argument("--sliding", action="store_true", help="keep events instead of buckets")
    parser.add_argument("--drain", action="store_true", help="process what is there, then stop")
    args = parser.parse_args(argv)

    spark = build_session("tickloom-speed")
    chosen = args.settings
    # A run over what is there replays history, where the clock says nothing about a symbol.
    kept = None if args.drain else chosen.state_retention_seconds
    every = None if args.drain else f"{chosen.refresh_seconds} seconds"
    queries = []
    if args.source is not None:
        arriving = decode_stream_rows(read_record_stream(spark, args.source, json.loads(args.events)))
    elif args.records:
        arriving = decode_records(read_record_files(spark, args.events))
    else:
        arriving, bad = split_malformed(read_line_stream(spark, args.events))
        queries.append(
            append_quarantine(bad, f"{args.target}/quarantine", f"{args.target}/checkpoint-quarantine", every)
        )
    arriving = clean_events(arriving, lenient=True)
    if args.sliding:
        windows = recent_record_windows(arriving, chosen.window, kept)
    else:
        windows = recent_bucket_windows(arriving, chosen.window, chosen.bucket_ms, kept)
    baselines = Refreshing(
        lambda: read_baselines(spark, args.baselines),
        chosen.baseline_refresh_seconds,
        stamp=lambda: baseline_stamp(spark, args.baselines),
    )
    view = HybridView(spark, f"{args.target}/view", baselines, chosen)
    refresh = ServingRefresh(spark, f"{args.target}/serving", view, chosen.top_n)
    queries.append(start(windows, refresh, f"{args.target}/checkpoint", every))
    if every is not None:
        spark.streams.awaitAnyTermination()
    else:
        for query in queries:
            query.awaitTermination()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
