"""Summarise run and scaling logs."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from tickloom.operators.metrics import run_summary, scaling_summary
from tickloom.session import build_session, drop_scratch
from tickloom.sinks.tables import write_log
from tickloom.sources import logs


def main(argv: Sequence[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input-csv", required=True, help="run log")
    parser.add_argument("--output-csv", required=True, help="folder for the run summary")
    parser.add_argument("--scaling-csv", help="scaling log")
    parser.add_argument("--scaling-output", help="folder for the scaling summary")
    args = parser.parse_args(argv)
    spark = build_session("tickloom-results")
    write_log(run_summary(logs.read_run_log(spark, args.input_csv)), args.output_csv)
    if args.scaling_csv and args.scaling_output:
        write_log(scaling_summary(logs.read_scaling_log(spark, args.scaling_csv)), args.scaling_output)
    drop_scratch(spark)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
