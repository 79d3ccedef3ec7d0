"""Command line: build one table, run everything in order, or bring everything up to date."""

from __future__ import annotations

import argparse
import logging

from .plans import pipeline, running
from .session import build_session


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="growthledger", description=__doc__)
    steps = [
        "run", "increment", "ingest", "fct_events", "dim_users", "metrics",
        "agg_active_user", "agg_user_lifecycle_weekly", "agg_user_retention",
    ]
    parser.add_argument("step", choices=steps)
    parser.add_argument("--root", required=True, help="folder of the tables")
    parser.add_argument("--csv", nargs="+", help="raw event files (run, increment, ingest)")
    parser.add_argument("--as-of", help="build date YYYY-MM-DD (default: today, UTC)")
    parser.add_argument("--start-ds", default=pipeline.DEFAULT_START_DS, help="first event day of the metrics")
    parser.add_argument(
        "--multi-line", action="store_true", help="line breaks inside quotes are allowed, for another pass over the text"
    )
    args = parser.parse_args(argv)
    if args.step in ("run", "increment", "ingest") and not args.csv:
        parser.error(f"{args.step} needs --csv")

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(message)s")
    spark = build_session()
    wh = pipeline.Warehouse(spark, args.root)
    multiline = args.multi_line
    match args.step:
        case "run":
            pipeline.run_pipeline(spark, args.csv, args.root, args.as_of, args.start_ds, multiline)
        case "increment":  # new raw files only
            running.run_increment(wh, args.csv, args.as_of, args.start_ds, multiline)
        case "ingest":
            pipeline.ingest(wh, args.csv, multiline)
        case "fct_events":
            pipeline.build_fct_events(wh)
        case "dim_users":
            pipeline.build_dim_users(wh, args.as_of)
        case "metrics":  # the three tables below from one pass over the events
            pipeline.build_metrics(wh, args.start_ds, args.as_of)
        case "agg_active_user":
            pipeline.build_agg_active_user(wh, args.start_ds, args.as_of)
        case "agg_user_lifecycle_weekly":
            pipeline.build_agg_user_lifecycle_weekly(wh, args.start_ds, args.as_of)
        case "agg_user_retention":
            pipeline.build_agg_user_retention(wh, args.start_ds, args.as_of)


if __name__ == "__main__":
    main()
