"""Jobs for spark-submit: python -m posttrend {collect,training,fit,score,report} ..."""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os

from posttrend.plans import live, monitoring
from posttrend.plans.collect import collect_put
from posttrend.plans.modeling import KINDS, build_model, read_threshold
from posttrend.plans.training import build_training
from posttrend.session import build_session
from posttrend.sources import registry
from posttrend.sources.tables import read_listing, read_scored, read_snapshots, read_training


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def _naive(moment: dt.datetime) -> dt.datetime:
    """The same moment in UTC, without a zone."""
    return moment.astimezone(dt.timezone.utc).replace(tzinfo=None) if moment.tzinfo else moment


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="posttrend", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("collect", help="landed feed items to the rising and hot tables")
    job.add_argument("--listing", required=True)
    job.add_argument("--rising", required=True)
    job.add_argument("--hot", required=True)

    job = jobs.add_parser("training", help="build the training table")
    job.add_argument("--rising", required=True)
    job.add_argument("--hot", required=True)
    job.add_argument("--output", required=True)
    job.add_argument("--start", type=dt.date.fromisoformat)
    job.add_argument("--end", type=dt.date.fromisoformat)

    job = jobs.add_parser("fit", help="fit a model on the training table, store it and its reports")
    job.add_argument("--training", required=True)
    job.add_argument("--kind", choices=sorted(KINDS), default="gbt")
    job.add_argument("--models", required=True)
    job.add_argument("--output", required=True, help="folder of the reports: search, holdout, weights, threshold, review")
    job.add_argument("--grid", type=json.loads, help='parameters to search, as {"name": [values]}')
    job.add_argument("--splits", type=int, default=10)
    job.add_argument("--at", type=dt.datetime.fromisoformat)

    job = jobs.add_parser("score", help="score the posts seen last, store them and their alerts")
    job.add_argument("--rising", required=True)
    job.add_argument("--models", required=True)
    job.add_argument("--model", help="full model name; the newest one if left out")
    job.add_argument("--threshold", type=float, help="0 if neither this nor --reports is given")
    job.add_argument("--reports", help="folder of the fit's reports, for the model's own threshold")
    job.add_argument("--scored", required=True)
    job.add_argument("--alerts", required=True)
    job.add_argument("--as-of", type=dt.datetime.fromisoformat)

    job = jobs.add_parser("report", help="precision and recall of past alerts per feed")
    job.add_argument("--scored", required=True)
    job.add_argument("--hot", required=True)
    job.add_argument("--output", required=True)
    job.add_argument("--as-of", type=dt.datetime.fromisoformat)
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _arguments().parse_args(argv)
    os.environ["TZ"] = "UTC"
    spark = build_session(f"posttrend-{args.job}")
    if args.job == "collect":
        collect_put(read_listing(spark, args.listing), {"rising": args.rising, "hot": args.hot})
    elif args.job == "training":
        rising, hot = read_snapshots(spark, args.rising), read_snapshots(spark, args.hot)
        build_training(rising, hot, args.output, start=args.start, end=args.end)
    elif args.job == "fit":
        at = _naive(args.at) if args.at else None
        build_model(read_training(spark, args.training), args.kind, args.models, args.output, args.grid, args.splits, at)
    elif args.job == "score":
        as_of = _naive(args.as_of or _now())
        if args.model:
            model, name = registry.load_model(args.models, args.model), args.model
        else:
            model, name = registry.load_latest(spark, args.models)
        rising = read_snapshots(spark, args.rising)
        # Runs are numbered by the minute they stand for, so repeating one replaces it.
        batch = int((as_of - dt.datetime(1970, 1, 1)).total_seconds() // 60)
        scorer = live.model_scorer(model)
        threshold = args.threshold
        if threshold is None:
            threshold = read_threshold(spark, args.reports, name) if args.reports else 0.0
        live.run_once(rising, scorer, name, threshold, args.scored, args.alerts, as_of, batch)
    else:
        as_of = _naive(args.as_of or _now())
        # Only posts created in the report's two days count, so older days are not read.
        scored = read_scored(spark, args.scored, since=(as_of - dt.timedelta(days=2)).date())
        rows = monitoring.report(scored, read_snapshots(spark, args.hot), as_of)
        rows.write.mode("overwrite").parquet(args.output)


if __name__ == "__main__":
    main()
