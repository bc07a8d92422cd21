"""Command line: ``spark-submit`` or ``python -m kerbside <stage> --lake <root>``."""

from __future__ import annotations

import argparse
import json
from datetime import date

from kerbside.operators.views import VIEWS
from kerbside.plans import jobs
from kerbside.session import CLUSTER_CONF, build_session, object_store_conf
from kerbside.settings import LakeLayout, Period

CHECKS = {
    "check-bronze": jobs.check_bronze,
    "check-rejects": jobs.check_rejects,
    "check-silver": jobs.check_silver,
    "check-gold": jobs.check_gold,
    "check-layers": jobs.check_layers,
}


# Columns of the layer check that must not be false.
LAYERS_DISAGREE = {"some_removed", "gold_matches_silver"}


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="kerbside", description="Trip analytics on Spark.")
    parser.add_argument("stage", choices=["bronze", "mark", "silver", "gold", "serve", *CHECKS])
    parser.add_argument("--lake", required=True, help="root of the lake, any Hadoop path")
    parser.add_argument("--start", type=date.fromisoformat, default=Period.start, help="first day, a first of month")
    parser.add_argument("--end", type=date.fromisoformat, default=Period.end, help="first day after the period")
    parser.add_argument("--only-these-months", action="store_true", help="replace these months, keep the others")
    parser.add_argument("--by-year", action="store_true", help="monthly tables carry the year as well")
    parser.add_argument("--view", choices=[*VIEWS, "dash-popular-routes", "dash-monthly-averages"])
    parser.add_argument("--s3-endpoint", help="endpoint of an S3-compatible store for s3a:// paths")
    return parser.parse_args()


def main() -> None:
    args = _arguments()
    if args.stage == "serve" and not args.view:
        raise SystemExit("serve needs --view")
    confs = [CLUSTER_CONF, object_store_conf(args.s3_endpoint)] if args.s3_endpoint else [CLUSTER_CONF]
    spark = build_session(f"kerbside {args.stage}", *confs)
    lake, period = LakeLayout(args.lake), Period(args.start, args.end)
    if args.stage == "bronze":
        print(f"bronze rows: {jobs.build_bronze(spark, lake, period, args.only_these_months)}")
    elif args.stage == "mark":
        print(f"marked rows: {jobs.build_marked(spark, lake, period)}")
    elif args.stage == "silver":
        print(f"silver rows: {jobs.build_silver(spark, lake, period, only_these_months=args.only_these_months)}")
    elif args.stage == "gold":
        for table, rows in jobs.build_gold(spark, lake, args.by_year or None, period, args.only_these_months).items():
            print(f"{table} rows: {rows}")
    elif args.stage == "serve":
        for line in jobs.serve(spark, lake, args.view).toJSON().toLocalIterator():
            print(line)
    else:
        problems: list[str] = []
        for name, report in CHECKS[args.stage](spark, lake).items():
            print(name)
            for line in report.toJSON().toLocalIterator():
                print(line)
                problems += LAYERS_DISAGREE & {f for f, value in json.loads(line).items() if value is False}
        if problems:
            spark.stop()
            raise SystemExit(f"failed: {', '.join(problems)}")
    spark.stop()


if __name__ == "__main__":
    main()
