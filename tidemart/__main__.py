"""The jobs for a scheduler: ``spark-submit ... -m tidemart`` or ``python -m tidemart``.

The settings file is JSON, for example::

    {"root": "s3a://lake/shop", "database": "shop",
     "jdbc": {"url": "jdbc:postgresql://host/shop", "properties": {"user": "reader"}}}

with ``"files": {"root": ..., "format": ..., "suffix": ...}`` in place of ``jdbc`` for file
sources, and ``"tables": {name: {"key": ..., "audit": ...}}`` for tables other than the shop's.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import SparkSession

from tidemart.plans import Pipeline, publish, run_gold, run_hour, run_late, run_merge, run_snapshot
from tidemart.registry import load_registry
from tidemart.session import build_session
from tidemart.sources import FileSource, JdbcSource


def load_pipeline(settings: dict) -> Pipeline:
    settings = dict(settings)
    if ("jdbc" in settings) == ("files" in settings):
        raise ValueError("give either a jdbc or a files source")
    source = JdbcSource(**settings.pop("jdbc")) if "jdbc" in settings else FileSource(**settings.pop("files"))
    if "tables" in settings:
        settings["registry"] = load_registry(settings.pop("tables"))
    return Pipeline(source=source, **settings)


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tidemart")
    parser.add_argument("--settings", required=True, help="path of the JSON settings file")
    jobs = parser.add_subparsers(dest="job", required=True)
    snapshot = jobs.add_parser("snapshot", help="load whole tables")
    snapshot.add_argument("table", nargs="+")
    snapshot.add_argument("--at", type=datetime.fromisoformat)
    hour = jobs.add_parser("hour", help="capture one hour; by default the last full one")
    hour.add_argument("--hour", type=datetime.fromisoformat)
    merge = jobs.add_parser("merge", help="merge one day; by default yesterday")
    merge.add_argument("--day", type=date.fromisoformat)
    for job in (hour, merge):
        job.add_argument("--table", action="append", dest="tables", help="only this table; may be repeated")
    gold = jobs.add_parser("gold", help="refresh the gold tables; by default for yesterday")
    gold.add_argument("--day", type=date.fromisoformat)
    gold.add_argument("--full-refresh", action="store_true")
    gold.add_argument("--clear-empty", action="store_true")
    gold.add_argument("--grain", choices=("item_day", "item"), default="item_day", help="count an item once a day or once a build")
    jobs.add_parser("late", help="build the gold days again that slices captured again have changed")
    jobs.add_parser("publish", help="create or renew the SQL views")
    return parser


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _arguments().parse_args(argv)
    with open(args.settings) as file:
        cfg = load_pipeline(json.load(file))
    spark = spark or build_session(f"tidemart-{args.job}")
    now = datetime.now(timezone.utc)
    if args.job == "snapshot":
        run_snapshot(spark, cfg, args.table, args.at or now)
    elif args.job == "hour":
        run_hour(spark, cfg, args.hour or now - timedelta(hours=1), args.tables)
    elif args.job == "merge":
        run_merge(spark, cfg, args.day or (now - timedelta(days=1)).date(), args.tables)
    elif args.job == "gold":
        run_gold(spark, cfg, args.day, args.full_refresh, now.date(), args.grain, args.clear_empty)
    elif args.job == "late":
        run_late(spark, cfg, now.date())
    else:
        publish(spark, cfg)


if __name__ == "__main__":
    main()
