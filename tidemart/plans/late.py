"""Gold days made stale by slices of the log that were written again after the days were built.

The journal of a log says which days a write changed, and a gold table notes up to which write each of its days was
built. The days in between are stale; they are built again, and only they. From the items they go on to the report by their
date; from the products by the sales that the changed images can reach.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions import day_of
from tidemart.plans import marts
from tidemart.plans.views import replace_view, view_exists
from tidemart.registry import layer_name
from tidemart.session import prepare
from tidemart.slices import Slice
from tidemart.sources import appendlog, partitions, versions

# The log that each model is built from.
SOURCES = {"order_items_fact": "order_items", "product_dimension": "products"}
#: Up to so many days are read slice by slice; more are read in one pass from the first on.
SINGLE_DAYS = 31


def build_notes(spark: SparkSession, path: str, log: str, days: Iterable[date] | None) -> Mapping:
    """What a gold table notes of a build: the log's last write, for the days built or (None) for all."""
    last = appendlog.last_write(spark, log)
    before = partitions.table_notes(spark, path)
    if days is None or "base" not in before:
        return {"base": last, "built": {}}
    return {"base": before["base"], "built": before["built"] | {d.isoformat(): last for d in days}}


def stale_days(spark: SparkSession, path: str, log: str, since: str, today: date) -> list[date]:
    """Closed days of the table that the log has changed since they were built."""
    notes = partitions.table_notes(spark, path)
    if "base" not in notes:
        return []
    changed = appendlog.changed_days(spark, log, notes["base"])
    late = [d for d, write in changed.items() if write > notes["built"].get(d, notes["base"])]
    return sorted(d for d in map(date.fromisoformat, late) if date.fromisoformat(since) <= d < today)


def _log_days(spark: SparkSession, log: str, days: list[date]) -> DataFrame:
    if len(days) <= SINGLE_DAYS:
        return reduce(DataFrame.unionByName, [appendlog.read_delta(spark, log, Slice.day(d), "updated_at") for d in days])
    return appendlog.read_delta(spark, log, Slice.since(days[0]), "updated_at").filter(day_of("updated_at").isin(days))


def _reached(spark: SparkSession, cfg, days: list[date], today: date) -> set[date]:
    """Days of the report with sales that a changed product image can be the version of: sales of the product
    from the first changed image on."""
    path = cfg.gold("product_dimension")
    old = partitions.read_days(spark, path, days)
    new = marts.product_dimension(_log_days(spark, cfg.delta("products"), days))
    changed = old.exceptAll(new).unionByName(new.exceptAll(old))
    since = changed.groupBy(F.col("id").alias("product_id")).agg(F.min("updated_at").alias("changed_at"))
    fact = partitions.read_partitions(spark, cfg.gold("order_items_fact"))
    sales = marts.qualifying_sales(fact).select("product_id", "created_at", day_of("updated_at").alias("day"))
    hit = sales.join(since, "product_id").filter("created_at >= changed_at").select("day").distinct()
    return {r.day for r in hit.collect() if r.day < today}  # at most the calendar


def run_late(spark: SparkSession, cfg, today: date | None = None) -> dict[str, list[date]]:
    """Build again the gold days that late slices have made stale; returns them by model.

    Days from ``today`` on are left to their daily run. Days that the report owes are noted before anything is
    built, so a run that breaks off is made good by the next one.
    """
    prepare(spark)
    today = today or datetime.now(timezone.utc).date()
    gold = cfg.gold("sales_report")
    owed_at = f"{gold}/_late"
    since = {"order_items_fact": cfg.fact_since, "product_dimension": cfg.dimension_since}
    late = {m: stale_days(spark, cfg.gold(m), cfg.delta(t), since[m], today) for m, t in SOURCES.items()}
    owed = {date.fromisoformat(d) for n in versions.numbers(spark, owed_at) for d in versions.load(spark, owed_at, n)["days"]}
    report = owed | set(late["order_items_fact"])
    if late["product_dimension"] and partitions.table_exists(spark, cfg.gold("order_items_fact")):
        report |= _reached(spark, cfg, late["product_dimension"], today)
    if not partitions.table_exists(spark, gold):
        report = set()
    late["sales_report"] = sorted(d for d in report if d >= date.fromisoformat(cfg.report_since))
    if late["sales_report"]:
        versions.append(spark, owed_at, {"days": [d.isoformat() for d in late["sales_report"]]})

    models = {"order_items_fact": marts.order_items_fact, "product_dimension": marts.product_dimension}
    for model, table in SOURCES.items():
        if late[model]:
            notes = build_notes(spark, cfg.gold(model), cfg.delta(table), late[model])
            rows = models[model](_log_days(spark, cfg.delta(table), late[model]))
            _replace(spark, cfg, model, rows, "updated_at", late[model], notes)
    if late["sales_report"]:
        fact = partitions.read_days(spark, cfg.gold("order_items_fact"), late["sales_report"])
        rows = marts.sales_report(fact, partitions.read_partitions(spark, cfg.gold("product_dimension")))
        _replace(spark, cfg, "sales_report", rows, "sales_date", late["sales_report"], None)
    for number in versions.numbers(spark, owed_at):
        versions.drop(spark, owed_at, number)
    return late


def _replace(spark: SparkSession, cfg, model: str, rows: DataFrame, at: str, days: list[date], notes: Mapping | None) -> None:
    path, view = cfg.gold(model), f"{layer_name('gold', cfg.target)}.{model}"
    partitions.overwrite_partitions(rows, path, day_of(at), clear_empty=days, notes=notes)
    if view_exists(spark, view):
        replace_view(spark, view, partitions.partitions_query(spark, path))
