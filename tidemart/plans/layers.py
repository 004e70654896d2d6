"""Logical table names: opening stored tables, and publishing them as one namespace per layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemart.plans.jobs import GOLD_MODELS, Pipeline
from tidemart.plans.views import create_view, replace_view
from tidemart.registry import layer_name
from tidemart.slices import Slice
from tidemart.sources import appendlog, partitions, snapshots, storage


def open_table(spark: SparkSession, cfg: Pipeline, name: str, window: Slice | None = None) -> DataFrame:
    """A stored table by name: ``delta_<table>``, ``main_<table>`` or a gold model.

    A time slice prunes logs and gold tables; a main table has no time slices.
    """
    kind, _, table = name.partition("_")
    if kind == "delta" and table in cfg.registry:
        return appendlog.read_delta(spark, cfg.delta(table), window, cfg.spec(table).audit)
    if kind == "main" and table in cfg.registry:
        if window is not None:
            raise ValueError("main tables hold the current state only")
        current = snapshots.read_current(spark, cfg.main(table), cfg.spec(table).keys)
        if current is None:
            raise ValueError(f"{name} has not been built")
        return current
    if name in GOLD_MODELS:
        audit = None if name == "sales_report" else "updated_at"
        return partitions.read_partitions(spark, cfg.gold(name), window, audit)
    raise ValueError(f"unknown table {name!r}")


def publish(spark: SparkSession, cfg: Pipeline) -> list[str]:
    """Create a database per layer and a view per stored table, for SQL users; returns the views.

    The view of a main or gold table shows one version; every job that writes the table renews it.
    A table without rows gets no view.
    """
    bronze, gold = layer_name("bronze", cfg.target), layer_name("gold", cfg.target)
    for database in (bronze, layer_name("silver", cfg.target), gold):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS spark_catalog.{database}")
    views = []
    for table, spec in cfg.registry.items():
        if storage.exists(spark, f"{cfg.delta(table)}/_schema.json"):
            log = appendlog.read_delta(spark, cfg.delta(table))
            if not log.isEmpty():
                views.append(f"{bronze}.delta_{table}")
                create_view(spark, views[-1], log.columns, cfg.delta(table))
        if snapshots.current_version(spark, cfg.main(table)) is not None:
            views.append(f"{bronze}.main_{table}")
            replace_view(spark, views[-1], snapshots.current_query(spark, cfg.main(table), spec.keys))
    for model in GOLD_MODELS:
        if partitions.table_exists(spark, cfg.gold(model)):
            stored = partitions.read_partitions(spark, cfg.gold(model))
            if not stored.isEmpty():
                views.append(f"{gold}.{model}")
                replace_view(spark, views[-1], partitions.partitions_query(spark, cfg.gold(model)))
    return views
