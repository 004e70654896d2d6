"""The jobs a user schedules: snapshot load, hourly capture, daily merge, gold refresh."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions import day_of
from tidemart.operators import latest_per_key
from tidemart.plans import marts
from tidemart.plans.late import SOURCES, build_notes
from tidemart.plans.views import replace_view, view_exists
from tidemart.registry import SHOP_TABLES, TableSpec, layer_name
from tidemart.session import prepare
from tidemart.slices import Slice, resolve_slice
from tidemart.sources import appendlog, extract, landing, partitions, snapshots, storage

#: Bytes of a log, as Spark expects them, for each bucket of keys that a month of a full build is dealt over.
BUCKET_BYTES = 512_000_000

GOLD_MODELS = ("order_items_fact", "product_dimension", "sales_report")


@dataclass(frozen=True)
class Pipeline:
    """Where everything lives and how it is sized. ``root`` is any folder all executors reach.

    ``log_mode="append"`` makes re-runs duplicate log rows instead of replacing their slice.
    ``buckets`` is the number of files of a main table; if not given it follows the table's size.
    ``keep_versions`` of a main table stay on disk for running readers. ``catalog_main`` names the main
    tables in a catalog with row-level changes, ``lake.shop.main_{table}``; merges then go there by
    native MERGE, which rewrites only what changes. The tables must exist.
    """

    root: str
    source: extract.Source
    database: str = "shop"
    target: str = "dev"
    registry: Mapping[str, TableSpec] = field(default_factory=lambda: SHOP_TABLES)
    log_mode: str = "replace_slice"
    buckets: int | None = None
    keep_versions: int = 2
    catalog_main: str | None = None
    max_records_per_file: int = 250_000
    readers: int = 8
    parallel_tables: int = 3
    fact_since: str = marts.FACT_SINCE
    dimension_since: str = marts.DIMENSION_SINCE
    report_since: str = marts.REPORT_SINCE

    def landing(self, table: str, window: Slice, init: bool = False) -> str:
        return f"{self.root}/landing/{window.path(self.database, table, init)}"

    def delta(self, table: str) -> str:
        return f"{self.root}/{layer_name('bronze', self.target)}/delta_{table}"

    def main(self, table: str) -> str:
        return f"{self.root}/{layer_name('bronze', self.target)}/main_{table}"

    def gold(self, model: str) -> str:
        return f"{self.root}/{layer_name('gold', self.target)}/{model}"

    def spec(self, table: str) -> TableSpec:
        return self.registry[table]


def _per_table(
    spark: SparkSession, cfg: Pipeline, tables: Iterable[str] | None, job: Callable[[TableSpec], object]
) -> dict[str, object]:
    """Run one independent job per table, a few at a time; one failing table stops no other."""
    names = list(tables if tables is not None else cfg.registry)
    done, failed = {}, []
    with ThreadPoolExecutor(max_workers=max(1, cfg.parallel_tables)) as pool:
        running = {n: pool.submit(inheritable_thread_target(spark)(job), cfg.spec(n)) for n in names}
        for name, future in running.items():
            try:
                done[name] = future.result()
            except Exception as error:
                error.add_note(f"table {name}")
                failed.append(error)
    if failed:
        raise ExceptionGroup("some tables failed", failed)
    return done


def _land_and_log(spark: SparkSession, cfg: Pipeline, rows: DataFrame, spec: TableSpec, window: Slice, init: bool):
    folder = cfg.landing(spec.name, window, init)
    landing.write_landing(rows, folder, cfg.max_records_per_file)
    label = f"init-{window.start:%Y-%m-%d-%H}" if init else window
    rows = landing.read_landing(spark, folder)
    appendlog.append_delta(rows, cfg.delta(spec.name), label, spec.audit, cfg.log_mode, one_day=not init)


def run_snapshot(spark: SparkSession, cfg: Pipeline, table: str | Iterable[str], at: datetime) -> None:
    """Load a whole source table, or several, into the append log, through landing files."""
    prepare(spark)

    def load(spec: TableSpec) -> None:
        rows = extract.read_snapshot(spark, cfg.source, spec, cfg.readers)
        _land_and_log(spark, cfg, rows, spec, Slice.hour(at), init=True)

    if isinstance(table, str):
        load(cfg.spec(table))
    else:
        _per_table(spark, cfg, table, load)


def run_hour(spark: SparkSession, cfg: Pipeline, hour: datetime, tables: Iterable[str] | None = None) -> None:
    """Capture one hour of every table. Re-running an hour replaces it."""
    prepare(spark)
    window = Slice.hour(hour)

    def capture(spec: TableSpec) -> None:
        rows = extract.read_window(spark, cfg.source, spec, window, cfg.readers)
        _land_and_log(spark, cfg, rows, spec, window, init=False)

    _per_table(spark, cfg, tables, capture)


def run_merge(
    spark: SparkSession, cfg: Pipeline, day: date | str, tables: Iterable[str] | None = None
) -> dict[str, object]:
    """Bring every main table up to a day; returns the current version of each (None for catalog tables).

    The first run builds a table from its whole log, later runs merge the rows of the day. A
    day without rows leaves the table as it is.
    """
    prepare(spark)
    window = Slice.day(day)

    def merge_native(spec: TableSpec) -> None:
        table = cfg.catalog_main.format(table=spec.name)
        since = None if spark.table(table).isEmpty() else window
        log = appendlog.read_delta(spark, cfg.delta(spec.name), since, spec.audit)
        snapshots.merge_into_table(spark, table, latest_per_key(log, spec.keys, spec.audit), spec.keys, spec.audit)

    def merge(spec: TableSpec) -> int | None:
        if cfg.catalog_main:
            return merge_native(spec)
        path = cfg.main(spec.name)
        if snapshots.read_current(spark, path, spec.keys) is None:
            log = appendlog.read_delta(spark, cfg.delta(spec.name))
            buckets = cfg.buckets or snapshots.buckets_for(storage.size(spark, cfg.delta(spec.name)))
            return snapshots.write_snapshot(latest_per_key(log, spec.keys, spec.audit), path, spec.keys, buckets)
        log = appendlog.read_delta(spark, cfg.delta(spec.name), window, spec.audit)
        if log.isEmpty():
            return snapshots.current_version(spark, path)
        changes = latest_per_key(log, spec.keys, spec.audit)
        version = snapshots.merge_snapshot(spark, path, changes, spec.keys, spec.audit, cfg.buckets)
        view = f"{layer_name('bronze', cfg.target)}.main_{spec.name}"
        if view_exists(spark, view):
            replace_view(spark, view, snapshots.current_query(spark, path, spec.keys))
        snapshots.expire_snapshots(spark, path, cfg.keep_versions)
        return version

    return _per_table(spark, cfg, tables, merge)


def run_gold(
    spark: SparkSession,
    cfg: Pipeline,
    execution_date: date | str | None = None,
    full_refresh: bool = False,
    today: date | None = None,
    grain: str = "item_day",
    clear_empty: bool = False,
) -> dict[str, Slice]:
    """Refresh fact and dimension, then the report that reads them; returns the slice each one built.

    The log of items is the table ``order_items``, that of products ``products``.
    """
    prepare(spark)
    today = today or datetime.now(timezone.utc).date()
    built: dict[str, Slice] = {}

    # This month and the last are still rebuilt day by day.
    open_since = (today.replace(day=1) - timedelta(days=1)).replace(day=1)

    def refresh(model: str, since: str, build: Callable[[Slice], DataFrame], day: Column) -> None:
        path = cfg.gold(model)
        exists = partitions.table_exists(spark, path)
        window = resolve_slice(
            full_refresh=full_refresh,
            execution_date=execution_date,
            target_exists=exists,
            today=today,
            since=since,
        )
        only = window.date if clear_empty and exists and window.kind == "day" else None
        notes = None
        if model in SOURCES:
            days = None if window.kind == "since" else [window.date]
            notes = build_notes(spark, path, cfg.delta(SOURCES[model]), days)
        partitions.overwrite_partitions(
            build(window), path, day, clear_empty=only, whole_table=full_refresh, gather_before=open_since, notes=notes,
            gathered=model in SOURCES,
        )
        view = f"{layer_name('gold', cfg.target)}.{model}"
        if view_exists(spark, view):
            replace_view(spark, view, partitions.partitions_query(spark, path))
        built[model] = window

    def log(table: str, window: Slice) -> DataFrame:
        return appendlog.read_delta(spark, cfg.delta(table), window, "updated_at")

    def images(model: Callable[..., DataFrame], table: str, window: Slice) -> DataFrame:
        rows = log(table, window)
        # A whole table is exchanged once: images are chosen where they will be written.
        spread = 1 + appendlog.expected_bytes(rows) // BUCKET_BYTES if full_refresh else None
        return model(rows, window, spread)

    def report(window: Slice) -> DataFrame:
        fact = partitions.read_partitions(spark, cfg.gold("order_items_fact"), window, "updated_at")
        dimension = partitions.read_partitions(spark, cfg.gold("product_dimension"))
        return marts.sales_report(fact, dimension, window, grain)

    changed = day_of("updated_at")
    steps = [
        ("order_items_fact", cfg.fact_since, lambda w: images(marts.order_items_fact, "order_items", w), changed),
        ("product_dimension", cfg.dimension_since, lambda w: images(marts.product_dimension, "products", w), changed),
    ]
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        for future in [pool.submit(inheritable_thread_target(spark)(refresh), *step) for step in steps]:
            future.result()
    refresh("sales_report", cfg.report_since, report, F.col("sales_date"))
    return built
