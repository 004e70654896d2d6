"""One query per operator and job, each over whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.checks import views
from tidemart.functions import day_of, exact, hour_end, iso_day, previous_day, signed_total, slice_path
from tidemart.operators import asof_join, latest_per_key, upsert
from tidemart.plans import (
    Pipeline,
    open_table,
    order_items_fact,
    product_dimension,
    publish,
    qualifying_sales,
    run_gold,
    run_hour,
    run_late,
    run_merge,
    run_snapshot,
    sales_report,
)
from tidemart.plans.marts import sales_with_product
from tidemart.registry import TableSpec
from tidemart.session import scratch, prepare
from tidemart.slices import Slice, resolve_slice
from tidemart.sources import (
    FileSource,
    append_delta,
    expire_snapshots,
    overwrite_partitions,
    read_current,
    read_delta,
    read_landing,
    read_partitions,
    read_snapshot,
    read_window,
    storage,
    write_landing,
    write_snapshot,
)
from tidemart.sources.snapshots import merge_snapshot
from tidemart.streaming import landing_stream, stream_upsert

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

HOURS = (datetime(2024, 1, 2, 5), datetime(2024, 1, 2, 6), datetime(2024, 1, 17, 23))
SOLD_DAY = date(1998, 6, 16)
PRODUCT_DAY = date(1998, 5, 2)
CUT = "1996-01-01"


def query(build: Query) -> Query:
    """Register a query under its function's name; a last underscore only tells it from an import."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(prepare(spark), sf_dir)

    QUERIES[build.__name__.rstrip("_")] = run
    return run


# Scans, filters, labels


@query
def snapshot_scan(spark, sf):
    return read_snapshot(spark, views.source(sf), views.ORDERS)


@query
def hourly_window_extract(spark, sf):
    return read_window(spark, views.source(sf), views.EVENTS, Slice.hour(HOURS[0]))


@query
def hourly_window_extract_dates(spark, sf):
    """The first and the last hour of a day by an audit column of dates: all rows of the day, and none."""
    root = scratch(spark, "dates")
    views.table(spark, sf, "events").withColumn("day", day_of("ts")).write.parquet(f"{root}/events")
    spec = TableSpec("events", ("event_id",), "day")
    hours = (datetime(2024, 1, 2, 0), datetime(2024, 1, 2, 23))
    parts = [read_window(spark, FileSource(root), spec, Slice.hour(h)).withColumn("hour", F.lit(h.hour)) for h in hours]
    return reduce(DataFrame.unionByName, parts)


@query
def slice_path_labels(spark, sf):
    events = views.table(spark, sf, "events")
    return events.groupBy(
        slice_path("ts").alias("hour_path"),
        hour_end("ts").cast("timestamp_ntz").alias("hour_end"),
        iso_day(previous_day(day_of("ts"))).alias("previous_day"),
    ).agg(F.count("*").alias("n"))


@query
def slice_resolution(spark, sf):
    """Rows of the item log under each way a slice can be resolved."""
    ways = {
        "full_refresh": dict(full_refresh=True, execution_date="1998-06-16", target_exists=True),
        "explicit_date": dict(full_refresh=False, execution_date="1998-06-16", target_exists=True),
        "explicit_first_run": dict(full_refresh=False, execution_date="1998-05-02", target_exists=False),
        "yesterday": dict(full_refresh=False, execution_date=None, target_exists=True),
    }
    log = views.order_items_log(spark, sf).select("updated_at")
    matches = {}
    for way, flags in ways.items():
        window = resolve_slice(**flags, today=date(1998, 6, 20), since="1995-01-01")
        matches[way] = window.predicate("updated_at")
    hit = F.array_compact(F.array(*[F.when(keep, F.lit(way)) for way, keep in matches.items()]))
    return (
        log.select("updated_at", F.explode(hit).alias("way"))
        .groupBy("way")
        .agg(
            F.count("*").alias("n"),
            F.min(day_of("updated_at")).alias("first_day"),
            F.max(day_of("updated_at")).alias("last_day"),
        )
    )


@query
def day_slice(spark, sf):
    return views.table(spark, sf, "events").filter(Slice.day("2024-01-02").predicate("ts"))


@query
def since_slice(spark, sf):
    return views.order_items_log(spark, sf).filter(Slice.since(CUT).predicate("updated_at"))


# Landing files and the append log


@query
def landing_roundtrip(spark, sf):
    folder = f"{scratch(spark, 'landing')}/{Slice.hour(HOURS[0]).path('shop', 'events')}"
    write_landing(views.table(spark, sf, "events"), folder)
    return read_landing(spark, folder)


@query
def landing_roundtrip_texts(spark, sf):
    folder = scratch(spark, "landing-texts")
    write_landing(views.table(spark, sf, "documents"), folder)
    return read_landing(spark, folder)


@query
def delta_append_replay(spark, sf):
    """A snapshot slice and an hour slice, each written twice: re-runs change nothing."""
    log = scratch(spark, "delta")
    events, hour = views.table(spark, sf, "events"), Slice.hour(HOURS[0])
    for _ in range(2):
        append_delta(events, log, "init-2024-01-01-00", "ts")
        append_delta(events.filter(hour.predicate("ts")), log, hour, "ts", one_day=True)
    return read_delta(spark, log)


@query
def delta_append_plain(spark, sf):
    """Plain appends: a re-run duplicates the slice."""
    log = scratch(spark, "delta")
    for _ in range(2):
        append_delta(views.table(spark, sf, "orders"), log, "init-2024-01-01-00", "o_orderdate", mode="append")
    return read_delta(spark, log)


def _pipeline(spark, sf, spec: TableSpec, purpose: str) -> Pipeline:
    return Pipeline(scratch(spark, purpose), views.source(sf), registry={spec.name: spec})


@query
def snapshot_to_delta(spark, sf):
    cfg = _pipeline(spark, sf, views.ORDERS, "snapshot")
    run_snapshot(spark, cfg, "orders", HOURS[0])
    return read_delta(spark, cfg.delta("orders"))


@query
def hourly_cdc_cycle(spark, sf):
    """A snapshot of all events and three captured hours after it, one of them captured twice."""
    cfg = _pipeline(spark, sf, views.EVENTS, "cycle")
    run_snapshot(spark, cfg, "events", HOURS[0])
    for hour in (*HOURS, HOURS[0]):
        run_hour(spark, cfg, hour)
    return read_delta(spark, cfg.delta("events"))


def _census(name: str, df: DataFrame, spec: TableSpec) -> DataFrame:
    # Two plain aggregations instead of a distinct count: rows per key, then totals.
    per_key = df.groupBy(*spec.keys).agg(F.count("*").alias("n"), F.max(spec.audit).alias("last"))
    return per_key.agg(
        F.lit(name).alias("table_name"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count("*").alias("n_keys"),
        F.max("last").alias("last_audit"),
    )


@query
def registry_fanout(spark, sf):
    """Rows and keys of every table of the registry."""
    parts = [
        _census("orders", views.table(spark, sf, "orders"), views.ORDERS),
        _census("lineitem", views.table(spark, sf, "lineitem"), views.LINEITEM),
        _census("events", views.table(spark, sf, "events"), views.EVENTS),
        _census("feed", views.table(spark, sf, "events"), views.FEED),
        _census("order_items", views.order_items_log(spark, sf), views.ORDER_ITEMS),
        _census("products", views.products_log(spark, sf), views.PRODUCTS),
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def hourly_cdc_fanout(spark, sf):
    """Snapshots of three tables, then one captured hour of all of them; what their logs hold."""
    specs = (views.ORDERS, views.LINEITEM, views.EVENTS)
    cfg = Pipeline(scratch(spark, "fanout"), views.source(sf), registry={s.name: s for s in specs})
    run_snapshot(spark, cfg, [s.name for s in specs], HOURS[0])
    run_hour(spark, cfg, datetime(1996, 1, 2))
    return reduce(DataFrame.unionByName, [_census(s.name, open_table(spark, cfg, f"delta_{s.name}"), s) for s in specs])


# Latest images and the merge


@query
def latest_per_key_(spark, sf):
    return latest_per_key(views.table(spark, sf, "events"), ["user_id"], "ts")


@query
def latest_per_key_reserved(spark, sf):
    """Columns of any name are kept."""
    events = views.table(spark, sf, "events").withColumns({"_rank": F.col("event_id") % 7, "place": F.col("user_id") * 2})
    return latest_per_key(events, ["user_id"], "ts")


@query
def latest_per_key_items(spark, sf):
    return latest_per_key(views.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate")


@query
def latest_per_key_per_day(spark, sf):
    return latest_per_key(views.table(spark, sf, "events"), ["user_id"], "ts", per_day=True)


def _images(spark, sf, newer: bool) -> DataFrame:
    log = views.order_items_log(spark, sf)
    late = Slice.since(CUT).predicate("updated_at")
    return latest_per_key(log.filter(late if newer else ~late), ["id"], "updated_at")


@query
def merge_upsert(spark, sf):
    """Images before the cut merged with those since: inserts, updates and untouched rows."""
    return upsert(_images(spark, sf, newer=False), _images(spark, sf, newer=True), ["id"], "updated_at")


@query
def merge_stale_guard(spark, sf):
    """The same merge the wrong way round: every matched change is stale, only inserts happen."""
    return upsert(_images(spark, sf, newer=True), _images(spark, sf, newer=False), ["id"], "updated_at")


@query
def main_bootstrap(spark, sf):
    path, keys = scratch(spark, "main"), ["user_id"]
    events = views.table(spark, sf, "events")
    if read_current(spark, path, keys) is None:
        write_snapshot(latest_per_key(events, keys, "ts"), path, keys)
    return read_current(spark, path, keys)


@query
def daily_merge(spark, sf):
    """Main built from the log up to a day, then that day's slice logged and merged, twice."""
    cfg = _pipeline(spark, sf, views.FEED, "merge")
    day = Slice.day("2024-01-30")
    events = views.table(spark, sf, "events")
    append_delta(events.filter(~day.predicate("ts")), cfg.delta("events"), "init-2024-01-30-00", "ts")
    run_merge(spark, cfg, "2024-01-29")
    append_delta(events.filter(day.predicate("ts")), cfg.delta("events"), day, "ts", one_day=True)
    for _ in range(2):
        run_merge(spark, cfg, "2024-01-30")
    return read_current(spark, cfg.main("events"), ["user_id"])


@query
def daily_merge_out_of_order(spark, sf):
    """Main built up to a day, then the day after the next merged, and the day between last: stale for most users."""
    cfg = _pipeline(spark, sf, views.FEED, "merge")
    events, days = views.table(spark, sf, "events"), [Slice.day(f"2024-01-{n}") for n in (28, 29, 30)]
    append_delta(events.filter(F.col("ts") < F.lit("2024-01-28")), cfg.delta("events"), "init-2024-01-28-00", "ts")
    run_merge(spark, cfg, "2024-01-27")
    for day in (days[0], days[2], days[1]):
        append_delta(events.filter(day.predicate("ts")), cfg.delta("events"), day, "ts", one_day=True)
        run_merge(spark, cfg, day.date)
    return read_current(spark, cfg.main("events"), ["user_id"])


@query
def merge_folded(spark, sf):
    """Main built up to a day, then four days merged one by one; buckets with over two change files are folded."""
    path, keys = scratch(spark, "main"), ["user_id"]
    events, first = views.table(spark, sf, "events"), F.lit("2024-01-27")
    write_snapshot(latest_per_key(events.filter(F.col("ts") < first), keys, "ts"), path, keys)
    for n in (27, 28, 29, 30):
        day = events.filter(Slice.day(f"2024-01-{n}").predicate("ts"))
        merge_snapshot(spark, path, latest_per_key(day, keys, "ts"), keys, "ts", max_changes=2)
        expire_snapshots(spark, path, keep=1)
    return read_current(spark, path, keys)


@query
def layer_views(spark, sf):
    """Log and current state published as SQL views, a day merged after that, and what the views show then."""
    cfg = _pipeline(spark, sf, views.FEED, "layers")
    day, events = Slice.day("2024-01-30"), views.table(spark, sf, "events")
    append_delta(events.filter(~day.predicate("ts")), cfg.delta("events"), "init-2024-01-30-00", "ts")
    run_merge(spark, cfg, "2024-01-29")
    publish(spark, cfg)
    append_delta(events.filter(day.predicate("ts")), cfg.delta("events"), day, "ts", one_day=True)
    run_merge(spark, cfg, "2024-01-30")
    spark.catalog.refreshTable("spark_catalog.bronze.delta_events")
    logged = spark.sql("select user_id, count(*) as n_logged from spark_catalog.bronze.delta_events group by user_id")
    return spark.sql("select * from spark_catalog.bronze.main_events").join(logged, "user_id", "left")


# Gold tables


@query
def order_items_fact_full(spark, sf):
    return order_items_fact(views.order_items_log(spark, sf), Slice.since("1990-01-01"))


@query
def order_items_fact_day(spark, sf):
    return order_items_fact(views.order_items_log(spark, sf), Slice.day(SOLD_DAY))


@query
def product_dimension_full(spark, sf):
    return product_dimension(views.products_log(spark, sf), Slice.since("1990-01-01"))


@query
def product_dimension_day(spark, sf):
    return product_dimension(views.products_log(spark, sf), Slice.day(PRODUCT_DAY))


@query
def overwrite_partitions_(spark, sf):
    """All days written, then the second half of them rebuilt with doubled values."""
    path = scratch(spark, "days")
    events, day = views.table(spark, sf, "events"), day_of("ts")
    overwrite_partitions(events, path, day)
    late = events.filter(Slice.since("2024-01-16").predicate("ts"))
    overwrite_partitions(late.withColumn("value", F.col("value") * 2), path, day)
    return read_partitions(spark, path)


@query
def qualifying_sales_(spark, sf):
    return qualifying_sales(views.fact(spark, sf))


def _asof(spark, sf, slot_seconds: int) -> DataFrame:
    versions = views.dimension(spark, sf).select(
        F.col("id").alias("product_id"), F.col("updated_at").alias("version_at"), "brand", "department", "category"
    )
    sales = views.fact(spark, sf).select("id", "product_id", "created_at", "updated_at")
    return asof_join(sales, versions, ["product_id"], "created_at", "version_at", slot_seconds=slot_seconds)


@query
def asof_left_join(spark, sf):
    """Every fact row with the product version in force when its order was placed."""
    return _asof(spark, sf, 3_600)


@query
def asof_left_join_slots(spark, sf):
    """The same join with time cut into days."""
    return _asof(spark, sf, 86_400)


@query
def asof_left_join_dense(spark, sf):
    """Every purchase with the user's last other event before it: many versions per key and day."""
    events = views.table(spark, sf, "events")
    bought = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts", "value")
    seen = events.filter("event_type <> 'purchase'").select("user_id", F.col("ts").alias("seen_at"), F.col("event_type").alias("seen_type"))
    return asof_join(bought, seen, ["user_id"], "ts", "seen_at")


@query
def signed_sales_by_status(spark, sf):
    total = signed_total(exact("sale_price"), "returned_at").cast("double")
    return views.fact(spark, sf).groupBy("status").agg(total.alias("total_sales"))


@query
def signed_sales_exact(spark, sf):
    """Decimal prices, with three decimals, give decimal totals."""
    price = (F.col("sale_price").cast("decimal(14,2)") / F.lit(8).cast("decimal(2,0)")).cast("decimal(18,5)")
    total = signed_total(price, "returned_at").cast("decimal(38,5)")
    return views.fact(spark, sf).groupBy("status").agg(total.alias("total_sales"))


@query
def sales_with_product_version(spark, sf):
    return sales_with_product(views.fact(spark, sf), views.dimension(spark, sf))


@query
def sales_report_full(spark, sf):
    return sales_report(views.fact(spark, sf), views.dimension(spark, sf), Slice.since("1990-01-01"))


@query
def sales_report_day(spark, sf):
    window = Slice.day(SOLD_DAY)
    day_fact = order_items_fact(views.order_items_log(spark, sf), window)
    return sales_report(day_fact, views.dimension(spark, sf), window)


@query
def sales_report_per_item(spark, sf):
    return sales_report(views.fact(spark, sf), views.dimension(spark, sf), grain="item")


@query
def gold_refresh(spark, sf):
    """All gold tables built in full without one day, then that day logged and built; the stored report."""
    cfg = Pipeline(
        scratch(spark, "gold"),
        views.source(sf),
        registry={s.name: s for s in (views.ORDER_ITEMS, views.PRODUCTS)},
        fact_since="1990-01-01",
        dimension_since="1990-01-01",
        report_since="1990-01-01",
    )
    items, day = views.order_items_log(spark, sf), Slice.day(SOLD_DAY)
    append_delta(views.products_log(spark, sf), cfg.delta("products"), "init-2000-01-01-00", "updated_at")
    append_delta(
        items.filter(~day.predicate("updated_at")), cfg.delta("order_items"), "init-2000-01-01-00", "updated_at"
    )
    run_gold(spark, cfg, full_refresh=True)
    append_delta(
        items.filter(day.predicate("updated_at")), cfg.delta("order_items"), day, "updated_at", one_day=True
    )
    run_gold(spark, cfg, execution_date=SOLD_DAY)
    return open_table(spark, cfg, "sales_report")


@query
def gold_of_yesterday(spark, sf):
    """A first build of one day, then the build that a clock one day later asks for; the stored report."""
    cfg = Pipeline(scratch(spark, "gold"), views.source(sf), registry={s.name: s for s in (views.ORDER_ITEMS, views.PRODUCTS)})
    append_delta(views.products_log(spark, sf), cfg.delta("products"), "init-2000-01-01-00", "updated_at")
    append_delta(views.order_items_log(spark, sf), cfg.delta("order_items"), "init-2000-01-01-00", "updated_at")
    run_gold(spark, cfg, execution_date=SOLD_DAY - timedelta(days=1))
    run_gold(spark, cfg, today=SOLD_DAY + timedelta(days=1))
    return open_table(spark, cfg, "sales_report")


@query
def gold_late_slice(spark, sf):
    """A day logged without half of its items, all gold tables built, then its slice logged again as a whole, and the days
    that this changes built again; the stored report."""
    cfg = Pipeline(
        scratch(spark, "gold"),
        views.source(sf),
        registry={s.name: s for s in (views.ORDER_ITEMS, views.PRODUCTS)},
        fact_since="1990-01-01",
        dimension_since="1990-01-01",
        report_since="1990-01-01",
    )
    items, day = views.order_items_log(spark, sf), Slice.day(SOLD_DAY)
    of_day = day.predicate("updated_at")
    append_delta(views.products_log(spark, sf), cfg.delta("products"), "init-2000-01-01-00", "updated_at")
    append_delta(items.filter(~of_day), cfg.delta("order_items"), "init-2000-01-01-00", "updated_at")
    append_delta(items.filter(of_day).filter("id % 2 = 0"), cfg.delta("order_items"), day, "updated_at", one_day=True)
    run_gold(spark, cfg, full_refresh=True)
    append_delta(items.filter(of_day), cfg.delta("order_items"), day, "updated_at", one_day=True)
    run_late(spark, cfg)
    return open_table(spark, cfg, "sales_report")


# Micro-batches


@query
def landing_stream_(spark, sf):
    """Two landing slices holding all events, loaded by two runs; the second run sees only the second slice."""
    root = scratch(spark, "stream")
    events, cut = views.table(spark, sf, "events"), Slice.since("2024-01-16")
    slices = {HOURS[0]: events.filter(~cut.predicate("ts")), HOURS[2]: events.filter(cut.predicate("ts"))}
    for hour, rows in slices.items():
        write_landing(rows, f"{root}/{Slice.hour(hour).path('shop', 'events')}")
        load = landing_stream(
            spark, f"{root}/shop/events/*/*/data", events.schema, f"{root}/delta", "ts", f"{root}/checkpoint"
        )
        load.awaitTermination()
    return read_delta(spark, f"{root}/delta")


def _backdate(spark, folder: str, days: int) -> None:
    """Files as an archive or a backfill brings them: older than what was read before."""
    at = int((datetime.now().timestamp() - days * 86_400) * 1000)
    jvm = spark._jvm.org.apache.hadoop.fs
    for place, names in storage.files_below(spark, folder).items():
        for name in names:
            path = jvm.Path(f"{place}/{name}")
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).setTimes(path, at, at)


def _land_and_stream(spark, sf, root: str, slices: list) -> DataFrame:
    """Lands slices of events one after another, each followed by a run of the stream; the log."""
    events = views.table(spark, sf, "events")
    for hour, keep, days in slices:
        folder = f"{root}/{Slice.hour(hour).path('shop', 'events')}"
        write_landing(events.filter(keep), folder)
        _backdate(spark, f"{folder}/data", days)
        load = landing_stream(
            spark, f"{root}/shop/events/*/*/data", events.schema, f"{root}/delta", "ts", f"{root}/checkpoint"
        )
        load.awaitTermination()
    return read_delta(spark, f"{root}/delta")


@query
def landing_stream_late(spark, sf):
    """The second landing slice comes in files dated 20 days back."""
    late = Slice.since("2024-01-16").predicate("ts")
    return _land_and_stream(spark, sf, scratch(spark, "stream"), [(HOURS[0], ~late, 0), (HOURS[2], late, 20)])


@query
def landing_stream_replay(spark, sf):
    """One landing slice is landed twice, the other once: the log holds every event once."""
    late = Slice.since("2024-01-16").predicate("ts")
    slices = [(HOURS[0], ~late, 0), (HOURS[2], late, 0), (HOURS[0], ~late, 0)]
    return _land_and_stream(spark, sf, scratch(spark, "stream"), slices)


@query
def stream_upsert_late(spark, sf):
    """The second slice of the log comes in files dated 20 days back."""
    root = scratch(spark, "stream")
    events, late = views.table(spark, sf, "events"), Slice.since("2024-01-16").predicate("ts")
    for label, keep, days in (("a", ~late, 0), ("b", late, 20)):
        append_delta(events.filter(keep), f"{root}/delta", label, "ts")
        _backdate(spark, f"{root}/delta/slice={label}", days)
        merge = stream_upsert(spark, f"{root}/delta", f"{root}/main", views.FEED, f"{root}/checkpoint")
        merge.awaitTermination()
    return read_current(spark, f"{root}/main", ["user_id"])


@query
def stream_upsert_(spark, sf):
    """The log of all events in two slices, merged by two runs into the latest event of each user."""
    root = scratch(spark, "stream")
    events, cut = views.table(spark, sf, "events"), Slice.since("2024-01-16")
    for label, rows in {"a": events.filter(~cut.predicate("ts")), "b": events.filter(cut.predicate("ts"))}.items():
        append_delta(rows, f"{root}/delta", label, "ts")
        merge = stream_upsert(spark, f"{root}/delta", f"{root}/main", views.FEED, f"{root}/checkpoint")
        merge.awaitTermination()
    return read_current(spark, f"{root}/main", ["user_id"])
