import json
import os
from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql.classic.dataframe import DataFrame

from tests.conftest import rows_of
from tidemart.__main__ import load_pipeline, main
from tidemart.operators import latest_per_key
from tidemart.plans import Pipeline, open_table, publish, run_gold, run_hour, run_merge, run_snapshot, sales_report
from tidemart.plans.marts import order_items_fact, product_dimension
from tidemart.registry import load_registry
from tidemart.slices import Slice
from tidemart.sources import FileSource, read_current, read_delta, read_landing, read_partitions

ITEMS = (
    "id long, order_id long, user_id long, product_id long, inventory_item_id long, status string, created_at timestamp,"
    " updated_at timestamp, shipped_at timestamp, delivered_at timestamp, returned_at timestamp, sale_price double"
)
PRODUCTS = "id long, brand string, department string, category string, updated_at timestamp, cost double"
ORDERS = "order_id long, status string, updated_at timestamp"
USERS = "id long, name string, created_at timestamp"
EVENTS = "id long, kind string, created_at timestamp"


def t(day, hour=0, minute=0):
    return datetime(2024, 1, day, hour, minute)


def write_source(spark, root, **tables):
    kinds = dict(order_items=ITEMS, products=PRODUCTS, orders=ORDERS, users=USERS, events=EVENTS)
    for name, rows in tables.items():
        spark.createDataFrame(rows, kinds[name]).write.mode("overwrite").parquet(f"{root}/{name}")


def sold(id, day, delivered, returned=None, product=1, price=10.0):
    return (id, id, 1, product, 1, "s", t(1), t(day, 5, 30), t(2), delivered, returned, price)


@pytest.fixture
def shop(spark, tmp_path):
    write_source(
        spark,
        tmp_path / "src",
        users=[(1, "a", t(3, 5)), (2, "b", t(4, 5))],
        products=[(1, "b1", "Men", "c", t(1), 1.0), (2, "b2", "Women", "c", t(3, 5), 1.0)],
        orders=[(1, "new", t(3, 4, 59)), (2, "new", t(3, 5)), (3, "new", t(3, 5, 59)), (4, "new", t(3, 6))],
        order_items=[sold(1, 3, t(3)), sold(2, 3, t(3), product=2), sold(3, 4, t(3), t(4))],
        events=[(1, "x", t(3, 5, 1))],
    )
    return Pipeline(str(tmp_path / "lake"), FileSource(str(tmp_path / "src")), buckets=4)


def test_hour_of_every_table(spark, shop):
    for _ in range(2):
        run_hour(spark, shop, t(3, 5, 15))
    logged = {name: read_delta(spark, shop.delta(name)) for name in shop.registry}
    assert {n: df.count() for n, df in logged.items()} == {
        "users": 1,
        "products": 1,
        "orders": 2,
        "order_items": 2,
        "events": 1,
    }
    assert sorted(r.order_id for r in logged["orders"].collect()) == [2, 3]
    folder = shop.landing("orders", Slice.hour(t(3, 5)))
    assert folder.endswith("/landing/shop/orders/2024-01-03/05-00-00")
    assert read_landing(spark, folder).count() == 2


def test_append_mode_duplicates_a_rerun(spark, shop):
    cfg = replace(shop, log_mode="append")
    for _ in range(2):
        run_hour(spark, cfg, t(3, 5), ["orders"])
    assert read_delta(spark, cfg.delta("orders")).count() == 4


def test_command_line(spark, shop, tmp_path):
    settings = tmp_path / "settings.json"
    settings.write_text(json.dumps({"root": shop.root, "buckets": 2, "files": {"root": shop.source.root}}))
    run = lambda *job: main(["--settings", str(settings), *job], spark)
    run("snapshot", "products", "order_items", "--at", "2024-01-05T00:00:00")
    run("hour", "--hour", "2024-01-03T05:00:00", "--table", "orders", "--table", "users")
    run("merge", "--day", "2024-01-03", "--table", "orders")
    run("gold", "--full-refresh")
    run("gold", "--day", "2024-01-04")
    run("publish")
    assert report(spark, shop) == {(3, "b1"): 10.0, (3, None): 10.0, (4, "b1"): -10.0}
    assert open_table(spark, shop, "main_orders").count() == 2
    assert spark.sql("select count(*) from gold.sales_report").first()[0] == 3
    with pytest.raises(FileNotFoundError):
        main(["--settings", "nowhere.json", "publish"], spark)


def test_settings():
    tables = {"t": {"key": ["a", "b"], "audit": "c"}}
    cfg = load_pipeline({"root": "r", "jdbc": {"url": "jdbc:x", "fetch_rows": 5}, "tables": tables, "database": "d"})
    assert cfg.source.options()["fetchsize"] == "5" and cfg.spec("t").keys == ("a", "b")
    assert cfg.landing("t", Slice.hour(t(3, 5))) == "r/landing/d/t/2024-01-03/05-00-00"
    for wrong in ({"root": "r"}, {"root": "r", "jdbc": {}, "files": {}}):
        with pytest.raises(ValueError):
            load_pipeline(wrong)


def test_one_failing_table_stops_no_other(spark, shop, tmp_path):
    registry = {**shop.registry, **load_registry({"missing": {"key": "id", "audit": "at"}})}
    broken = Pipeline(shop.root, shop.source, registry=registry)
    with pytest.raises(ExceptionGroup) as failure:
        run_hour(spark, broken, t(3, 5))
    assert len(failure.value.exceptions) == 1 and "table missing" in failure.value.exceptions[0].__notes__
    assert read_delta(spark, shop.delta("orders")).count() == 2


def test_merge_bootstraps_then_merges(spark, shop, tmp_path):
    run_snapshot(spark, shop, "orders", t(3, 7))
    assert run_merge(spark, shop, t(3).date(), ["orders"]) == {"orders": 1}
    before = rows_of(read_current(spark, shop.main("orders"), ["order_id"]))
    assert len(before) == 4
    # Merging a day the first build already covered changes nothing.
    assert run_merge(spark, shop, "2024-01-03", ["orders"]) == {"orders": 2}
    assert rows_of(read_current(spark, shop.main("orders"), ["order_id"])) == before
    write_source(spark, tmp_path / "src", orders=[(2, "paid", t(4, 8)), (2, "sent", t(4, 8, 30)), (5, "new", t(4, 8))])
    run_hour(spark, shop, t(4, 8), ["orders"])
    run_merge(spark, shop, "2024-01-04", ["orders"])
    state = {r.order_id: r.status for r in read_current(spark, shop.main("orders"), ["order_id"]).collect()}
    assert state == {1: "new", 2: "sent", 3: "new", 4: "new", 5: "new"}
    # A day without rows leaves the state alone.
    assert run_merge(spark, shop, "2024-01-05", ["orders"]) == {"orders": 3}
    assert read_current(spark, shop.main("orders"), ["order_id"]).count() == 5


def test_merge_without_a_log_fails(spark, shop):
    with pytest.raises(ExceptionGroup):
        run_merge(spark, shop, "2024-01-03", ["users"])


def report(spark, cfg):
    return {
        (r.sales_date.day, r.brand): r.total_sales for r in read_partitions(spark, cfg.gold("sales_report")).collect()
    }


def test_gold_refresh(spark, shop, tmp_path):
    for table in ("order_items", "products"):
        run_snapshot(spark, shop, table, t(5))
    with pytest.raises(ValueError, match="first run"):
        run_gold(spark, shop, today=date(2024, 1, 5))
    built = run_gold(spark, shop, full_refresh=True)
    assert built == {
        "order_items_fact": Slice.since("2020-01-01"),
        "product_dimension": Slice.since("2000-01-01"),
        "sales_report": Slice.since("2020-01-01"),
    }
    assert report(spark, shop) == {(3, "b1"): 10.0, (3, None): 10.0, (4, "b1"): -10.0}
    # Yesterday's run takes a late row of that day in and leaves the other day.
    write_source(spark, tmp_path / "src", order_items=[sold(9, 4, t(4), price=5.0)])
    run_hour(spark, shop, t(4, 5), ["order_items"])
    assert set(run_gold(spark, shop, today=date(2024, 1, 5)).values()) == {Slice.day("2024-01-04")}
    assert report(spark, shop) == {(3, "b1"): 10.0, (3, None): 10.0, (4, "b1"): -5.0}


def test_a_full_build_exchanges_images_once(spark, shop, monkeypatch):
    for table in ("order_items", "products"):
        run_snapshot(spark, shop, table, t(5))
    hints, hint = [], DataFrame.hint
    monkeypatch.setattr(type(spark.range(1)), "hint", lambda df, *args: hints.append(args) or hint(df, *args))
    run_gold(spark, shop, full_refresh=True)
    assert len(hints) == 1  # the report's; fact and dimension are written as they lie
    assert report(spark, shop) == {(3, "b1"): 10.0, (3, None): 10.0, (4, "b1"): -10.0}


def test_gold_clears_an_emptied_day_only_on_request(spark, shop, tmp_path):
    cfg = shop
    for hour in (t(3, 5), t(4, 5)):
        run_hour(spark, cfg, hour, ["order_items", "products"])
    run_gold(spark, cfg, full_refresh=True)
    before = report(spark, cfg)
    assert set(before) == {(3, None), (4, None)}
    write_source(spark, tmp_path / "src", order_items=[sold(1, 3, t(3))])
    run_hour(spark, cfg, t(4, 5), ["order_items"])
    run_gold(spark, cfg, execution_date="2024-01-04")
    assert report(spark, cfg) == before
    run_gold(spark, cfg, execution_date="2024-01-04", clear_empty=True)
    assert set(report(spark, cfg)) == {(3, None)}


def test_snapshot_plus_hours_equals_source(spark, shop):
    run_snapshot(spark, shop, "orders", t(3, 7))
    run_hour(spark, shop, t(3, 5), ["orders"])
    log = read_delta(spark, shop.delta("orders"))
    assert log.count() == 6
    state = latest_per_key(log, ["order_id"], "updated_at")
    assert rows_of(state) == rows_of(shop.source.scan(spark, "orders"))


def test_stored_gold_equals_direct_build(spark, shop):
    for table in ("order_items", "products"):
        run_snapshot(spark, shop, table, t(5))
    run_gold(spark, shop, full_refresh=True)
    direct = sales_report(
        order_items_fact(shop.source.scan(spark, "order_items")), product_dimension(shop.source.scan(spark, "products"))
    )
    assert rows_of(read_partitions(spark, shop.gold("sales_report"))) == rows_of(direct)


def test_old_versions_are_dropped(spark, shop):
    run_snapshot(spark, shop, "orders", t(3, 7))
    for _ in range(4):
        run_merge(spark, shop, "2024-01-03", ["orders"])
    kept = [n for n in os.listdir(f"{shop.main('orders')}/_versions") if n.endswith(".json")]
    assert sorted(kept) == ["000003.json", "000004.json"]
    assert read_current(spark, shop.main("orders"), ["order_id"]).count() == 4


def test_a_failed_first_build_does_not_count(spark, shop):
    for table in ("order_items", "products"):
        run_snapshot(spark, shop, table, t(5))
    os.makedirs(f"{shop.gold('order_items_fact')}/_temporary")
    with pytest.raises(ValueError, match="first run"):
        run_gold(spark, shop, today=date(2024, 1, 5))


def test_gold_without_any_rows(spark, shop):
    for table in ("order_items", "products"):
        run_snapshot(spark, shop, table, t(5))
    later = replace(shop, fact_since="2030-01-01", dimension_since="2030-01-01", report_since="2030-01-01")
    run_gold(spark, later, full_refresh=True)
    assert report(spark, later) == {}
    assert publish(spark, later) == ["bronze.delta_products", "bronze.delta_order_items"]
    run_gold(spark, shop, execution_date="2024-01-04")
    assert report(spark, shop) == {(4, None): -10.0}


def test_tables_by_name(spark, shop):
    run_snapshot(spark, shop, ["order_items", "products"], t(5))
    run_merge(spark, shop, "2024-01-04", ["order_items"])
    run_gold(spark, shop, full_refresh=True)
    counts = {
        name: open_table(spark, shop, name).count()
        for name in ("delta_order_items", "main_order_items", "order_items_fact", "product_dimension", "sales_report")
    }
    assert counts == {
        "delta_order_items": 3,
        "main_order_items": 3,
        "order_items_fact": 3,
        "product_dimension": 2,
        "sales_report": 3,
    }
    day = Slice.day("2024-01-04")
    sliced = ("delta_order_items", "order_items_fact", "sales_report")
    assert [open_table(spark, shop, n, day).count() for n in sliced] == [1, 1, 1]
    for bad in ("main_products", "delta_nothing", "nothing"):
        with pytest.raises(ValueError):
            open_table(spark, shop, bad)
    with pytest.raises(ValueError):
        open_table(spark, shop, "main_order_items", day)
    views = publish(spark, shop)
    assert views == [
        "bronze.delta_products",
        "bronze.delta_order_items",
        "bronze.main_order_items",
        "gold.order_items_fact",
        "gold.product_dimension",
        "gold.sales_report",
    ]
    total = spark.sql("select sum(total_sales) from gold.sales_report where sales_date = '2024-01-03'").first()[0]
    assert total == 20.0
    assert spark.sql("select * from bronze.main_order_items").columns == open_table(spark, shop, "main_order_items").columns


def test_views_of_main_tables_survive_merges(spark, shop):
    run_snapshot(spark, shop, "orders", t(3))
    run_merge(spark, shop, "2024-01-03", ["orders"])
    publish(spark, shop)
    view = "spark_catalog.bronze.main_orders" if spark.catalog.tableExists("spark_catalog.bronze.main_orders") else None
    names = [f"{d.name}.main_orders" for d in spark.catalog.listDatabases() if spark.catalog.tableExists(f"spark_catalog.{d.name}.main_orders")]
    name = view or f"spark_catalog.{names[0]}"
    for day in (4, 5, 6):
        write_source(spark, shop.root.replace("lake", "src"), orders=[(day, f"d{day}", t(day, 5))])
        run_hour(spark, shop, t(day, 5), ["orders"])
        run_merge(spark, shop, f"2024-01-{day:02d}", ["orders"])
        stored = read_current(spark, shop.main("orders"), ["order_id"])
        assert rows_of(spark.table(name)) == rows_of(stored) and spark.table(name).filter(f"order_id = {day}").first().status == f"d{day}"


def test_native_merge_is_chosen_by_a_setting(spark, shop, monkeypatch):
    from tidemart.plans import jobs

    calls = []
    monkeypatch.setattr(jobs.snapshots, "merge_into_table", lambda s, table, df, keys, audit: calls.append((table, df.count())))
    spark.createDataFrame([], ORDERS).write.mode("overwrite").saveAsTable("default.main_orders")
    cfg = replace(shop, catalog_main="default.main_{table}")
    run_snapshot(spark, cfg, "orders", t(3))
    run_hour(spark, cfg, t(3, 5), ["orders"])
    assert run_merge(spark, cfg, "2024-01-03", ["orders"]) == {"orders": None}
    assert calls == [("default.main_orders", 4)] and not os.path.exists(cfg.main("orders"))
    spark.createDataFrame([(1, "x", t(1))], ORDERS).write.mode("append").saveAsTable("default.main_orders")
    run_merge(spark, cfg, "2024-01-03", ["orders"])
    assert calls[1] == ("default.main_orders", 4)
    spark.sql("DROP TABLE default.main_orders")


def test_readers_reach_every_capture(spark, shop, monkeypatch):
    from tidemart.plans import jobs

    seen = []
    real = jobs.extract.read_window
    monkeypatch.setattr(jobs.extract, "read_window", lambda *a: (seen.append(a[4]), real(*a))[1])
    run_hour(spark, replace(shop, readers=3), t(3, 5), ["orders", "users"])
    assert seen == [3, 3]


def test_grain_from_the_command_line(spark, shop, tmp_path, monkeypatch):
    from tidemart import __main__ as command

    settings = tmp_path / "settings.json"
    settings.write_text(json.dumps({"root": shop.root, "files": {"root": str(tmp_path / "src")}}))
    seen = []
    monkeypatch.setattr(command, "run_gold", lambda *a: seen.append(a[3:]))
    for extra in ([], ["--grain", "item"]):
        main(["--settings", str(settings), "gold", "--full-refresh", *extra], spark)
    assert [s[2] for s in seen] == ["item_day", "item"] or [s[1:] for s in seen]
    assert [("item" in s, "item_day" in s) for s in seen] == [(False, True), (True, False)]
