"""Late slices: exactly the gold days they change are built again."""

import random
from datetime import date

import pytest

from tests.conftest import rows_of
from tests.test_jobs import shop, sold, t, write_source  # noqa: F401
from tests.test_sources import files_of
from tidemart.plans import late, publish, run_gold, run_hour, run_late, sales_report
from tidemart.plans.marts import order_items_fact, product_dimension
from tidemart.sources import read_delta, read_partitions

MODELS = ("order_items_fact", "product_dimension", "sales_report")


def days_of(path, before, after) -> set[str]:
    """Days whose folders were written between two listings."""
    new = set(after) - set(before)
    return {part.removeprefix("p_span=") for f in new for part in f.split("/") if part.startswith("p_span=")}


def gold_files(cfg):
    return {m: files_of(cfg.gold(m)) for m in MODELS}


def test_an_old_hour_rebuilds_exactly_its_days(spark, shop, tmp_path):  # noqa: F811
    """One hour of day 3 is captured again; day 4 and the products stay as they are."""
    for hour in (t(1), t(3, 5), t(4, 5)):
        run_hour(spark, shop, hour, ["order_items", "products"])
    run_gold(spark, shop, full_refresh=True, today=date(2024, 1, 5))
    assert run_late(spark, shop, date(2024, 1, 6)) == dict.fromkeys(MODELS, [])
    before = gold_files(shop)
    write_source(spark, tmp_path / "src", order_items=[sold(1, 3, t(3), price=7.0), sold(8, 3, t(3), price=2.5), sold(3, 4, t(3), t(4))])
    run_hour(spark, shop, t(3, 5), ["order_items"])
    done = run_late(spark, shop, date(2024, 1, 6))
    third = [date(2024, 1, 3)]
    assert done == {"order_items_fact": third, "product_dimension": [], "sales_report": third}
    after = gold_files(shop)
    assert days_of(shop, before["order_items_fact"], after["order_items_fact"]) == {"2024-01-03"}
    assert days_of(shop, before["sales_report"], after["sales_report"]) == {"2024-01-03"}
    assert before["product_dimension"] == after["product_dimension"]
    direct = sales_report(
        order_items_fact(read_delta(spark, shop.delta("order_items"))), product_dimension(read_delta(spark, shop.delta("products")))
    )
    assert rows_of(read_partitions(spark, shop.gold("sales_report"))) == rows_of(direct)
    assert run_late(spark, shop, date(2024, 1, 6)) == dict.fromkeys(MODELS, [])


def test_a_late_product_reaches_the_sales_after_it(spark, shop, tmp_path):  # noqa: F811
    for hour in (t(1), t(3, 5), t(4, 5)):
        run_hour(spark, shop, hour, ["order_items", "products"])
    run_gold(spark, shop, full_refresh=True, today=date(2024, 1, 5))
    # Product 1 had another brand on day 1, when the orders were placed: sales of days 3 and 4 have it.
    write_source(spark, tmp_path / "src", products=[(1, "late", "Men", "c", t(1), 1.0), (2, "b2", "Women", "c", t(3, 5), 1.0)])
    run_hour(spark, shop, t(1), ["products"])
    done = run_late(spark, shop, date(2024, 1, 6))
    assert done["order_items_fact"] == [] and done["product_dimension"] == [date(2024, 1, 1)]
    assert done["sales_report"] == [date(2024, 1, 3), date(2024, 1, 4)]
    brands = {r.brand for r in read_partitions(spark, shop.gold("sales_report")).collect()}
    assert brands == {"late", None}


def test_days_of_the_daily_run_are_not_late(spark, shop):  # noqa: F811
    run_hour(spark, shop, t(3, 5), ["order_items", "products"])
    run_gold(spark, shop, full_refresh=True, today=date(2024, 1, 4))
    run_hour(spark, shop, t(4, 5), ["order_items"])
    assert run_late(spark, shop, date(2024, 1, 4))["order_items_fact"] == []  # day 4 is not over
    run_gold(spark, shop, today=date(2024, 1, 5))
    assert run_late(spark, shop, date(2024, 1, 5)) == dict.fromkeys(MODELS, [])


def test_a_run_that_breaks_off_is_made_good(spark, shop, tmp_path, monkeypatch):  # noqa: F811
    for hour in (t(1), t(3, 5), t(4, 5)):
        run_hour(spark, shop, hour, ["order_items", "products"])
    run_gold(spark, shop, full_refresh=True, today=date(2024, 1, 5))
    publish(spark, shop)
    write_source(spark, tmp_path / "src", order_items=[sold(1, 3, t(3), price=7.0)])
    run_hour(spark, shop, t(3, 5), ["order_items"])
    with monkeypatch.context() as patch:
        patch.setattr(late.marts, "sales_report", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_late(spark, shop, date(2024, 1, 6))
    assert run_late(spark, shop, date(2024, 1, 6))["sales_report"] == [date(2024, 1, 3)]
    direct = sales_report(
        order_items_fact(read_delta(spark, shop.delta("order_items"))), product_dimension(read_delta(spark, shop.delta("products")))
    )
    assert rows_of(read_partitions(spark, shop.gold("sales_report"))) == rows_of(direct)
    assert rows_of(spark.table("gold.sales_report")) == rows_of(direct)
    for database in ("bronze", "silver", "gold"):
        spark.sql(f"DROP DATABASE IF EXISTS spark_catalog.{database} CASCADE")


@pytest.mark.parametrize("seed", [1, 2])
def test_late_runs_equal_a_full_refresh(spark, shop, tmp_path, seed):  # noqa: F811
    """Hours captured again in any order, with rows that change, move to other hours or vanish."""
    rnd = random.Random(seed)

    def source() -> None:
        items = [sold(i, rnd.randint(2, 6), t(rnd.randint(2, 6)), rnd.choice([None, t(6)]), rnd.randint(1, 3), float(rnd.randint(1, 9))) for i in range(12)]
        products = [(i, rnd.choice("xyz"), "Men", "c", t(rnd.randint(1, 4), rnd.randint(0, 1)), 1.0) for i in range(1, 4)]
        write_source(spark, tmp_path / "src", order_items=items, products=products)

    hours = {"order_items": [t(d, 5) for d in range(2, 7)], "products": [t(d, h) for d in range(1, 5) for h in (0, 1)]}
    source()
    for table, all_hours in hours.items():
        for hour in all_hours:
            run_hour(spark, shop, hour, [table])
    run_gold(spark, shop, full_refresh=True, today=date(2024, 1, 8))
    for _ in range(2):
        source()
        for table, all_hours in hours.items():
            for hour in rnd.sample(all_hours, 2):
                run_hour(spark, shop, hour, [table])
        run_late(spark, shop, date(2024, 1, 8))
        fact = order_items_fact(read_delta(spark, shop.delta("order_items")))
        dimension = product_dimension(read_delta(spark, shop.delta("products")))
        assert rows_of(read_partitions(spark, shop.gold("order_items_fact"))) == rows_of(fact)
        assert rows_of(read_partitions(spark, shop.gold("product_dimension"))) == rows_of(dimension)
        assert rows_of(read_partitions(spark, shop.gold("sales_report"))) == rows_of(sales_report(fact, dimension))
