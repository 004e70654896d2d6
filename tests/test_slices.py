from datetime import date, datetime, timedelta, timezone

import pytest

from tests.conftest import plan_of
from tidemart.registry import SHOP_TABLES, TableSpec, layer_name, load_registry
from tidemart.slices import Slice, resolve_slice

H = datetime(2024, 1, 2, 5)
TICK = timedelta(microseconds=1)


def test_hour_is_truncated_and_half_open(spark):
    window = Slice.hour(datetime(2024, 1, 2, 5, 15, 30, 7))
    assert (window.start, window.end) == (H, H + timedelta(hours=1))
    edges = [H - TICK, H, H + timedelta(hours=1) - TICK, H + timedelta(hours=1), None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(edges)], "id long, ts timestamp")
    assert [r.id for r in df.filter(window.predicate("ts")).orderBy("id").collect()] == [1, 2]
    ntz = df.selectExpr("id", "cast(ts as timestamp_ntz) ts")
    assert [r.id for r in ntz.filter(window.predicate("ts")).orderBy("id").collect()] == [1, 2]


def test_day_and_since(spark):
    times = [datetime(2024, 1, 1, 23, 59, 59, 999999), datetime(2024, 1, 2), datetime(2024, 1, 2, 23, 59), datetime(2024, 1, 3)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "id long, ts timestamp")
    ids = lambda w: [r.id for r in df.filter(w.predicate("ts")).orderBy("id").collect()]
    assert ids(Slice.day("2024-01-02")) == [1, 2]
    assert ids(Slice.since(date(2024, 1, 2))) == [1, 2, 3]


def test_zones_and_date_columns(spark):
    east = timezone(timedelta(hours=7))
    assert Slice.hour(datetime(2024, 1, 2, 3, 30, tzinfo=east)) == Slice.hour(datetime(2024, 1, 1, 20))
    assert Slice.day(datetime(2024, 1, 2, 3, tzinfo=east)) == Slice.day("2024-01-01")
    days = spark.createDataFrame([(date(2024, 1, n),) for n in (1, 2, 3)], "d date")
    assert [r.d.day for r in days.filter(Slice.day("2024-01-02").predicate("d")).collect()] == [2]
    assert days.filter(Slice.since("2024-01-02").predicate("d")).count() == 2


def test_bounds_reach_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = plan_of(events.filter(Slice.day("2024-01-02").predicate("ts")))
    assert "GreaterThanOrEqual(ts,2024-01-02T00:00)" in plan and "LessThan(ts,2024-01-03T00:00)" in plan


def test_paths():
    window = Slice.hour(datetime(2024, 1, 2, 5, 45))
    assert window.path("shop", "orders") == "shop/orders/2024-01-02/05-00-00"
    assert window.path("shop", "orders", init=True) == "shop/orders/init_load/2024-01-02/05-00-00"
    assert window.label() == "hour-2024-01-02-05"


@pytest.mark.parametrize("exists", [True, False])
@pytest.mark.parametrize("given", [None, "", "2024-01-09", date(2024, 1, 9)])
@pytest.mark.parametrize("full", [True, False])
def test_resolution_grid(full, given, exists):
    resolve = lambda: resolve_slice(
        full_refresh=full, execution_date=given, target_exists=exists, today=date(2024, 3, 1), since="2020-01-01"
    )
    if full:
        assert resolve() == Slice.since("2020-01-01")
    elif given:
        assert resolve() == Slice.day("2024-01-09")
    elif exists:
        assert resolve() == Slice.day("2024-02-29")
    else:
        with pytest.raises(ValueError):
            resolve()


def test_registry():
    assert list(SHOP_TABLES) == ["users", "products", "orders", "order_items", "events"]
    assert SHOP_TABLES["orders"] == TableSpec("orders", ("order_id",), "updated_at")
    assert SHOP_TABLES["users"].audit == "created_at"
    assert load_registry({"t": {"key": ["a", "b"], "audit": "c"}})["t"].keys == ("a", "b")
    with pytest.raises(ValueError):
        TableSpec("t", (), "c")


def test_layers():
    assert {layer_name("gold", t) for t in ("dev", "prod", "stag")} == {"gold"}
    with pytest.raises(ValueError):
        layer_name("gold", "elsewhere")
    with pytest.raises(ValueError):
        layer_name("platinum")
