"""The plans the operators must get, at any size."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tests.conftest import plan_of, rows_of
from tidemart.functions import day_of
from tidemart.operators import asof_join, latest_per_key
from tidemart.plans import marts
from tidemart.sources import append_delta, overwrite_partitions, read_delta, read_partitions

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("Python", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize(
    "name",
    [
        "hourly_window_extract",
        "latest_per_key_items",
        "merge_upsert",
        "order_items_fact_full",
        "product_dimension_day",
        "asof_left_join",
        "asof_left_join_slots",
        "sales_report_full",
        "sales_report_per_item",
        "registry_fanout",
        "slice_resolution",
    ],
)
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(queries()[name](spark, SF))
    assert not [word for word in FORBIDDEN if word in plan]


def test_latest_keeps_one_row_per_key_before_the_shuffle(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    for per_day in (False, True):
        plan = plan_of(latest_per_key(events, ["user_id"], "ts", per_day=per_day))
        assert plan.count("WindowGroupLimit") == 2
        below_exchange = plan.split("Exchange")[1]
        assert "row_number(), 1, Partial" in below_exchange


def test_day_fact_filters_in_the_scan(spark):
    plan = plan_of(queries()["order_items_fact_day"](spark, SF))
    assert "GreaterThanOrEqual(l_shipdate,1998-06-16T00:00)" in plan
    assert "l_quantity" not in plan and "o_totalprice" not in plan


def test_report_reads_only_its_columns(spark):
    plan = plan_of(queries()["product_dimension_full"](spark, SF))
    assert "p_name" not in plan and "p_retailprice" not in plan


def skewed(spark, n):
    """A third of all rows share one key."""
    ids = spark.range(0, n, 1, 16)
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000)
    second = F.pmod(F.xxhash64("id"), F.lit(5 * 86400))
    return ids.select("id", key.alias("k"), F.timestamp_seconds(second).alias("ts"))


def versions(spark):
    return spark.range(5000).select(
        (F.col("id") % 1000).alias("k"),
        F.timestamp_seconds(F.floor(F.col("id") / 1000) * 86400 + 100).alias("vts"),
        F.col("id").alias("v"),
    )


def test_hot_key_of_the_asof_join_is_split(spark, conf):
    """A third of the sales and thousands of versions are of one key; its slots lie in many partitions."""
    conf(spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions="20")
    sales = skewed(spark, 100_000)
    joined = asof_join(sales, versions(spark), ["k"], "ts", "vts", slot_seconds=50)
    checked = joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.count("v").alias("m"))
    parts = checked.collect()
    early = sales.filter(F.unix_seconds("ts") < 100).count()
    assert sum(r.n for r in parts) == 100_000 and sum(r.m for r in parts) == 100_000 - early
    assert max(r.n for r in parts) < 20_000


def test_hot_key_of_the_latest_image_ships_few_rows(spark):
    latest = latest_per_key(skewed(spark, 200_000), ["k"], "ts")
    assert latest.count() == 1000
    assert latest.filter("k = 7").count() == 1


def test_a_hot_day_is_written_by_several_tasks(spark, conf, tmp_path):
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="200KB")
    path = f"{tmp_path}/t"
    rows = skewed(spark, 300_000).withColumn(
        "ts", F.when(F.col("id") % 3 == 0, F.timestamp_seconds(F.lit(86400))).otherwise(F.col("ts"))
    )
    overwrite_partitions(rows, path, day_of("ts"))
    append_delta(rows, f"{tmp_path}/d", "init-x", "ts")
    files = lambda folder: len([f for f in os.listdir(folder) if f.endswith(".parquet")])
    assert files(f"{path}/p_gen=1/p_span=1970-01-02") > 2
    assert files(f"{tmp_path}/d/slice=init-x/p_from=1970-01-01") > 2
    assert read_partitions(spark, path).count() == read_delta(spark, f"{tmp_path}/d").count() == 300_000


@pytest.mark.parametrize("name, rankings", [("asof_left_join", 2), ("sales_report_full", 2), ("sales_report_per_item", 3)])
def test_both_sides_of_the_asof_join_are_computed_once(spark, name, rankings):
    """In the plan that ran: one ranking each for the images of items and of products, and the report's own by item."""
    report = queries()[name](spark, SF)
    report.collect()
    final = plan_of(report).split("Initial Plan")[0]
    assert final.count(" Window [row_number()") == rankings
    assert final.count("ReusedExchange") == 1


def test_a_hot_hour_of_the_asof_join_is_split(spark, conf):
    """Half of all sales and versions are of one key and one hour."""
    conf(spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions="20")
    ids = spark.range(0, 60_000, 1, 8)
    key = F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id") % 1000)
    second = F.when(F.col("id") % 2 == 0, F.pmod(F.xxhash64("id"), F.lit(3600))).otherwise(F.pmod(F.xxhash64("id"), F.lit(864_000)))
    sales = ids.select("id", key.alias("k"), F.timestamp_seconds(second).alias("ts"))
    changes = ids.select(key.alias("k"), F.timestamp_millis(second * 1000 + F.col("id") % 1000).alias("vts")).distinct().withColumn("v", F.col("vts"))
    joined = asof_join(sales, changes, ["k"], "ts", "vts")
    parts = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in parts) == 60_000 and max(r["count"] for r in parts) < 7_000
    best = sales.join(changes.drop("v"), "k").filter("vts <= ts").groupBy("id").agg(F.max("vts").alias("best"))
    wrong = joined.join(best, "id", "left").filter("not (v <=> best)")
    assert wrong.count() == 0


def test_rows_of_unknown_keys_are_spread(spark, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions="20")
    sales = spark.range(40_000).selectExpr("id", "cast(null as bigint) as k", "timestamp'1970-01-01' as ts")
    joined = asof_join(sales, versions(spark), ["k"], "ts", "vts")
    parts = joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.count("v").alias("m")).collect()
    assert sum(r.n for r in parts) == 40_000 and max(r.n for r in parts) < 6_000 and not any(r.m for r in parts)


def test_images_are_chosen_where_they_will_be_written(spark, tmp_path, monkeypatch):
    """Exchanged once, by month and bucket: the same images, and no other exchange before the write."""
    rows = spark.range(400).selectExpr(
        "if(id % 50 = 0, null, id % 30) as k",
        "if(id % 70 = 1, null, timestamp '2024-01-01 00:00:00' + (id % 90) * interval 17 hour) as ts",
        "id % 7 as v",
    )
    chosen = latest_per_key(rows, ["k"], "ts", per_day=True, spread=3)
    assert plan_of(chosen).count("Exchange hashpartitioning") == 1
    assert rows_of(chosen) == rows_of(latest_per_key(rows, ["k"], "ts", per_day=True))
    monkeypatch.setattr(type(rows), "hint", lambda *_: pytest.fail("exchanged again"))
    overwrite_partitions(chosen, f"{tmp_path}/t", day_of("ts"), whole_table=True, gathered=True)
    assert rows_of(read_partitions(spark, f"{tmp_path}/t")) == rows_of(chosen)


def test_a_sale_meets_versions_of_other_years(spark):
    """The slots of the sales are years; a version is handed on over many, and two of one slot are told apart by time."""
    sales = "id long, product_id long, created_at timestamp, updated_at timestamp, delivered_at timestamp, sale_price double, returned_at timestamp"
    days = ["2001-05-01", "2019-12-31", "2020-01-01", "2020-06-02", "2024-03-01"]
    times = [datetime.fromisoformat(d) for d in days]
    fact = spark.createDataFrame([(i, 1, t, t, t, 1.0, None) for i, t in enumerate(times)], sales)
    versions = [(1, b, "Men", "c", datetime.fromisoformat(d)) for b, d in (("a", "2005-01-01"), ("b", "2020-01-01"), ("c", "2020-06-01"), ("d", "2020-06-03"))]
    dimension = spark.createDataFrame(versions, "id long, brand string, department string, category string, updated_at timestamp")
    joined = marts.sales_with_product(fact, dimension)
    assert {r.id: r.brand for r in joined.collect()} == {0: None, 1: "a", 2: "b", 3: "c", 4: "d"}
