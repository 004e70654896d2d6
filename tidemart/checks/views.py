"""The test tables in the shape of the captured shop tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.plans import order_items_fact, product_dimension
from tidemart.registry import TableSpec
from tidemart.sources import FileSource

ORDERS = TableSpec("orders", ("o_orderkey",), "o_orderdate")
LINEITEM = TableSpec("lineitem", ("l_orderkey", "l_linenumber"), "l_shipdate")
EVENTS = TableSpec("events", ("event_id",), "ts")
FEED = TableSpec("events", ("user_id",), "ts")
ORDER_ITEMS = TableSpec("order_items", ("id",), "updated_at")
PRODUCTS = TableSpec("products", ("id",), "updated_at")


def source(sf_dir: str) -> FileSource:
    return FileSource(sf_dir, suffix=".parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return source(sf_dir).scan(spark, name)


def order_items_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as a change log of order items; (order, line) repeats, so keys have versions."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    ship = "l_shipdate - interval {} day".format
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("inventory_item_id"),
        F.col("l_linestatus").alias("status"),
        F.col("o_orderdate").alias("created_at"),
        F.col("l_shipdate").alias("updated_at"),
        F.expr(ship(5)).alias("shipped_at"),
        F.when(F.col("l_returnflag") == "R", F.expr(ship(3)))
        .when(F.col("l_returnflag") == "A", F.col("l_shipdate"))
        .when(F.col("l_linestatus") == "F", F.expr(ship(1)))
        .alias("delivered_at"),
        F.when(F.col("l_returnflag") == "R", F.col("l_shipdate")).alias("returned_at"),
        F.col("l_extendedprice").alias("sale_price"),
    )


def products_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five versions of every part; the last falls on the day of the first, six hours later."""
    versions = table(spark, sf_dir, "part").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(4))))
    return versions.select(
        F.col("p_partkey").alias("id"),
        F.expr("concat('Brand#', (p_partkey + k) % 25)").alias("brand"),
        F.when(F.col("p_size") % 2 == 0, "Men").otherwise("Women").alias("department"),
        F.col("p_type").alias("category"),
        F.expr(
            "timestamp_ntz '1995-01-01 00:00:00' + ((p_partkey * 37 + (k % 4) * 421) % 2400) * interval 1 day"
            " + (case when k = 4 then 6 else 0 end) * interval 1 hour"
        ).alias("updated_at"),
    )


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_items_fact(order_items_log(spark, sf_dir))


def dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_dimension(products_log(spark, sf_dir))
