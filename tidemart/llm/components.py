"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import dealt, lookup, written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours move to the smallest node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    met = lookup(dealt(both.filter("v > u"), "v"), least, "u")  # a node's neighbours meet its minimum in many tasks
    return met.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours move to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node that has an edge to another: the smallest node it is connected with.

    ``edges`` has two columns of one orderable type; nulls, loops and repeats are ignored. A step joins the
    edges with one minimum per node, so no node's neighbours are gathered, and those of a hot node are dealt over many tasks. Each round is written; the rounds end when one changes nothing.
    """
    spark = edges.sparkSession
    left, right = edges.columns
    edges = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).filter("u <> v")
    current = written(spark, edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        state = current.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
        if not state.n or tuple(state) == seen:
            return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                current.select(F.col("v").alias("node"), F.col("v").alias("component"))
            ).distinct()
        seen = tuple(state)
        current = written(spark, _small_star(_large_star(current)), "edges")
