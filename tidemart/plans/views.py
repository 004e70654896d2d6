"""SQL views over stored folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession


def create_view(spark: SparkSession, name: str, columns: Sequence[str], folder: str) -> None:
    chosen = ", ".join("`" + c.replace("`", "``") + "`" for c in columns)
    replace_view(spark, name, f"SELECT {chosen} FROM parquet.`{folder}`")


def replace_view(spark: SparkSession, name: str, query: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW spark_catalog.{name} AS {query}")


def view_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(f"spark_catalog.{name}")
