"""Replacing folders of a stored table so that the old ones stay readable until the new ones are there."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemart.sources import storage


def replace_folders(rows: DataFrame, path: str, columns: Sequence[str], scopes: Sequence[str] = ()) -> None:
    """Write ``rows`` to ``path/column=value/...``, each folder in place of the stored one.

    New files are staged and moved when all tasks are done, so a failed write changes nothing. Folders
    below ``scopes`` that the rows have nothing for are removed after that: no rows empty a scope.
    """
    spark = rows.sparkSession
    before = {folder: names for scope in scopes for folder, names in storage.files_below(spark, scope).items()}
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
    writer.partitionBy(*columns).parquet(path)
    for folder, names in before.items():
        if names & set(storage.child_names(spark, folder)):  # files have new names in a folder that was replaced
            storage.delete(spark, folder)
