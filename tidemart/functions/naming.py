"""Column names that no table of a user can clash with."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def named(column: str) -> Column:
    """A column by its whole name, dots and all."""
    return F.col("`" + column.replace("`", "``") + "`")


def unused(columns: Iterable[str], name: str) -> str:
    """``name``, with underscores added until none of the columns has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def refuse(df: DataFrame, *reserved: str) -> None:
    """Folder columns are part of a stored table; rows must not bring columns of those names."""
    found = sorted({c for c in df.columns if c.lower() in reserved})
    if found:
        raise ValueError(f"column names reserved for folders: {', '.join(found)}")
