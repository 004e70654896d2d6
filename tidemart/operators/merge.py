"""Keyed merge: insert new keys, replace current rows that are not newer."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions import named, unused


def upsert(main: DataFrame, changes: DataFrame, keys: Sequence[str], audit: str) -> DataFrame:
    """``main`` after merging ``changes``; columns and types are those of ``main``.

    A change replaces the current row iff ``main.audit <= changes.audit``; with NULL on either
    side the current row stays. A NULL key matches nothing, so such a change is always
    inserted. ``changes`` must hold at most one row per key (see ``latest_per_key``). Columns
    only ``changes`` has are ignored; a column it lacks is an error. Rows are never deleted.

    Both sides are unique per key, so the join cannot skew. Stored tables come in bucketed
    by key (``sources.snapshots``), and then only ``changes`` is shuffled.
    """
    missing = [c for c in main.columns if c not in changes.columns]
    if missing:
        raise ValueError(f"changes lack columns of the main table: {', '.join(missing)}")
    there = unused(main.columns, "there")
    current = main.withColumn(there, F.lit(True)).alias("m")
    incoming = changes.select(*map(named, main.columns)).withColumn(there, F.lit(True)).alias("d")
    old, new = (lambda column, side=side: F.col(f"{side}.`{column.replace('`', '``')}`") for side in ("m", "d"))
    same_key = reduce(and_, [old(k) == new(k) for k in keys])
    newer = F.coalesce(old(audit) <= new(audit), F.lit(False))
    take = new(there).isNotNull() & (old(there).isNull() | newer)
    columns = [
        F.when(take, new(f.name).cast(f.dataType)).otherwise(old(f.name)).alias(f.name)
        for f in main.schema.fields
    ]
    return current.join(incoming, same_key, "full_outer").select(*columns)


def winning_changes(main: DataFrame, changes: DataFrame, keys: Sequence[str], audit: str) -> DataFrame:
    """The rows of ``changes`` that ``upsert`` would insert or replace a row with. Of ``main`` only keys and audit are read."""
    held = main.select(*[named(k).alias(f"k{i}") for i, k in enumerate(keys)], named(audit).alias("held"), F.lit(True).alias("there"))
    new, old = changes.alias("d"), held.alias("m")
    same_key = reduce(and_, [F.col(f"d.`{k.replace('`', '``')}`") == F.col(f"m.k{i}") for i, k in enumerate(keys)])
    newer = F.coalesce(F.col("m.held") <= F.col(f"d.`{audit.replace('`', '``')}`"), F.lit(False))
    return new.join(old, same_key, "left").filter(F.col("m.there").isNull() | newer).select("d.*")
