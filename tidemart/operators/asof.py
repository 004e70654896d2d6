"""Backward as-of join by merging both sides in time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions import named

SLOT_SECONDS = 60
#: Rows that cannot match, by unknown key or time, are dealt over so many groups.
UNKNOWN_GROUPS = 4_096


def _micros(ts: str) -> Column:
    return F.unix_micros(named(ts).cast("timestamp"))


def _known(on: Sequence[str], ts: str) -> Column:
    return reduce(and_, [named(c).isNotNull() for c in (*on, ts)])


def _hashable(kind: T.DataType) -> bool:
    return "map<" not in kind.simpleString() and "variant" not in kind.simpleString()


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_ts: str,
    right_ts: str,
    how: str = "left",
    slot_seconds: int = SLOT_SECONDS,
) -> DataFrame:
    """Each left row with the latest right row of its key where ``right_ts <= left_ts``.

    ``right`` must be unique per key and ``right_ts``. The result has the left columns and then
    the right columns outside ``on``; with ``how="left"`` unmatched left rows carry NULLs.

    Both sides are tagged, put together and exchanged once, by key and slot of time; inside a slot
    a left row takes the last version before it. What a slot inherits is a prefix scan over one row per key and
    slot, taken from that same exchange, so either side is computed once. A hot key is spread over its slots, a hot
    hour of it over the hour's slots; the groups of the scan grow with the calendar and not with the rows. Rows
    whose key or time is unknown ride along in groups of their own. Nothing is compared in pairs, measured
    beforehand or broadcast by order; one plan serves tables of any size.
    Choose ``slot_seconds`` so that a slot of the densest key fits a task.
    """
    payload = [c for c in right.columns if c not in on]
    clash = sorted(set(payload) & set(left.columns))
    if clash:
        raise ValueError(f"columns on both sides of the as-of join: {', '.join(clash)}")
    if how not in ("left", "inner"):
        raise ValueError(f"as-of join cannot be {how!r}")

    # Rows travel as structs, so names of theirs cannot clash with these.
    keys = [f"key_{i}" for i in range(len(on))]
    left_row, version = F.struct(*map(named, left.columns)), F.struct(*map(named, payload))
    no_row = F.lit(None).cast(left.select(left_row).schema[0].dataType)
    no_version = F.lit(None).cast(right.select(version).schema[0].dataType)

    def events(df: DataFrame, ts: str, row: Column, version: Column) -> DataFrame:
        known = _known(on, ts)
        columns = [F.when(known, named(c)).alias(k) for c, k in zip(on, keys, strict=True)]
        spread = [named(f.name) for f in df.schema.fields if _hashable(f.dataType)]
        return df.select(
            *columns, F.when(known, _micros(ts)).alias("at"), F.xxhash64(*spread).alias("spread"), row.alias("row"), version.alias("version")
        )

    rows = events(left, left_ts, left_row, no_version)
    versions = events(right.filter(_known(on, right_ts)), right_ts, no_row, version)
    slot = F.floor(F.col("at") / F.lit(slot_seconds * 1_000_000))
    # Key and slot are never NULL, and the rows below use every column: so both uses get the same exchange.
    placed = rows.unionByName(versions).select(
        F.struct(*keys).alias("key"),
        F.coalesce(slot, F.pmod("spread", F.lit(UNKNOWN_GROUPS)), F.lit(0)).alias("slot"),
        "at",
        "row",
        "version",
    )
    placed = placed.repartition("key", "slot")

    # The last version of each slot, handed on to the next slots that have left rows.
    version_at = F.when(F.col("version").isNotNull(), F.col("at"))
    slots = placed.groupBy("key", "slot").agg(F.max_by("version", version_at).alias("closing"), F.count("row").alias("asks"))
    earlier = Window.partitionBy("key").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    handed = (
        slots.withColumn("handed", F.last("closing", ignorenulls=True).over(earlier))
        .filter((F.col("asks") > 0) & F.col("handed").isNotNull())
        .select("key", "slot", "handed")
    )
    # A version counts for rows of its own time, so it comes before them.
    in_time = Window.partitionBy("key", "slot").orderBy("at", F.col("row").isNotNull())
    merged = (
        placed.withColumn("version", F.last("version", ignorenulls=True).over(in_time.rowsBetween(Window.unboundedPreceding, 0)))
        .filter(F.col("row").isNotNull())
        .join(handed, ["key", "slot"], "left")
        .select("row", F.coalesce("version", "handed").alias("version"))
    )
    if how == "inner":
        merged = merged.filter(F.col("version").isNotNull())
    return merged.select(
        *[F.col("row").getField(c).alias(c) for c in left.columns],
        *[F.col("version").getField(c).alias(c) for c in payload],
    )
