"""Top one per group: the latest image of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions import day_of, named, unused


def _orderable(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.MapType, T.VariantType))


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    audit: str,
    per_day: bool = False,
    tiebreak: Sequence[str | Column] | None = None,
    spread: int | None = None,
) -> DataFrame:
    """One row per key (or per key and audit day): the one with the latest audit value.

    A NULL audit ranks last and NULL keys form one group. Equal audits are settled by
    ``tiebreak``, by default all remaining columns in schema order, so the pick does not
    depend on row order. The ``row_number = 1`` shape lets Spark keep one row per key and
    map task before the shuffle, so a hot key ships at most one row per task. All columns are
    kept, whatever their names.

    With ``spread`` (and ``per_day``) rows are exchanged by month and by so many buckets of the key instead, so that
    the result can be written by day or month as it lies. Then all images of a key and month travel.
    """
    groups = [named(k) for k in keys] + ([day_of(named(audit))] if per_day else [])
    if tiebreak is None:
        fixed = {*keys, audit}
        tiebreak = [f.name for f in df.schema.fields if f.name not in fixed and _orderable(f.dataType)]
    order = [named(audit).desc_nulls_last()]
    order += [named(t).asc_nulls_last() if isinstance(t, str) else t for t in tiebreak]
    place = unused(df.columns, "place")
    if spread:
        # Both follow from the keys and the day, so the groups are the same and need no other exchange.
        together = [F.trunc(day_of(named(audit)), "MM"), F.pmod(F.xxhash64(*[named(k) for k in keys]), F.lit(spread))]
        names = [unused(df.columns, name) for name in ("month", "bucket")]
        df = df.withColumns(dict(zip(names, together, strict=True))).repartition(*map(named, names))
        rank = F.row_number().over(Window.partitionBy(*map(named, names), *groups).orderBy(*order))
        return df.withColumn(place, rank).filter(F.col(place) == 1).drop(place, *names)
    rank = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    return df.withColumn(place, rank).filter(F.col(place) == 1).drop(place)
