"""The append log of full row images ("delta"): Parquet, one folder per slice, split by audit time.

Beside the slices lie a zone map, the days and the first and last audit time of every file of a slice that spans many days,
and a journal: which slices each write replaced, and the days of their rows before and after.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StringType, StructField, StructType

from tidemart.functions import day_of, named, refuse, unused
from tidemart.slices import Slice
from tidemart.sources import storage, versions
from tidemart.sources.replace import replace_folders

# Folder columns: the slice, and the first day its folder covers. A folder covers one day in a
# slice of one day and one month in any other, so a snapshot over years stays at a few folders.
SLICE, FROM = "slice", "p_from"
# Partitions of Spark's advisory size from which a slice counts as large.
LARGE_PARTITIONS = 16
# Names of slices that say which rows they hold.
TIMED = (f"{SLICE}=hour-", f"{SLICE}=day-")
# Folder of the zone map, below the log; readers of the log's folder leave it out.
ZONES = "_zones"


def log_schema(schema: StructType) -> StructType:
    """Row schema plus the two folder columns."""
    return StructType([*schema.fields, StructField(SLICE, StringType()), StructField(FROM, DateType())])


def recorded_schema(spark: SparkSession, path: str) -> StructType:
    return storage.read_schema(spark, f"{path}/_schema.json")


def append_delta(
    df: DataFrame, path: str, label: Slice | str, audit: str, mode: str = "replace_slice", one_day: bool = False
) -> None:
    """Add one slice to the log.

    ``replace_slice`` swaps the slice's folders, so a re-run changes nothing and a failed one
    leaves the old rows; ``append`` keeps what is there and a re-run duplicates rows. All slices
    must share one schema, without columns named like the folders. A label given as a ``Slice``
    promises that all rows lie in it: reads of other times skip its folder.

    A slice of one day is written as it comes. Any other is gathered by month first, a large one by day, or every
    task would write a file per month; AQE puts small ones together and splits large ones. Files are sorted
    by audit time, and the zone map knows their days, so a scan for one day opens only files that have it.
    """
    if mode not in ("replace_slice", "append"):
        raise ValueError(f"unknown mode {mode!r}")
    refuse(df, SLICE, FROM)
    name = label.label() if isinstance(label, Slice) else label
    store_slices(df.withColumn(SLICE, F.lit(name)), path, [name], audit, mode, one_day)


def store_slices(
    df: DataFrame, path: str, names: Sequence[str], audit: str, mode: str = "replace_slice", one_day: bool = False
) -> None:
    """``append_delta`` for several slices in one write; the column ``slice`` says which a row is of."""
    spark, schema = df.sparkSession, df.drop(SLICE).schema
    if storage.exists(spark, f"{path}/_schema.json"):
        if not storage.same_shape(recorded_schema(spark, path), schema):
            raise ValueError(f"schema of the slice differs from the log at {path}")
    else:
        storage.write_schema(spark, f"{path}/_schema.json", schema)
    if one_day:
        rows = df.withColumn(FROM, day_of(named(audit)))
    else:
        day = unused(df.columns, "day")
        rows = df.withColumns({day: day_of(named(audit)), FROM: F.trunc(day_of(named(audit)), "MM")})
        # By day, so that a file of a large month holds few of its days; a small slice has few files a month anyway.
        by = [SLICE, FROM, day] if _is_large(df) else [SLICE, FROM]
        rows = rows.hint("rebalance", *by).sortWithinPartitions(SLICE, FROM, named(audit)).drop(day)
    there = {n for n in storage.child_names(spark, path) if n.startswith(f"{SLICE}=")}
    mine = [f"{SLICE}={name}" for name in names]
    before = _days_of(spark, path, [n for n in mine if n in there])
    if mode == "append":
        rows.write.mode("append").option("compression", "zstd").partitionBy(SLICE, FROM).parquet(path)
    else:
        replace_folders(rows, path, [SLICE, FROM], [f"{path}/{n}" for n in mine if n in there])
    if not one_day:
        _write_zones(spark, path, schema, mine, audit)
    days = sorted(before | _days_of(spark, path, mine))
    versions.append(spark, path, {"slices": list(names), "days": days})


def _is_large(df: DataFrame) -> bool:
    """Whether Spark expects the rows to fill many of the partitions that it aims at. Only the layout depends on it."""
    expected = expected_bytes(df)
    aim = df.sparkSession._jsparkSession.sessionState().conf().getConfString("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB")
    return expected > LARGE_PARTITIONS * _bytes(df.sparkSession, aim)


def expected_bytes(df: DataFrame) -> int:
    """How large Spark expects the rows to be."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _bytes(spark: SparkSession, size: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def _write_zones(spark: SparkSession, path: str, schema: StructType, slices: Sequence[str], audit: str) -> None:
    """A row per file of these slices: its days, and its first and last audit time."""
    there = set(storage.child_names(spark, path))
    stored = [f"{path}/{n}" for n in slices if n in there]
    if not stored:
        for name in slices:
            storage.delete(spark, f"{path}/{ZONES}/{name}")
        return
    files, at = spark.read.schema(log_schema(schema)).option("basePath", path).parquet(*stored), named(audit)
    zones = files.groupBy(SLICE, FROM, F.col("_metadata.file_name").alias("file")).agg(
        F.min(at).alias("first"), F.max(at).alias("last"), F.collect_set(day_of(at)).alias("days")
    )
    replace_folders(zones.coalesce(1), f"{path}/{ZONES}", [SLICE], [f"{path}/{ZONES}/{n}" for n in slices])


def _days_of(spark: SparkSession, path: str, slices: Sequence[str]) -> set[str]:
    """The days of the rows of slices, from the zone map, or from the folders of slices that hold days."""
    mapped = set(storage.child_names(spark, f"{path}/{ZONES}"))
    zoned = [f"{path}/{ZONES}/{n}" for n in slices if n in mapped]
    days = set()
    if zoned:
        zones = spark.read.option("basePath", f"{path}/{ZONES}").parquet(*zoned)
        found = zones.select(F.explode(F.col("days").cast("array<string>")).alias("day")).distinct().collect()  # at most the calendar
        days |= {r.day for r in found}
    for name in (n for n in slices if n not in mapped):
        folders = [f.removeprefix(f"{FROM}=") for f in storage.child_names(spark, f"{path}/{name}")]
        days |= {f for f in folders if re.fullmatch(r"\d{4}-\d\d-\d\d", f)}
    return days


def changed_days(spark: SparkSession, path: str, after: int) -> dict[str, int]:
    """Days of which a write later than ``after`` replaced or added rows, each with the last such write."""
    changed: dict[str, int] = {}
    for number in versions.numbers(spark, path):
        if number > after:
            changed |= dict.fromkeys(versions.load(spark, path, number)["days"], number)
    return changed


def last_write(spark: SparkSession, path: str) -> int:
    """The number of the log's last write, 0 for an empty log."""
    return max(versions.numbers(spark, path), default=0)


def _slice_folders(spark: SparkSession, path: str, window: Slice) -> list[str]:
    """Slice folders that can hold rows of an hour or day, so that a read lists no others.

    Slices named after another hour or day cannot; all other names (snapshots, batches) can.
    """
    day = f"{window.date:%Y-%m-%d}"
    hours = f"{SLICE}=hour-{window.start:%Y-%m-%d-%H}" if window.kind == "hour" else f"{SLICE}=hour-{day}"
    names = [n for n in storage.child_names(spark, path) if n.startswith(f"{SLICE}=")]
    return [n for n in names if not n.startswith(TIMED) or n.startswith((hours, f"{SLICE}=day-{day}"))]


def _in_folders(window: Slice) -> Column:
    """Rows whose folder can hold rows of the slice."""
    month: date = window.date.replace(day=1)
    if window.kind == "since":
        return F.col(FROM) >= F.lit(month)
    return F.col(FROM).isin(window.date, month)


def _files_of(spark: SparkSession, path: str, slices: Sequence[str], window: Slice, kind: DataType) -> list[str]:
    """Files, or folders, of slices over many days that can hold rows of an hour or day.

    The zone map counts for a folder only if it knows exactly the files that are there; a folder that was
    replaced since, or that has none, is read whole.
    """
    spans = [window.date.isoformat(), f"{window.date:%Y-%m}-01"]
    mapped = set(storage.child_names(spark, f"{path}/{ZONES}"))
    zoned = [f"{path}/{ZONES}/{n}" for n in slices if n in mapped]
    zones: dict[str, dict[str, bool]] = {}
    if zoned:
        first, after = (F.lit(b) for b in window.bounds(kind))
        table = spark.read.option("basePath", f"{path}/{ZONES}").parquet(*zoned)
        table = table.filter(F.col(FROM).isin([date.fromisoformat(s) for s in spans]))
        fits = (F.col("last") >= first) & (F.col("first") < after) & F.array_contains("days", F.lit(window.date))
        for r in table.select(F.col(SLICE).cast("string").alias("s"), FROM, "file", F.coalesce(fits, F.lit(False)).alias("fits")).collect():
            zones.setdefault(f"{SLICE}={r.s}/{FROM}={r[FROM]}", {})[r.file] = r.fits
    found = []
    for name in slices:
        for folder in (f"{name}/{FROM}={s}" for s in sorted(set(spans))):
            there = {f for f in storage.child_names(spark, f"{path}/{folder}") if not f.startswith(("_", "."))}
            known = zones.get(folder, {})
            if there and there == set(known):
                found += [f"{path}/{folder}/{f}" for f in sorted(there) if known[f]]
            elif there:
                found.append(f"{path}/{folder}")
    return found


def read_delta(spark: SparkSession, path: str, window: Slice | None = None, audit: str | None = None) -> DataFrame:
    """Rows of the log, of one time slice where given; the time slice also prunes folders and files."""
    schema = recorded_schema(spark, path)
    reader = spark.read.schema(log_schema(schema)).option("basePath", path)
    if window is None:
        log = reader.parquet(path)
    else:
        places = [path]
        if window.kind != "since":
            names = _slice_folders(spark, path, window)
            timed = [n for n in names if n.startswith(TIMED)]
            kind = next(f.dataType for f in schema if f.name.lower() == audit.lower())
            places = [f"{path}/{n}" for n in timed]
            places += _files_of(spark, path, [n for n in names if n not in set(timed)], window, kind)
        if not places:
            return spark.createDataFrame([], schema)
        log = reader.parquet(*places)
        log = log.filter(_in_folders(window) & window.of(log, audit))
    return log.select(*[F.col(f"`{c}`") for c in schema.names])
