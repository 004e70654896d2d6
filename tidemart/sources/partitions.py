"""Day-partitioned tables whose rebuilt days replace the stored ones, all at once.

A folder holds one day, or one closed month: ``p_span=2024-01-16`` or ``p_span=2023-12``. Every day lies in
one folder only. Days that are still rebuilt have folders of their own; a full build gathers older ones by
month, so a table over years has few files. The day of a row is kept in the files as ``p_date``.

Each write puts its folders below a new ``p_gen=...`` and then a manifest (``sources.versions``) that says of which
generation every folder counts. The manifest is put in place by one rename, so a reader has all days of before or all
days of after, and folders that are replaced stay until the version after the next.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from tidemart.functions import refuse
from tidemart.slices import Slice
from tidemart.sources import storage, versions

GENERATION, SPAN, DAY = "p_gen", "p_span", "p_date"
# Names of the folders.
DAY_FORMAT, MONTH_FORMAT = "yyyy-MM-dd", "yyyy-MM"
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
#: Versions that stay for running readers.
KEPT = 2


def _stored(schema: StructType) -> StructType:
    folders = [StructField(GENERATION, IntegerType()), StructField(SPAN, StringType())]
    return StructType([*schema.fields, StructField(DAY, DateType()), *folders])


def _schema(manifest: dict) -> StructType:
    return StructType.fromJson(manifest["schema"])


def _folder(path: str, generation: int, span: str) -> str:
    return f"{path}/{GENERATION}={generation}/{SPAN}={span}"


def _next_number(spark: SparkSession, path: str) -> int:
    names = [n.removeprefix(f"{GENERATION}=") for n in storage.child_names(spark, path) if n.startswith(f"{GENERATION}=")]
    return max([*versions.numbers(spark, path), *map(int, names)], default=0) + 1


def _read_spans(spark: SparkSession, path: str, manifest: dict, spans: Iterable[str]) -> DataFrame:
    """The stored rows of some folders, with their folder columns."""
    schema, folders = _stored(_schema(manifest)), [_folder(path, manifest["spans"][s], s) for s in spans]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def overwrite_partitions(
    df: DataFrame,
    path: str,
    date_expr: Column,
    clear_empty: date | Iterable[date] | None = None,
    whole_table: bool = False,
    gather_before: date | None = None,
    notes: Mapping | None = None,
    gathered: bool = False,
) -> int:
    """Replace the days present in ``df`` and leave all others alone; returns the new version.

    A day for which ``df`` has no rows keeps its old rows; with ``clear_empty`` (the day or days
    ``df`` was built for) those days are replaced even when empty. ``whole_table`` replaces the
    table, and gathers days before the month of ``gather_before`` by month. A day rebuilt inside a
    gathered month rewrites that month. A failed write leaves the table as it was. ``notes`` are kept
    with the version (``table_notes``).

    Rows are gathered by folder before the write, or every task would write a file per folder. AQE
    then sizes the write: it cuts large folders over several tasks and packs small ones together. Rows that
    lie together by month already (``gathered``) are written as they lie; that holds for a whole table only.
    """
    refuse(df, GENERATION, SPAN, DAY)
    spark = df.sparkSession
    found = versions.newest(spark, path)
    stored = found[1] if found and not whole_table else {"spans": {}, "schema": df.schema.jsonValue(), "notes": {}}
    if not storage.same_shape(_schema(stored), df.schema):
        raise ValueError(f"schema of the rows differs from the table at {path}")
    cleared = [clear_empty] if isinstance(clear_empty, date) else sorted(clear_empty or ())
    day, by_day, by_month = F.col(DAY), F.date_format(DAY, DAY_FORMAT), F.date_format(DAY, MONTH_FORMAT)
    dated = df.withColumn(DAY, date_expr)
    if clear_empty is not None:
        dated = dated.filter(day.isin(cleared))
    gone: set[str] = set()
    if whole_table:
        closed = day < F.lit(gather_before.replace(day=1)) if gather_before else F.lit(False)
        rows = dated.withColumn(SPAN, F.when(closed, by_month).otherwise(by_day))
    else:
        rows = dated.withColumn(SPAN, by_day)
        gone = {d.isoformat() for d in cleared}
        hit = _hit_months(dated, [s for s in stored["spans"] if len(s) == len("2024-01")], cleared if clear_empty is not None else None)
        if hit:
            rows = rows.withColumn(SPAN, F.when(by_month.isin(hit), by_month).otherwise(by_day))
            old = _read_spans(spark, path, stored, hit).drop(GENERATION)
            if clear_empty is not None:
                old = old.filter(~day.isin(cleared))
                gone |= set(hit)
            else:
                old = old.join(dated.select(DAY).distinct(), DAY, "left_anti")
            rows = rows.unionByName(old)
    number = _next_number(spark, path)
    written = f"{path}/{GENERATION}={number}"
    rows = rows if gathered and whole_table else rows.hint("rebalance", SPAN)
    rows.sortWithinPartitions(SPAN, DAY).write.option("compression", "zstd").partitionBy(SPAN).parquet(written)
    new = [unquote(n.removeprefix(f"{SPAN}=")) for n in storage.child_names(spark, written) if n.startswith(f"{SPAN}=")]
    spans = {s: g for s, g in stored["spans"].items() if s not in gone} | dict.fromkeys(new, number)
    manifest = {"spans": spans, "schema": stored["schema"], "notes": {**stored["notes"], **(notes or {})}}
    versions.commit(spark, path, number, manifest)
    _expire(spark, path)
    return number


def _expire(spark: SparkSession, path: str) -> None:
    """Drop older versions and the folders that no kept one has, those of failed writes included."""
    found = versions.numbers(spark, path)
    old, kept = found[:-KEPT], found[-KEPT:]
    alive = {(g, s) for n in kept for s, g in versions.load(spark, path, n)["spans"].items()}
    dropped = {(g, s) for n in old for s, g in versions.load(spark, path, n)["spans"].items()} - alive
    generations = {g for g, _ in alive}
    for number in old:
        versions.drop(spark, path, number)
    for generation, span in dropped:
        if generation in generations:
            storage.delete(spark, _folder(path, generation, span))
    for name in storage.child_names(spark, path):
        if name.startswith(f"{GENERATION}="):
            generation = int(name.removeprefix(f"{GENERATION}="))
            if generation not in generations and generation < kept[-1]:
                storage.delete(spark, f"{path}/{name}")


def _hit_months(dated: DataFrame, months: list[str], only: list[date] | None) -> list[str]:
    """Gathered months that the rows have days of."""
    if not months:
        return []
    if only is not None:
        return sorted({f"{d:%Y-%m}" for d in only} & set(months))
    month = F.date_format(DAY, MONTH_FORMAT)
    return sorted(r.m for r in dated.select(month.alias("m")).filter(F.col("m").isin(months)).distinct().collect())


def _of_window(spans: Iterable[str], window: Slice | None) -> list[str]:
    """Folders that can hold days of the slice. Names of days and months sort by time, a month before its days."""
    if window is None:
        return sorted(spans)
    month = f"{window.date:%Y-%m}"
    if window.kind == "since":
        return sorted(s for s in spans if month <= s != NO_DAY)
    return [s for s in (month, window.date.isoformat()) if s in spans]


def read_partitions(
    spark: SparkSession, path: str, window: Slice | None = None, audit: str | None = None
) -> DataFrame:
    """The newest version without its partition columns; a slice prunes the folders and the rows."""
    _, manifest = versions.newest(spark, path) or (None, None)
    if manifest is None:
        raise ValueError(f"no table at {path}")
    table = _read_spans(spark, path, manifest, _of_window(manifest["spans"], window))
    if window is not None:
        table = table.filter(_days(window))
        if audit:
            table = table.filter(window.of(table, audit))
    return table.drop(GENERATION, SPAN, DAY)


def read_days(spark: SparkSession, path: str, days: Iterable[date]) -> DataFrame:
    """The rows of some days of the newest version."""
    wanted = sorted(days)
    _, manifest = versions.newest(spark, path) or (None, None)
    if manifest is None:
        raise ValueError(f"no table at {path}")
    spans = sorted({s for d in wanted for s in _of_window(manifest["spans"], Slice.day(d))})
    return _read_spans(spark, path, manifest, spans).filter(F.col(DAY).isin(wanted)).drop(GENERATION, SPAN, DAY)


def _days(window: Slice) -> Column:
    mark = F.lit(window.date)
    if window.kind == "since":
        return (F.col(SPAN) >= f"{window.date:%Y-%m}") & (F.col(DAY) >= mark)
    return F.col(DAY) == mark


def partitions_query(spark: SparkSession, path: str) -> str:
    """The newest version as SQL over its folders, for views. It holds until the version expires."""
    _, manifest = versions.newest(spark, path)
    columns = {f.name: "`" + f.name.replace("`", "``") + "`" for f in _schema(manifest)}
    if not manifest["spans"]:
        nulls = [f"CAST(NULL AS {f.dataType.simpleString()}) AS {columns[f.name]}" for f in _schema(manifest)]
        return f"SELECT {', '.join(nulls)} WHERE false"
    chosen = ", ".join(columns.values())
    by_generation: dict[int, list[str]] = {}
    for span, generation in manifest["spans"].items():
        by_generation.setdefault(generation, []).append(span)
    tests = []
    for generation, spans in sorted(by_generation.items()):
        named = [f"CAST({SPAN} AS STRING) IN ({', '.join(repr(s) for s in sorted(spans) if s != NO_DAY)})"] if set(spans) != {NO_DAY} else []
        named += [f"{SPAN} IS NULL"] if NO_DAY in spans else []
        tests.append(f"({GENERATION} = {generation} AND ({' OR '.join(named)}))")
    return f"SELECT {chosen} FROM parquet.`{path}` WHERE {' OR '.join(tests)}"


def table_notes(spark: SparkSession, path: str) -> dict:
    """What the last writers noted with the table."""
    found = versions.newest(spark, path)
    return found[1]["notes"] if found else {}


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a build of the table ever finished; what a failed first build left does not count."""
    return bool(versions.numbers(spark, path))
