"""Current-state tables ("main"): Parquet files bucketed by key, and change files beside them.

A layout is one bucketing of the table. A merge looks up the changes' keys in the buckets that they fall into and
appends the rows that win as change files of those buckets; no other file is written. A reader lets the newest
image of a key replace the older ones, bucket by bucket, so nothing of the table is shuffled. A bucket with too many change
files is folded: written anew as a whole, alone. A manifest (``sources.versions``) names the generations of
files that make a version, and for folded buckets the generation that they start from.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions import named, refuse, unused
from tidemart.operators.merge import upsert, winning_changes
from tidemart.session import scratch
from tidemart.sources import storage, versions

# A bucket is one file and one task of a read.
BUCKET_BYTES = 256 * 1024**2
MIN_BUCKETS, MAX_BUCKETS = 8, 100_000
#: Change files of a bucket beyond which it is folded.
MAX_CHANGES = 8
#: Up to so many buckets a read names them, so that Spark leaves out the files of all others.
NAMED_BUCKETS = 5_000

#: The folder column: ``b`` for whole buckets or ``c`` for changes, and the version that wrote them.
PART = "p_part"


def buckets_for(size: int) -> int:
    """Bucket count for a table of that many bytes."""
    return max(MIN_BUCKETS, min(MAX_BUCKETS, -(-size // BUCKET_BYTES)))


def _part(kind: str, number: int) -> str:
    return f"{kind}{number:06d}"


def _layout(number: int, buckets: int) -> str:
    return f"rows-{number:06d}.buckets={buckets}"


def _buckets(layout: str) -> int:
    return int(layout.rpartition("=")[2])


def _next_number(spark: SparkSession, path: str) -> int:
    """Above every number that any writer has used, finished or not."""
    used = versions.numbers(spark, path)
    for layout in storage.child_names(spark, path):
        if layout.startswith("rows-"):
            used.append(int(layout[5:11]))
            parts = storage.child_names(spark, f"{path}/{layout}")
            used += [int(m[1]) for m in (re.match(rf"{PART}=[bc](\d+)$", p) for p in parts) if m]
    return max(used, default=0) + 1


def _quoted(columns: Iterable[str]) -> str:
    return ", ".join("`" + c.replace("`", "``") + "`" for c in columns)


def _table_of(folder: str) -> str:
    return f"spark_catalog.default.main_{hashlib.md5(folder.encode()).hexdigest()}"


def _table(spark: SparkSession, folder: str, keys: Sequence[str], parts: Iterable[str] = ()) -> str:
    """The bucketed table over a layout, with those of its folders registered."""
    table = _table_of(folder)
    if not spark.catalog.tableExists(table):
        schema = storage.read_schema(spark, f"{folder}/_schema.json")
        columns = ", ".join(f"{_quoted([f.name])} {f.dataType.simpleString()}" for f in schema)
        by, location = _quoted(keys), folder.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {PART} STRING) USING parquet PARTITIONED BY ({PART}) "
            f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {_buckets(folder)} BUCKETS LOCATION '{location}'"
        )
    if parts:
        folders = " ".join(f"PARTITION ({PART}='{p}')" for p in parts)
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {folders}")
    return table


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket that Spark files a row under."""
    return F.pmod(F.hash(*map(named, keys)), F.lit(buckets))


def _append(rows: DataFrame, folder: str, keys: Sequence[str], part: str, whole: bool) -> None:
    """Write rows as one file per bucket. A whole table takes a task per bucket; a few buckets share tasks."""
    spark, buckets = rows.sparkSession, _buckets(folder)
    by = [named(k) for k in keys]
    dealt = rows.repartition(buckets, *by) if whole else rows.repartition(bucket_of(keys, buckets))
    dealt.withColumn(PART, F.lit(part)).write.insertInto(_table(spark, folder, keys))


def write_snapshot(df: DataFrame, path: str, keys: Sequence[str], buckets: int = MIN_BUCKETS) -> int:
    """Write the whole table as a new layout, hashed by key into ``buckets`` sorted files; returns the version.

    The column name ``p_part`` is taken. A failed or interrupted write leaves files that no version names.
    """
    refuse(df, PART)
    spark, number = df.sparkSession, _next_number(df.sparkSession, path)
    layout, part = _layout(number, buckets), _part("b", number)
    storage.write_schema(spark, f"{path}/{layout}/_schema.json", df.schema)
    _append(df, f"{path}/{layout}", keys, part, whole=True)
    manifest = {"layout": layout, "parts": {part: None}, "floors": {}}
    return versions.commit(spark, path, number, manifest)


def _alive(manifest: dict, only: Sequence[int] | None) -> str:
    """Which files count, by their names: those of a bucket from its last folding on, in the buckets asked for.

    A predicate on file names alone, so Spark applies it to the list of files and opens no others.
    """
    tests = []
    bucket = "int(regexp_extract(_metadata.file_name, r'_(\\d+)\\.c\\d+', 1))"
    if manifest["floors"]:
        by_floor: dict[int, list[str]] = {}
        for folded, floor in manifest["floors"].items():
            by_floor.setdefault(floor, []).append(folded)
        cases = " ".join(f"WHEN {bucket} IN ({', '.join(b)}) THEN {floor}" for floor, b in sorted(by_floor.items()))
        written = f"int(regexp_extract(_metadata.file_path, r'{PART}=[bc](\\d+)/', 1))"
        tests.append(f"{written} >= CASE {cases} ELSE 0 END")
    if only is not None and len(only) <= NAMED_BUCKETS:
        tests.append(f"{bucket} IN ({', '.join(map(str, only)) or 'NULL'})")
    return "".join(f" AND {test}" for test in tests)


def _current_sql(relation: str, manifest: dict, keys: Sequence[str], columns: Sequence[str], only: Sequence[int] | None = None) -> str:
    """The rows of a version: the newest change of each key, and whole buckets without the keys changed since.

    Rows with a NULL in their key match nothing and all stay.
    """
    alive = _alive(manifest, only)
    whole, changed = ([f"'{p}'" for p in manifest["parts"] if p.startswith(kind)] for kind in "bc")
    chosen = _quoted(columns)
    base = f"SELECT {chosen} FROM {relation} WHERE {PART} IN ({', '.join(whole)}){alive}"
    if not changed:
        return base
    place, by = unused(columns, "place"), _quoted(keys)
    no_key = " OR ".join(f"{_quoted([k])} IS NULL" for k in keys)
    same = " AND ".join(f"b.{_quoted([k])} = c.{_quoted([k])}" for k in keys)
    ranked = (
        f"SELECT {_quoted(dict.fromkeys([*columns, *keys]))}, row_number() OVER (PARTITION BY {by} ORDER BY {PART} DESC) AS {place} "
        f"FROM {relation} WHERE {PART} IN ({', '.join(changed)}){alive}"
    )
    whole_rows = f"SELECT {_quoted(dict.fromkeys([*columns, *keys]))} FROM {relation} WHERE {PART} IN ({', '.join(whole)}){alive}"
    newest = f"SELECT * FROM ({ranked}) WHERE {place} = 1 OR {no_key}"
    outer = ", ".join(f"b.{_quoted([c])}" for c in columns)
    return f"SELECT {outer} FROM ({whole_rows}) b LEFT ANTI JOIN ({newest}) c ON {same} UNION ALL SELECT {chosen} FROM ({newest})"


def _read(spark: SparkSession, path: str, manifest: dict, keys: Sequence[str], columns: Sequence[str] | None = None, only=None) -> DataFrame:
    folder = f"{path}/{manifest['layout']}"
    table = _table(spark, folder, keys, manifest["parts"])
    if columns is None:
        columns = storage.read_schema(spark, f"{folder}/_schema.json").names
    return spark.sql(_current_sql(table, manifest, keys, columns, only))


def read_current(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame | None:
    """The newest version, or None if there is none; other errors propagate.

    The files are read through a bucketed table, so taking the changes in needs no shuffle of the
    table, nor does a join or aggregation by key of a version without changes.
    """
    found = versions.newest(spark, path)
    return None if found is None else _read(spark, path, found[1], keys)


def current_version(spark: SparkSession, path: str) -> int | None:
    found = versions.numbers(spark, path)
    return found[-1] if found else None


def current_query(spark: SparkSession, path: str, keys: Sequence[str]) -> str:
    """The newest version as SQL over its folders, for views. It holds until the version expires."""
    _, manifest = versions.newest(spark, path)
    folder = f"{path}/{manifest['layout']}"
    columns = storage.read_schema(spark, f"{folder}/_schema.json").names
    return _current_sql(f"parquet.`{folder}`", manifest, keys, columns)


def merge_snapshot(
    spark: SparkSession,
    path: str,
    changes: DataFrame,
    keys: Sequence[str],
    audit: str,
    buckets: int | None = None,
    first_bytes: int | None = None,
    max_changes: int = MAX_CHANGES,
) -> int:
    """Merge ``changes`` (one row per key) into the current version; returns the version that holds them.

    A first version takes as many buckets as ``first_bytes``, the size of what it is built from, needs.

    Only key and audit columns of the buckets that the changes fall into are read, and only the changes that win are
    written. Without a given count, the current bucketing is kept until the table has outgrown it twice over; another
    count writes the table anew. Buckets with more than ``max_changes`` change files are folded.
    """
    found = versions.newest(spark, path)
    if found is None:
        return write_snapshot(changes, path, keys, buckets or buckets_for(first_bytes or 0))
    _, manifest = found
    folder = f"{path}/{manifest['layout']}"
    stored = _buckets(folder)
    if buckets is None:
        fitting = buckets_for(storage.size(spark, folder))
        buckets = fitting if fitting > 2 * stored else stored
    if buckets != stored:
        return write_snapshot(upsert(_read(spark, path, manifest, keys), changes, keys, audit), path, keys, buckets)

    # Changes are needed twice, to name their buckets and to be compared; they are small beside the table.
    staged, bucket = scratch(spark, "changes"), unused(changes.columns, "bucket")
    schema = storage.read_schema(spark, f"{folder}/_schema.json")
    missing = [c for c in schema.names if c not in changes.columns]
    if missing:
        raise ValueError(f"changes lack columns of the main table: {', '.join(missing)}")
    typed = changes.select(*[named(f.name).cast(f.dataType).alias(f.name) for f in schema])
    typed.withColumn(bucket, bucket_of(keys, stored)).write.parquet(staged)
    incoming = spark.read.parquet(staged)
    touched = sorted(r[0] for r in incoming.select(bucket).distinct().collect())  # at most the table's buckets
    number = _next_number(spark, path)
    part = _part("c", number)
    held = _read(spark, path, manifest, keys, list(dict.fromkeys([*keys, audit])), touched)
    _append(winning_changes(held, incoming.drop(bucket), keys, audit), folder, keys, part, whole=False)
    storage.delete(spark, staged)
    manifest["parts"][part] = touched
    versions.commit(spark, path, number, manifest)
    counts: dict[int, int] = {}
    for held_buckets in manifest["parts"].values():
        for b in held_buckets or ():
            counts[b] = counts.get(b, 0) + 1
    full = sorted(b for b, n in counts.items() if n > max_changes)
    return fold(spark, path, keys, full) if full else number


def fold(spark: SparkSession, path: str, keys: Sequence[str], buckets: Sequence[int] | None = None) -> int:
    """Write buckets (by default all that have change files) as a whole, each alone; returns the new version."""
    number, manifest = versions.newest(spark, path)
    folder, floors = f"{path}/{manifest['layout']}", manifest["floors"]
    if buckets is None:
        buckets = sorted({b for held in manifest["parts"].values() for b in held or ()})
    if not buckets:
        return number
    if len(buckets) > NAMED_BUCKETS:
        # Too many to name: a new layout is as cheap.
        return write_snapshot(_read(spark, path, manifest, keys), path, keys, _buckets(folder))
    new = _next_number(spark, path)
    part, folded = _part("b", new), set(buckets)
    _append(_read(spark, path, manifest, keys, only=buckets), folder, keys, part, whole=False)
    floors |= {str(b): new for b in buckets}
    parts = {part: None}
    for name, held in manifest["parts"].items():
        if held is None or (held := [b for b in held if b not in folded]):
            parts[name] = held
    return versions.commit(spark, path, new, {**manifest, "parts": parts})


def expire_snapshots(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Drop all versions older than the newest ``keep`` and the files only they have; returns those dropped."""
    if keep < 1:
        raise ValueError("keep at least the current version")
    found = versions.numbers(spark, path)
    old, kept = found[:-keep], found[-keep:]
    if not old:
        return []
    manifests = [versions.load(spark, path, n) for n in kept]
    for number in old:
        versions.drop(spark, path, number)
    for layout in storage.child_names(spark, path):
        if not layout.startswith("rows-") or int(layout[5:11]) > kept[0]:
            continue
        mine = [m for m in manifests if m["layout"] == layout]
        if not mine:
            spark.sql(f"DROP TABLE IF EXISTS {_table_of(f'{path}/{layout}')}")
            storage.delete(spark, f"{path}/{layout}")
            continue
        for folder in storage.child_names(spark, f"{path}/{layout}"):
            name = re.match(rf"{PART}=([bc])(\d+)$", folder)
            if name and int(name[2]) <= kept[0] and not any(name[1] + name[2] in m["parts"] for m in mine):
                storage.delete(spark, f"{path}/{layout}/{folder}")
            elif name and name[1] == "b":
                _expire_files(spark, f"{path}/{layout}/{folder}", int(name[2]), mine)
    return old


def _expire_files(spark: SparkSession, folder: str, written: int, manifests: list[dict]) -> None:
    """Delete the files of buckets that every kept version starts from a later folding."""
    later = [{int(b) for b, floor in m["floors"].items() if floor > written} for m in manifests]
    dead = set.intersection(*later)
    if dead:
        for name in storage.child_names(spark, folder):
            bucket = re.search(r"_(\d+)\.c\d+", name)
            if bucket and int(bucket[1]) in dead:
                storage.delete(spark, f"{folder}/{name}")


def merge_into_table(spark: SparkSession, table: str, changes: DataFrame, keys: Sequence[str], audit: str) -> None:
    """The same merge on a catalog table that supports row-level changes.

    Such tables rewrite only the files that change, so prefer them to snapshots where a
    catalog for them is configured. Column lists follow the schema of ``table``.
    """
    columns = spark.table(table).columns
    name = table.split(".")[-1]
    target = lambda c: F.col(f"{name}.`{c}`")
    source = lambda c: F.col(f"d.`{c}`")
    same_key = reduce(and_, [target(k) == source(k) for k in keys])
    changes.select(*columns).alias("d").mergeInto(table, same_key).whenNotMatched().insert(
        {c: source(c) for c in columns}
    ).whenMatched(target(audit) <= source(audit)).update({c: source(c) for c in columns if c not in keys}).merge()
