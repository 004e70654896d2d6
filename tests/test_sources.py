import glob
import os
import random
import re
import shutil
import threading
import time
from datetime import date, datetime, timedelta
from decimal import Decimal

import duckdb
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import plan_of, rows_of
from tidemart.functions import day_of
from tidemart.operators import upsert
from tidemart.registry import TableSpec
from tidemart.slices import Slice
from tidemart.sources import (
    FileSource,
    JdbcSource,
    append_delta,
    expire_snapshots,
    merge_into_table,
    overwrite_partitions,
    read_current,
    read_delta,
    read_landing,
    read_partitions,
    read_snapshot,
    read_window,
    write_landing,
    write_snapshot,
)
from tidemart.sources import appendlog, partitions, snapshots, storage, versions
from tidemart.sources.extract import range_predicates, split_column, window_predicates
from tidemart.sources.snapshots import merge_snapshot

T0 = datetime(2024, 1, 2, 5)

# Extraction

EVENTS = TableSpec("events", ("event_id",), "ts")


def test_file_source(spark):
    source = FileSource("/root/testdata/sf0.001", suffix=".parquet")
    assert read_snapshot(spark, source, EVENTS).count() == 1000
    assert read_window(spark, source, EVENTS, Slice.hour(T0)).count() == 2


def test_window_predicates_cover_the_hour():
    ranges = window_predicates("updated_at", Slice.hour(T0), 4)
    assert ranges[0] == "updated_at >= '2024-01-02 05:00:00' AND updated_at < '2024-01-02 05:15:00'"
    assert ranges[-1] == "updated_at >= '2024-01-02 05:45:00' AND updated_at < '2024-01-02 06:00:00'"
    assert window_predicates("c", Slice.since("2020-01-01"), 4) == ["c >= '2020-01-01 00:00:00'"]


def test_split_column_choice():
    spec = TableSpec("t", ("id",), "at")
    kind = lambda a, b: T.StructType([T.StructField("ID", a), T.StructField("at", b)])
    assert split_column(kind(T.LongType(), T.TimestampType()), spec) == "id"
    assert split_column(kind(T.StringType(), T.TimestampType()), spec) == "at"
    assert split_column(kind(T.StringType(), T.StringType()), spec) is None


def test_ranges_cover_every_row():
    assert range_predicates("id", 1, 9, 3) == ["id < 3 OR id IS NULL", "id >= 3 AND id < 6", "id >= 6"]
    assert range_predicates("id", Decimal("1E+3"), Decimal("2000.5"), 2) == ["id < 1500 OR id IS NULL", "id >= 1500"]
    assert range_predicates("id", 5, 5, 4) == []
    assert range_predicates("id", 5, 6, 4) == []
    assert range_predicates("id", 5, 7, 4) == ["id < 6 OR id IS NULL", "id >= 6"]
    assert range_predicates("at", T0, T0 + timedelta(hours=1), 2) == [
        "at < '2024-01-02 05:30:00' OR at IS NULL",
        "at >= '2024-01-02 05:30:00'",
    ]
    assert range_predicates("d", date(2024, 1, 1), date(2024, 1, 3), 2) == [
        "d < '2024-01-02' OR d IS NULL",
        "d >= '2024-01-02'",
    ]


@given(lo=st.integers(-50, 50), span=st.integers(0, 60), parts=st.integers(2, 9))
def test_each_key_falls_in_one_range(lo, span, parts):
    predicates = range_predicates("id", lo, lo + span, parts)
    for value in [*range(lo - 2, lo + span + 3), None]:
        # NULL compares as unknown, which only the IS NULL branch turns into a match.
        hits = [p for p in predicates if (value is None and "IS NULL" in p) or (value is not None and matches(p, value))]
        assert len(hits) == 1 or not predicates


def matches(predicate, value):
    return eval(predicate.replace("id IS NULL", "False").replace("OR", "or").replace("AND", "and"), {"id": value})


class Reader:
    """Stands in for a session's reader and records how a database would be asked."""

    def __init__(self, schema=None, first=None):
        self.schema, self._first, self.calls = schema, first, []

    @property
    def read(self):
        return self

    def format(self, name):
        self.calls.append({"format": name})
        return self

    def options(self, **options):
        self.calls[-1].update(options)
        return self

    def load(self):
        return self

    def first(self):
        return self._first

    def jdbc(self, url, table, **how):
        self.calls.append({"url": url, "table": table, **how})
        return self


class Database(Reader):
    """A stand-in that answers the questions from a table in this process."""

    def __init__(self, schema, rows: str):
        super().__init__(schema)
        self.database = duckdb.connect()
        self.database.execute(f"create table orders as {rows}")

    def _asked(self):
        return self.database.execute(self.calls[-1]["query"]).fetchall()

    def first(self):
        return self._asked()[0]

    def collect(self):
        return self._asked()

    def shares(self) -> list[int]:
        """Rows of each range that the scan asks for."""
        ranges = self.calls[-1]["predicates"]
        return [self.database.execute(f"select count(*) from orders where {p}").fetchone()[0] for p in ranges]


BY_KEY = T.StructType([T.StructField("id", T.LongType()), T.StructField("at", T.TimestampType())])
BY_TIME = T.StructType([T.StructField("id", T.StringType()), T.StructField("changed", T.TimestampType())])


def test_jdbc_snapshot_is_split_by_key():
    reader, source = Reader(BY_KEY, (1, 900)), JdbcSource("jdbc:x", {"user": "u"}, 500, histogram_bins=0)
    read_snapshot(reader, source, TableSpec("orders", ("id",), "at"), 2)
    probe, bounds, scan = reader.calls
    assert bounds["query"] == "SELECT MIN(id) AS lo, MAX(id) AS hi FROM orders"
    assert scan["table"] == "orders" and scan["properties"]["fetchsize"] == "500"
    assert scan["predicates"] == ["id < 450 OR id IS NULL", "id >= 450"]
    empty = Reader(BY_KEY, (None, None))
    read_snapshot(empty, JdbcSource("jdbc:x"), TableSpec("orders", ("id",), "at"), 4)
    assert len(empty.calls) == 2


@pytest.mark.parametrize(
    "keys",
    [
        "select i as id from range(10000) t(i)",
        # Nine tenths of the keys lie in a millionth of the span, and one key is far off.
        "select case when i < 9000 then i when i < 9999 then 1000000 * i else 1000000000000000 end as id from range(10000) t(i)",
        "select -i * i * i as id from range(10000) t(i)",
        "select case when i % 10 = 0 then null else i end as id from range(10000) t(i)",
        "select (i * 1.0)::decimal(20, 2) + 0.25 as id from range(10000) t(i)",
        "select 5 as id",
        "select i as id from range(3) t(i)",
    ],
)
def test_skewed_keys_are_read_in_even_ranges(keys):
    """Every row falls into one range, and no range has over twice its share."""
    for parts in (2, 8, 13):
        reader = Database(BY_KEY, f"select id, timestamp '2024-01-01' as at from ({keys})")
        read_snapshot(reader, JdbcSource("jdbc:x", histogram_bins=64), TableSpec("orders", ("id",), "at"), parts)
        total = reader.database.execute("select count(*) from orders").fetchone()[0]
        if "predicates" not in reader.calls[-1]:
            assert total == 1
            continue
        shares = reader.shares()
        nulls = reader.database.execute("select count(*) from orders where id is null").fetchone()[0]
        assert sum(shares) == total and len(shares) <= parts
        assert max(shares) <= max(2 * total / parts, 1) + nulls
        assert len(reader.calls) < 40


def test_times_are_cut_by_days_of_like_many_rows():
    rows = "select i::varchar as id, timestamp '2024-01-01' + interval (sqrt(i)::int) day + interval (i % 24) hour as changed from range(10000) t(i)"
    reader = Database(BY_TIME, rows)
    read_snapshot(reader, JdbcSource("jdbc:x"), TableSpec("orders", ("id",), "changed"), 8)
    shares = reader.shares()
    assert sum(shares) == 10_000 and len(shares) == 8 and max(shares) <= 2 * 10_000 / 8
    even = range_predicates("changed", datetime(2024, 1, 1), datetime(2024, 4, 10), 8)
    assert max(reader.database.execute(f"select count(*) from orders where {p}").fetchone()[0] for p in even) > max(shares)


def test_jdbc_window_runs_in_the_database():
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("at", T.TimestampNTZType())])
    reader = Reader(schema)
    read_window(reader, JdbcSource("jdbc:x", {"user": "u"}), TableSpec("orders", ("id",), "at"), Slice.hour(T0), 2)
    _, call = reader.calls
    assert call["url"] == "jdbc:x" and call["table"] == "orders"
    assert call["properties"] == {"user": "u", "fetchsize": "10000", "preferTimestampNTZ": "true"}
    assert call["predicates"] == [
        "at >= '2024-01-02 05:00:00' AND at < '2024-01-02 05:30:00'",
        "at >= '2024-01-02 05:30:00' AND at < '2024-01-02 06:00:00'",
    ]


def test_jdbc_options_bound_the_fetch():
    source = JdbcSource("jdbc:postgresql://host/shop", {"user": "u"}, fetch_rows=500)
    assert source.options()["fetchsize"] == "500" and source.options()["user"] == "u"
    zoned = JdbcSource("jdbc:x", {"preferTimestampNTZ": "false"})
    assert zoned.options()["preferTimestampNTZ"] == "false"


# Landing

NASTY = [
    None, "", " lead", "trail ", "  ", "a\nb", "a\r\nb", "a\rb", 'q"q', '"', '""', "a,b", "back\\slash", "\\", "\\\\",
    "\\N", "\\\\N", '\\"', "#c", "é中", "\n", "\t", "\\N ", "null", '"quoted"', "a\\nb", "'", " \n ",
]


def test_landing_keeps_values_whole(spark, tmp_path):
    kinds = "id int, s string, t string, ts timestamp, ntz timestamp_ntz, dec decimal(9,3), d double, b boolean, day date"
    micro = datetime(2024, 1, 2, 3, 4, 5, 123456)
    rows = [(i, s, None, micro, micro, Decimal("-1.250"), i / 3, i % 2 == 0, date(2020, 2, 29)) for i, s in enumerate(NASTY)]
    rows.append((None,) * 9)
    df = spark.createDataFrame(rows, kinds)
    write_landing(df, f"{tmp_path}/slice", max_records_per_file=5)
    back = read_landing(spark, f"{tmp_path}/slice")
    assert back.schema == df.schema
    assert rows_of(back) == rows_of(df)
    parts = glob.glob(f"{tmp_path}/slice/data/**/*.csv", recursive=True)
    assert len(parts) > len(rows) / 5 - 1
    assert (tmp_path / "slice" / "schema.json").is_file()


def test_landing_keeps_bytes(spark, tmp_path):
    rows = [(i, bytearray(v)) for i, v in enumerate([b"", b"\x00\xff\n\x80", b'a,"b', b"\\N", bytes(range(256)) * 9])]
    df = spark.createDataFrame([*rows, (99, None)], "id int, b binary")
    write_landing(df, f"{tmp_path}/slice")
    back = read_landing(spark, f"{tmp_path}/slice")
    assert back.schema == df.schema and rows_of(back) == rows_of(df)


def test_landing_empty_and_replaced(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string")
    write_landing(df, f"{tmp_path}/slice")
    write_landing(df.limit(0), f"{tmp_path}/slice")
    assert read_landing(spark, f"{tmp_path}/slice").count() == 0


def test_landing_fails_on_a_bad_record(spark, tmp_path):
    write_landing(spark.createDataFrame([(1, "a")], "id int, s string"), f"{tmp_path}/slice")
    (tmp_path / "slice" / "data" / "part-x.csv").write_text("id,s\nnot a number,b\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
        read_landing(spark, f"{tmp_path}/slice").collect()


def test_landing_is_flat(spark, tmp_path):
    with pytest.raises(ValueError, match="a"):
        write_landing(spark.sql("select array(1) a"), f"{tmp_path}/slice")


# Append log

LOG = "id long, ts timestamp, v string"


def test_delta_replay_and_append(spark, tmp_path):
    hour = Slice.hour(T0)
    rows = spark.createDataFrame([(1, T0, "a"), (2, T0 + timedelta(minutes=59), "b")], LOG)
    for _ in range(2):
        append_delta(rows, f"{tmp_path}/d", hour, "ts", one_day=True)
    assert rows_of(read_delta(spark, f"{tmp_path}/d")) == rows_of(rows)
    append_delta(rows.limit(0), f"{tmp_path}/d", hour, "ts", one_day=True)
    assert read_delta(spark, f"{tmp_path}/d").count() == 0
    for _ in range(2):
        append_delta(rows, f"{tmp_path}/d", "init-x", "ts", mode="append")
    assert read_delta(spark, f"{tmp_path}/d").count() == 4


def test_delta_day_reads_prune_folders_and_find_every_row(spark, tmp_path):
    times = [None, datetime(2023, 12, 31, 23), datetime(2024, 1, 1), datetime(2024, 1, 2, 5), datetime(2024, 1, 31), datetime(2024, 2, 1)]
    snapshot = spark.createDataFrame([(i, t, "s") for i, t in enumerate(times)], LOG)
    append_delta(snapshot, f"{tmp_path}/d", "init-x", "ts")
    append_delta(
        spark.createDataFrame([(10, T0, "h")], LOG), f"{tmp_path}/d", Slice.hour(T0), "ts", one_day=True
    )
    ids = lambda w: sorted(r.id for r in read_delta(spark, f"{tmp_path}/d", w, "ts").collect())
    assert ids(None) == [0, 1, 2, 3, 4, 5, 10]
    assert ids(Slice.day("2024-01-02")) == [3, 10]
    assert ids(Slice.day("2024-01-01")) == [2]
    assert ids(Slice.hour(T0)) == [3, 10]
    assert ids(Slice.since("2024-01-02")) == [3, 4, 5, 10]
    plan = plan_of(read_delta(spark, f"{tmp_path}/d", Slice.day("2024-01-02"), "ts"))
    assert "PartitionFilters: [p_from" in plan and "GreaterThanOrEqual(ts" in plan


def test_delta_day_reads_list_only_their_slices(spark, tmp_path):
    path, rows = f"{tmp_path}/d", {}
    slices = [Slice.hour(T0), Slice.hour(T0 + timedelta(hours=1)), Slice.hour(T0 + timedelta(days=1)), Slice.day("2024-01-02")]
    for n, window in enumerate(slices):
        rows[n] = spark.createDataFrame([(n, window.start, "a")], LOG)
        append_delta(rows[n], path, window, "ts", one_day=True)
    files = lambda w: len(read_delta(spark, path, w, "ts").inputFiles())
    ids = lambda w: sorted(r.id for r in read_delta(spark, path, w, "ts").collect())
    assert ids(Slice.day("2024-01-02")) == [0, 1, 3] and files(Slice.day("2024-01-02")) == 3
    assert ids(Slice.hour(T0)) == [0] and files(Slice.hour(T0)) == 2
    assert ids(Slice.day("2024-01-04")) == [] and read_delta(spark, path, Slice.day("2024-01-04"), "ts").columns == ["id", "ts", "v"]
    append_delta(rows[0], path, "batch-1", "ts")
    assert ids(Slice.hour(T0)) == [0, 0] and ids(Slice.day("2024-01-04")) == []


def test_delta_refuses_another_schema(spark, tmp_path):
    append_delta(spark.createDataFrame([(1, T0, "a")], LOG), f"{tmp_path}/d", "a", "ts")
    with pytest.raises(ValueError, match="schema"):
        append_delta(spark.createDataFrame([(1, T0)], "id long, ts timestamp"), f"{tmp_path}/d", "b", "ts")
    with pytest.raises(ValueError, match="mode"):
        append_delta(spark.createDataFrame([(1, T0, "a")], LOG), f"{tmp_path}/d", "b", "ts", mode="upsert")


# Day-partitioned tables


def test_overwrite_replaces_only_present_days(spark, tmp_path):
    path, day = f"{tmp_path}/t", day_of("ts")
    d = lambda n: datetime(2024, 1, n, 12)
    first = spark.createDataFrame([(1, d(1), "a"), (2, d(2), "a"), (3, d(3), "a"), (4, None, "a")], LOG)
    overwrite_partitions(first, path, day)
    overwrite_partitions(spark.createDataFrame([(5, d(2), "b")], LOG), path, day)
    state = lambda: sorted((r.id, r.v) for r in read_partitions(spark, path).collect())
    assert state() == [(1, "a"), (3, "a"), (4, "a"), (5, "b")]
    # An empty result leaves the old day ...
    overwrite_partitions(first.limit(0), path, day)
    assert len(state()) == 4
    # ... unless the day is to be cleared.
    overwrite_partitions(first.limit(0), path, day, clear_empty=date(2024, 1, 2))
    assert state() == [(1, "a"), (3, "a"), (4, "a")]
    overwrite_partitions(first.filter("id = 2"), path, day, clear_empty=date(2024, 1, 2))
    assert state() == [(1, "a"), (2, "a"), (3, "a"), (4, "a")]
    overwrite_partitions(first.filter("id = 3"), path, day, whole_table=True)
    assert state() == [(3, "a")]


def test_empty_tables_and_other_schemas(spark, tmp_path):
    path, rows = f"{tmp_path}/t", spark.createDataFrame([(1, T0, "a")], LOG)
    overwrite_partitions(rows.limit(0), path, day_of("ts"), whole_table=True)
    assert read_partitions(spark, path).collect() == [] and read_partitions(spark, path).schema == rows.schema
    assert read_partitions(spark, path, Slice.day(T0), "ts").collect() == []
    overwrite_partitions(rows, path, day_of("ts"))
    overwrite_partitions(rows.limit(0), path, day_of("ts"), clear_empty=T0.date())
    assert read_partitions(spark, path, Slice.day(T0), "ts").collect() == []
    wider = rows.withColumn("w", F.lit(1))
    with pytest.raises(ValueError, match="schema"):
        overwrite_partitions(wider, path, day_of("ts"))
    overwrite_partitions(wider, path, day_of("ts"), whole_table=True)
    assert read_partitions(spark, path).columns == wider.columns


def test_partition_reads_prune(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = spark.createDataFrame([(n, datetime(2024, 1, n, 12), "a") for n in range(1, 10)], LOG)
    overwrite_partitions(rows, path, day_of("ts"))
    day = read_partitions(spark, path, Slice.day("2024-01-04"), "ts")
    assert [r.id for r in day.collect()] == [4] and len(day.inputFiles()) == 1
    assert day.columns == rows.columns
    since = read_partitions(spark, path, Slice.since("2024-01-04"), "ts")
    assert since.count() == 6 and "PartitionFilters: [isnotnull(p_span" in plan_of(since)
    assert read_partitions(spark, path, Slice.day("2025-01-01"), "ts").count() == 0
    assert [r.id for r in read_partitions(spark, path, Slice.day("2024-01-04")).collect()] == [4]


# Current-state snapshots


def test_snapshot_versions(spark, tmp_path):
    path = f"{tmp_path}/main"
    assert read_current(spark, path, ["id"]) is None
    rows = spark.createDataFrame([(i, T0, "a") for i in range(50)], LOG)
    assert write_snapshot(rows, path, ["id"], 4) == 1
    changes = spark.createDataFrame([(i, T0 + timedelta(hours=1), "b") for i in range(40, 60)], LOG)
    assert merge_snapshot(spark, path, changes, ["id"], "ts", 4) == 2
    current = read_current(spark, path, ["id"])
    assert current.groupBy("v").count().orderBy("v").collect() == [("a", 40), ("b", 20)]
    # An interrupted version (no manifest) is not read, and its number is not used again.
    os.makedirs(f"{path}/rows-000003.buckets=4")
    assert read_current(spark, path, ["id"]).count() == 60
    assert merge_snapshot(spark, path, changes, ["id"], "ts", 8) == 4
    assert rows_of(read_current(spark, path, ["id"])) == rows_of(current)
    assert expire_snapshots(spark, path, keep=5) == []
    assert expire_snapshots(spark, path, keep=1) == [1, 2]
    assert sorted(os.listdir(path)) == ["_versions", "rows-000004.buckets=8"]
    assert read_current(spark, path, ["id"]).count() == 60
    with pytest.raises(ValueError):
        expire_snapshots(spark, path, keep=0)


def test_snapshot_is_found_by_another_session(spark, tmp_path):
    """The bucketed table is rebuilt from the folder when the catalog does not know it."""
    path = f"{tmp_path}/main"
    write_snapshot(spark.createDataFrame([(i, T0, "a") for i in range(50)], LOG), path, ["id"], 4)
    for name in [t.name for t in spark.catalog.listTables() if t.name.startswith("main_")]:
        spark.sql(f"DROP TABLE spark_catalog.default.{name}")
    current = read_current(spark, path, ["id"])
    assert current.count() == 50
    assert "Exchange" not in plan_of(current.groupBy("id").count())


def test_buckets_follow_the_size(spark, tmp_path, monkeypatch):
    assert snapshots.buckets_for(0) == 8 and snapshots.buckets_for(100 * 1024**4) == 100_000
    assert snapshots.buckets_for(10 * 1024**3) == 40
    path, rows = f"{tmp_path}/main", spark.range(2000).selectExpr("id", "timestamp'2024-01-01' ts", "uuid() v")
    write_snapshot(rows, path, ["id"], 2)
    layouts = lambda: sorted(int(f.split("=")[-1]) for f in os.listdir(path) if f.startswith("rows-"))
    monkeypatch.setattr(snapshots, "MIN_BUCKETS", 1)
    merge_snapshot(spark, path, rows.limit(10), ["id"], "ts")
    assert layouts() == [2]
    monkeypatch.setattr(snapshots, "BUCKET_BYTES", 8_000)
    merge_snapshot(spark, path, rows.limit(10), ["id"], "ts")
    assert layouts()[0] == 2 and layouts()[1] > 4
    assert read_current(spark, path, ["id"]).count() == 2000


def test_empty_snapshot(spark, tmp_path):
    path, rows = f"{tmp_path}/main", spark.createDataFrame([(1, T0, "a")], LOG)
    write_snapshot(rows.limit(0), path, ["id"], 2)
    for name in [t.name for t in spark.catalog.listTables() if t.name.startswith("main_")]:
        spark.sql(f"DROP TABLE spark_catalog.default.{name}")
    assert read_current(spark, path, ["id"]).collect() == []
    merge_snapshot(spark, path, rows, ["id"], "ts", 2)
    assert rows_of(read_current(spark, path, ["id"])) == rows_of(rows)


def test_merge_moves_only_the_changes(spark, tmp_path):
    path = f"{tmp_path}/main"
    write_snapshot(spark.createDataFrame([(i, T0, "a") for i in range(500)], LOG), path, ["id"], 8)
    changes = spark.createDataFrame([(i, T0, "b") for i in range(400, 600)], LOG).repartition(8, "id")
    plan = plan_of(upsert(read_current(spark, path, ["id"]), changes, ["id"], "ts"))
    initial = plan.split("Initial Plan")[-1]
    assert initial.count("Exchange") == 1 and "Bucketed: true" in initial


def files_of(path) -> dict[str, tuple]:
    """Data files of a stored table, with their sizes and when they were written."""
    found = {}
    for folder, _, names in os.walk(path):
        for name in (n for n in names if n.endswith(".parquet") and not n.startswith(".")):
            stat = os.stat(f"{folder}/{name}")
            found[os.path.relpath(f"{folder}/{name}", path)] = (stat.st_size, stat.st_mtime_ns)
    return found


def bucket_in(name: str) -> int:
    return int(re.search(r"_(\d+)\.c\d+", name)[1])


def test_a_merge_writes_only_the_buckets_that_change(spark, tmp_path):
    """A day that touches 1 % of the buckets writes about 1 % of the bytes, and reads no other bucket."""
    path = f"{tmp_path}/main"
    rows = spark.range(20_000).selectExpr("id", "timestamp'2024-01-01' ts", "uuid() v")
    write_snapshot(rows, path, ["id"], 100)
    before = files_of(path)
    assert len(before) == 100
    mine = {r.id for r in rows.withColumn("b", snapshots.bucket_of(["id"], 100)).filter("b = 42").collect()}
    changes = rows.filter(F.col("id").isin(mine)).selectExpr("id", "ts + interval 1 hour as ts", "'new' as v")
    # Files of other buckets are not even opened.
    saved = {}
    for name in before:
        if bucket_in(name) != 42:
            saved[name] = open(f"{path}/{name}", "rb").read()
            open(f"{path}/{name}", "wb").write(b"unreadable" * 100)
    merge_snapshot(spark, path, changes, ["id"], "ts", 100)
    for name, content in saved.items():
        open(f"{path}/{name}", "wb").write(content)
    after = files_of(path)
    new = set(after) - set(before)
    assert len(new) == 1 and {bucket_in(n) for n in new} == {42} and set(before) <= set(after)
    assert sum(after[n][0] for n in new) < 0.02 * sum(s for s, _ in before.values())
    current = read_current(spark, path, ["id"])
    assert current.count() == 20_000 and {r.id for r in current.filter("v = 'new'").collect()} == mine


def test_full_buckets_are_folded_alone(spark, tmp_path, conf):
    path = f"{tmp_path}/main"
    rows = spark.createDataFrame([(i, T0, "a") for i in range(200)], LOG)
    write_snapshot(rows, path, ["id"], 8)
    whole = files_of(path)
    bucket = rows.filter("id = 7").select(snapshots.bucket_of(["id"], 8)).first()[0]
    for n in range(1, 4):
        change = spark.createDataFrame([(7, T0 + timedelta(hours=n), f"v{n}")], LOG)
        merge_snapshot(spark, path, change, ["id"], "ts", 8, max_changes=2)
    folded = [f for f in files_of(path) if "p_part=b" in f and f not in whole]
    assert [bucket_in(f) for f in folded] == [bucket]
    # The bucket's older files are not part of the table any more: they can be unreadable.
    dead = [f for f in files_of(path) if f not in folded and bucket_in(f) == bucket]
    assert len(dead) == 4
    for name in dead:
        open(f"{path}/{name}", "wb").write(b"unreadable" * 100)
    current = read_current(spark, path, ["id"])
    assert current.count() == 200 and current.filter("id = 7").first().v == "v3"
    expire_snapshots(spark, path, keep=1)
    left = files_of(path)
    assert len(left) == 8 and not set(dead) & set(left)
    assert read_current(spark, path, ["id"]).count() == 200


def test_changes_are_taken_in_without_a_shuffle(spark, tmp_path, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    path = f"{tmp_path}/main"
    write_snapshot(spark.createDataFrame([(i, T0, "a") for i in range(500)], LOG), path, ["id"], 8)
    changes = spark.createDataFrame([(i, T0, "b") for i in range(400, 600)], LOG)
    merge_snapshot(spark, path, changes, ["id"], "ts", 8)
    current = read_current(spark, path, ["id"])
    assert "Exchange" not in plan_of(current) and plan_of(current).count("Bucketed: true") == 3
    assert current.groupBy("v").count().orderBy("v").collect() == [("a", 400), ("b", 200)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_merges_equal_upserts_one_after_another(spark, tmp_path, seed):
    """NULL audits and keys, stale changes, foldings and expiry in any order."""
    rnd, path = random.Random(seed), f"{tmp_path}/main"

    def images(nulls: int) -> list[tuple]:
        keys = rnd.sample(range(30), 10)
        stamps = [None, *(T0 + timedelta(hours=h) for h in range(5))]
        return [(k, rnd.choice(stamps), f"v{rnd.random()}") for k in keys] + [(None, rnd.choice(stamps), f"n{rnd.random()}")] * nulls

    def merged(state: list[tuple], changes: list[tuple]) -> list[tuple]:
        out = {k: (k, ts, v) for k, ts, v in state if k is not None}
        for k, ts, v in changes:
            old = out.get(k)
            if k is not None and (old is None or (old[1] is not None and ts is not None and old[1] <= ts)):
                out[k] = (k, ts, v)
        return [*out.values(), *(r for r in [*state, *changes] if r[0] is None)]

    state = images(1)
    write_snapshot(spark.createDataFrame(state, LOG), path, ["id"], 4)
    for step in range(5):
        changes = images(rnd.randint(0, 1))
        merge_snapshot(spark, path, spark.createDataFrame(changes, LOG), ["id"], "ts", 4, max_changes=rnd.randint(1, 3))
        state = merged(state, changes)
        assert rows_of(read_current(spark, path, ["id"])) == sorted(state, key=repr)
        if step % 2:
            expire_snapshots(spark, path, keep=1)
        if step == 3:
            snapshots.fold(spark, path, ["id"])
    assert rows_of(read_current(spark, path, ["id"])) == sorted(state, key=repr)
    shown = spark.sql(snapshots.current_query(spark, path, ["id"]))
    assert rows_of(shown) == sorted(state, key=repr)


def test_a_second_writer_is_refused(spark, tmp_path, monkeypatch):
    path, rows = f"{tmp_path}/main", spark.createDataFrame([(1, T0, "a")], LOG)
    write_snapshot(rows, path, ["id"], 2)
    monkeypatch.setattr(snapshots, "_next_number", lambda spark, path: 1)
    with pytest.raises(FileExistsError):
        merge_snapshot(spark, path, rows, ["id"], "ts", 2)
    assert rows_of(read_current(spark, path, ["id"])) == rows_of(rows)


def test_native_merge_needs_a_capable_catalog(spark, tmp_path):
    spark.createDataFrame([(1, T0, "a")], LOG).write.option("path", f"{tmp_path}/t").saveAsTable("plain_main")
    changes = spark.createDataFrame([(1, T0, "b")], LOG)
    with pytest.raises(UnsupportedOperationException, match="MERGE INTO TABLE"):
        merge_into_table(spark, "plain_main", changes, ["id"], "ts")
    spark.sql("DROP TABLE plain_main")


# Storage


def test_only_a_missing_path_is_missing(spark, tmp_path):
    assert not storage.exists(spark, f"{tmp_path}/nothing")
    assert storage.child_names(spark, f"{tmp_path}/nothing") == []
    with pytest.raises(Exception, match="No FileSystem"):
        storage.exists(spark, "nowhere://host/path")


def test_shared_dir_on_a_cluster_must_be_set(spark, conf, monkeypatch):
    from tidemart import session

    class Context:
        master = "yarn"

    class Fake:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: None)})
        sparkContext = Context

    with pytest.raises(ValueError, match="checkpoint"):
        session.shared_dir(Fake)
    assert session.scratch(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


# Failed writes


def failing(spark, df):
    """The same rows from a task that fails while it is writing them."""

    @F.udf("string")
    def broken(v):
        raise RuntimeError("a task fails")

    return df.withColumn("v", broken("v"))


def test_a_failed_rerun_leaves_the_slice_of_the_log(spark, tmp_path):
    path, rows = f"{tmp_path}/log", spark.createDataFrame([(n, T0, "a") for n in range(10)], LOG)
    for label, one_day in ((Slice.hour(T0), True), ("init-x", False)):
        append_delta(rows, path, label, "ts", one_day=one_day)
    before = rows_of(read_delta(spark, path))
    for label, one_day in ((Slice.hour(T0), True), ("init-x", False)):
        with pytest.raises(Exception, match="a task fails"):
            append_delta(failing(spark, rows), path, label, "ts", one_day=one_day)
    assert rows_of(read_delta(spark, path)) == before and len(before) == 20
    append_delta(rows.limit(0), path, "init-x", "ts")
    assert read_delta(spark, path).count() == 10
    moved = rows.withColumn("ts", F.lit(datetime(2023, 5, 1)))
    append_delta(moved, path, Slice.hour(T0), "ts", one_day=True)
    assert rows_of(read_delta(spark, path)) == rows_of(moved)


def test_an_unfinished_landing_folder_is_not_read(spark, tmp_path):
    path, rows = f"{tmp_path}/landed", spark.createDataFrame([(n, T0, "a") for n in range(10)], LOG)
    write_landing(rows, path)
    with pytest.raises(Exception, match="a task fails"):
        write_landing(failing(spark, rows), path)
    with pytest.raises(ValueError, match="not finished"):
        read_landing(spark, path)
    write_landing(rows, path)
    assert read_landing(spark, path).count() == 10


def test_a_failed_write_leaves_the_days(spark, tmp_path):
    path, day = f"{tmp_path}/t", day_of("ts")
    rows = spark.createDataFrame([(n, datetime(2024, 1, n, 12), "a") for n in range(1, 6)], LOG)
    overwrite_partitions(rows, path, day, whole_table=True, gather_before=date(2024, 1, 1))
    before = rows_of(read_partitions(spark, path))
    for how in ({}, {"whole_table": True}, {"clear_empty": date(2024, 1, 2)}):
        with pytest.raises(Exception, match="a task fails"):
            overwrite_partitions(failing(spark, rows), path, day, **how)
        assert rows_of(read_partitions(spark, path)) == before


def test_closed_months_are_gathered(spark, tmp_path):
    path, day = f"{tmp_path}/t", day_of("ts")
    stamps = [datetime(2023, 11, 5), datetime(2023, 12, 1, 3), datetime(2023, 12, 31, 23), datetime(2024, 1, 1), datetime(2024, 1, 9, 4)]
    rows = spark.createDataFrame([(n, at, "a") for n, at in enumerate(stamps)] + [(9, None, "a")], LOG)
    overwrite_partitions(rows, path, day, whole_table=True, gather_before=date(2024, 1, 20))
    spans = lambda: sorted(versions.newest(spark, path)[1]["spans"])
    closed = ["2023-11", "2023-12"]
    assert spans() == [*closed, "2024-01-01", "2024-01-09", "__HIVE_DEFAULT_PARTITION__"]
    state = lambda: sorted((r.id, r.v) for r in read_partitions(spark, path).collect())
    assert read_partitions(spark, path).columns == rows.columns and len(state()) == 6
    for n, at in enumerate(stamps):
        assert [r.id for r in read_partitions(spark, path, Slice.day(at), "ts").collect()] == [n]
    assert sorted(r.id for r in read_partitions(spark, path, Slice.since("2023-12-02")).collect()) == [2, 3, 4]
    # Days inside and outside of gathered months are rebuilt at once; a new day gets a folder of its own.
    again = spark.createDataFrame([(20, stamps[1], "b"), (21, stamps[3], "b"), (22, datetime(2024, 1, 10), "b")], LOG)
    overwrite_partitions(again, path, day)
    assert state() == [(0, "a"), (2, "a"), (4, "a"), (9, "a"), (20, "b"), (21, "b"), (22, "b")]
    assert [n for n in spans() if n in closed] == closed and "2024-01-10" in spans()
    overwrite_partitions(rows.limit(0), path, day, clear_empty=date(2023, 12, 31))
    assert read_partitions(spark, path, Slice.day("2023-12-31")).count() == 0 and len(state()) == 6
    overwrite_partitions(rows.limit(0), path, day, clear_empty=date(2023, 12, 1))
    overwrite_partitions(rows.filter("id = 2"), path, day, clear_empty=date(2023, 12, 31))
    assert state() == [(0, "a"), (2, "a"), (4, "a"), (9, "a"), (21, "b"), (22, "b")]


def test_a_reader_sees_all_days_of_one_version(spark, tmp_path):
    """Reads while days are rebuilt: every one has both days of the same version."""
    path, day = f"{tmp_path}/t", day_of("ts")
    stamps = [datetime(2024, 1, n, 12) for n in range(1, 9)]

    def build(n: int) -> None:
        rows = spark.createDataFrame([(i, at, f"v{n}") for i, at in enumerate(stamps)], LOG)
        overwrite_partitions(rows, path, day, clear_empty=[at.date() for at in stamps])

    build(0)
    begun = read_partitions(spark, path)  # planned before, run after the next version
    seen, stop, failed = [], threading.Event(), []

    def watch() -> None:
        try:
            while not stop.is_set():
                seen.append({r.v for r in read_partitions(spark, path).collect()})
        except Exception as error:
            failed.append(error)

    watcher = threading.Thread(target=watch)
    watcher.start()
    for n in range(1, 6):
        build(n)
        if n == 1:
            assert {r.v for r in begun.collect()} == {"v0"}
        time.sleep(0.2)
    stop.set()
    watcher.join()
    assert not failed and len(seen) > 2 and all(len(values) == 1 for values in seen)
    assert len([n for n in os.listdir(path) if n.startswith("p_gen=")]) == 2


def test_a_rebuild_leaves_other_folders_alone(spark, tmp_path):
    path, day = f"{tmp_path}/t", day_of("ts")
    rows = spark.createDataFrame([(n, datetime(2024, 1, n, 12), "a") for n in range(1, 11)], LOG)
    overwrite_partitions(rows, path, day)
    before = files_of(path)
    for _ in range(3):
        overwrite_partitions(rows.filter("id = 4"), path, day)
    after = files_of(path)
    same = set(before) & set(after)
    assert len(same) == 9 and all(before[f] == after[f] for f in same)
    assert sum("p_span=2024-01-04" in f for f in after) == 2  # this version's, and the one before for its readers
    shown = spark.sql(partitions.partitions_query(spark, path))
    assert rows_of(shown) == rows_of(read_partitions(spark, path)) == rows_of(rows)


def test_folder_columns_are_refused(spark, tmp_path):
    rows = spark.createDataFrame([(1, T0, "a")], LOG)
    for name in ("p_span", "p_date"):
        with pytest.raises(ValueError, match=name):
            overwrite_partitions(rows.withColumn(name, F.lit("x")), f"{tmp_path}/t", day_of("ts"))
    for name in ("slice", "P_FROM"):
        with pytest.raises(ValueError, match=name):
            append_delta(rows.withColumn(name, F.lit("x")), f"{tmp_path}/d", "s", "ts")


# Bounds by type


def test_hours_of_an_audit_by_dates(spark, tmp_path):
    rows = spark.sql("select id, date '2024-01-02' as at from range(3) union all select 9, date '2024-01-03'")
    rows.write.parquet(f"{tmp_path}/orders")
    read = lambda hour: read_window(spark, FileSource(str(tmp_path)), TableSpec("orders", ("id",), "at"), Slice.hour(hour))
    assert read(datetime(2024, 1, 2, 0)).count() == 3 and read(datetime(2024, 1, 2, 23)).count() == 0
    assert read(datetime(2024, 1, 2, 1)).count() == 0 and read(datetime(2024, 1, 3, 0)).count() == 1
    assert "PushedFilters: [IsNotNull(at), GreaterThanOrEqual(at,2024-01-02)" in plan_of(read(datetime(2024, 1, 2, 0)))


def test_audits_that_are_no_times_are_refused(spark, tmp_path):
    spark.sql("select 1 as id, '2024-01-02T05:30:00' as at").write.parquet(f"{tmp_path}/orders")
    with pytest.raises(ValueError, match="string"):
        read_window(spark, FileSource(str(tmp_path)), TableSpec("orders", ("id",), "at"), Slice.hour(T0))
    with pytest.raises(ValueError, match="no column"):
        read_window(spark, FileSource(str(tmp_path)), TableSpec("orders", ("id",), "missing"), Slice.hour(T0))


def test_jdbc_dates_and_zones():
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("at", T.DateType())])
    reader = Reader(schema)
    read_window(reader, JdbcSource("jdbc:postgresql://h/s"), TableSpec("orders", ("id",), "at"), Slice.day(T0), 8)
    call = reader.calls[-1]
    assert call["predicates"] == ["at >= '2024-01-02' AND at < '2024-01-03'"]
    assert call["properties"]["sessionInitStatement"] == "SET TIME ZONE 'UTC'"
    own = JdbcSource("jdbc:postgresql://h/s", {"sessionInitStatement": "SET x"})
    assert own.options()["sessionInitStatement"] == "SET x" and "sessionInitStatement" not in JdbcSource("jdbc:x").options()


def test_no_landing_part_exceeds_its_bytes_by_more_than_a_row(spark, tmp_path):
    path, bound = f"{tmp_path}/landed", 20_000
    rows = spark.range(0, 3_000, 1, 3).select(
        F.col("id"), F.lit(T0).alias("ts"), F.when(F.col("id") % 500 == 0, F.repeat(F.lit('"é\n'), 9_000)).otherwise(F.repeat(F.lit("x"), (F.col("id") % 90).cast("int"))).alias("v")
    )
    write_landing(rows, path, max_bytes_per_file=bound)
    assert rows_of(read_landing(spark, path)) == rows_of(rows)
    sizes = [os.path.getsize(n) for n in glob.glob(f"{path}/data/**/*.csv", recursive=True)]
    header = len("id,ts,v\n")
    assert len([s for s in sizes if s > bound + header]) == 6  # the rows larger than the bound, one to a part
    assert len(sizes) < 60
    write_landing(rows.limit(0), path)
    assert read_landing(spark, path).count() == 0


def test_landing_is_one_job_with_parts_below_the_bound(spark, tmp_path):
    """Rows of 20 bytes to 4 MB in three tasks: one job, no part above 19,000,000 bytes, few parts."""
    size = F.when(F.col("id") % 1000 == 0, 4_000_000).when(F.col("id") % 10 == 0, 6_000).otherwise(F.col("id") % 50)
    rows = spark.range(0, 12_000, 1, 3).select("id", F.repeat(F.lit("x"), size.cast("int")).alias("v"))
    spark.sparkContext.setJobGroup("landing-job", "one slice")
    write_landing(rows, f"{tmp_path}/landed")
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("landing-job")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 1
    sizes = [os.path.getsize(n) for n in glob.glob(f"{tmp_path}/landed/data/**/*.csv", recursive=True)]
    assert sum(sizes) > 50_000_000 and max(sizes) <= 19_000_000 and len(sizes) < 40
    back = read_landing(spark, f"{tmp_path}/landed")
    assert back.selectExpr("count(*)", "sum(id)", "sum(length(v))").first() == rows.selectExpr("count(*)", "sum(id)", "sum(length(v))").first()
    with pytest.raises(ValueError, match="part"):
        write_landing(rows.withColumn("part", F.lit(1)), f"{tmp_path}/other")


# Zone map and journal of the log


def test_day_reads_open_only_files_that_hold_the_day(spark, tmp_path, conf):
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB")
    path = f"{tmp_path}/d"
    rows = spark.range(60_000).selectExpr(
        "id", "timestamp_seconds(1704067200 + pmod(xxhash64(id), 60 * 86400)) as ts", "string(xxhash64(id, 7)) as v"
    )
    append_delta(rows, path, "init-x", "ts")
    append_delta(rows.filter("id < 10").withColumn("ts", F.lit(T0)), path, Slice.hour(T0), "ts", one_day=True)
    month = len(read_delta(spark, path, Slice.since("2024-01-01"), "ts").filter("ts < '2024-02-01'").inputFiles())
    for day in ("2024-01-02", "2024-01-31", "2024-02-11"):
        window = Slice.day(day)
        read = read_delta(spark, path, window, "ts")
        assert len(read.inputFiles()) < month / 4
        everything = spark.read.parquet(path).select("id", "ts", "v").filter(window.predicate("ts"))
        assert rows_of(read) == rows_of(everything) and read.count() > 0
    assert read_delta(spark, path, Slice.day("2024-03-25"), "ts").inputFiles() == []
    # A folder with files that the map does not know is read whole.
    stray = glob.glob(f"{path}/slice=init-x/p_from=2024-01-01/*.parquet")[0]
    shutil.copy(stray, stray.replace("part-", "part-9"))
    window = Slice.day("2024-01-02")
    everything = spark.read.parquet(path).select("id", "ts", "v").filter(window.predicate("ts"))
    assert rows_of(read_delta(spark, path, window, "ts")) == rows_of(everything)


def test_zones_follow_a_slice_that_is_written_again(spark, tmp_path):
    path, rows = f"{tmp_path}/d", spark.createDataFrame([(n, datetime(2024, 1, n, 12), "a") for n in range(1, 6)], LOG)
    append_delta(rows, path, "batch", "ts")
    moved = rows.withColumn("ts", F.col("ts") + F.expr("interval 20 days"))
    append_delta(moved, path, "batch", "ts")
    assert read_delta(spark, path, Slice.day("2024-01-02"), "ts").count() == 0
    assert [r.id for r in read_delta(spark, path, Slice.day("2024-01-22"), "ts").collect()] == [2]
    append_delta(rows.limit(0), path, "batch", "ts")
    assert read_delta(spark, path, Slice.day("2024-01-22"), "ts").count() == 0


def test_the_journal_names_the_days_before_and_after(spark, tmp_path):
    path, hour = f"{tmp_path}/d", Slice.hour(T0)
    at = lambda *days: spark.createDataFrame([(d, datetime(2024, 1, d, 5, 30), "a") for d in days], LOG)
    assert appendlog.last_write(spark, path) == 0 and appendlog.changed_days(spark, path, 0) == {}
    append_delta(at(1, 9), path, "init-x", "ts")
    append_delta(at(2), path, hour, "ts", one_day=True)
    assert appendlog.changed_days(spark, path, 0) == {"2024-01-01": 1, "2024-01-09": 1, "2024-01-02": 2}
    append_delta(at(2).limit(0), path, hour, "ts", one_day=True)
    append_delta(at(9, 10), path, "init-x", "ts")
    assert appendlog.changed_days(spark, path, 2) == {"2024-01-02": 3, "2024-01-01": 4, "2024-01-09": 4, "2024-01-10": 4}
    assert appendlog.last_write(spark, path) == 4
