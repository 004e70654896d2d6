import os
import shutil
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidemart.operators import latest_per_key
from tidemart.registry import TableSpec
from tidemart.slices import Slice
from tidemart.sources import append_delta, landing, read_current, read_delta, snapshots, write_landing
from tidemart.streaming import landing_stream, stream_upsert

KIND = "id long, ts timestamp, v string"
SPEC = TableSpec("t", ("id",), "ts")
T0 = datetime(2024, 1, 2, 5)


def frame(spark, rows):
    return spark.createDataFrame([(i, T0 + timedelta(minutes=m), v) for i, m, v in rows], KIND)


def test_landing_files_are_loaded_once(spark, tmp_path):
    root = str(tmp_path)
    load = lambda: landing_stream(
        spark, f"{root}/db/t/*/*/data", frame(spark, []).schema, f"{root}/delta", "ts", f"{root}/ck"
    ).awaitTermination()
    first, second = frame(spark, [(1, 1, "a\nb"), (2, 2, "\\N"), (3, 3, None)]), frame(spark, [(4, 70, "")])
    write_landing(first, f"{root}/{Slice.hour(T0).path('db', 't')}", max_records_per_file=1)
    load()
    assert rows_of(read_delta(spark, f"{root}/delta")) == rows_of(first)
    load()
    assert read_delta(spark, f"{root}/delta").count() == 3
    write_landing(second, f"{root}/{Slice.hour(T0 + timedelta(hours=1)).path('db', 't')}")
    # Snapshot folders lie one level deeper and are not picked up.
    write_landing(first, f"{root}/{Slice.hour(T0).path('db', 't', init=True)}")
    load()
    assert rows_of(read_delta(spark, f"{root}/delta")) == rows_of(first.union(second))


def test_loads_of_two_checkpoints_do_not_replace_each_other(spark, tmp_path):
    root, rows = str(tmp_path), frame(spark, [(1, 1, "a")])
    for table in ("t", "u"):
        write_landing(rows, f"{root}/{Slice.hour(T0).path('db', table)}")
        load = landing_stream(spark, f"{root}/db/{table}/*/*/data", rows.schema, f"{root}/delta", "ts", f"{root}/ck-{table}")
        load.awaitTermination()
    assert read_delta(spark, f"{root}/delta").count() == 2


def test_streamed_state(spark, tmp_path):
    root = str(tmp_path)
    slices = [[(1, 1, "a"), (2, 5, "b"), (1, 2, "c")], [(2, 4, "stale"), (3, 9, "new"), (1, 8, "d")]]
    rows = frame(spark, [])
    for n, part in enumerate(slices):
        append_delta(frame(spark, part), f"{root}/delta", f"s{n}", "ts")
        rows = rows.union(frame(spark, part))
        for _ in range(2):
            stream_upsert(spark, f"{root}/delta", f"{root}/main", SPEC, f"{root}/ck", 2).awaitTermination()
    state = read_current(spark, f"{root}/main", ["id"])
    assert rows_of(state) == rows_of(latest_per_key(rows, ["id"], "ts"))
    assert {r.id: r.v for r in state.collect()} == {1: "d", 2: "b", 3: "new"}


def test_many_small_batches_give_the_same_state(spark, tmp_path):
    root = str(tmp_path)
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").repartition(4, "event_id")
    for n in range(3):
        append_delta(events.filter(f"event_id % 3 = {n}"), f"{root}/delta", f"s{n}", "ts", one_day=True)
    spec = TableSpec("events", ("user_id",), "ts")
    stream_upsert(spark, f"{root}/delta", f"{root}/main", spec, f"{root}/ck", 2, max_files=40).awaitTermination()
    assert rows_of(read_current(spark, f"{root}/main", ["user_id"])) == rows_of(latest_per_key(events, ["user_id"], "ts"))


def test_replayed_batch_is_harmless(spark, tmp_path):
    """A new checkpoint sees every row again; the state stays."""
    root = str(tmp_path)
    append_delta(frame(spark, [(1, 1, "a"), (1, 2, "b")]), f"{root}/delta", "s", "ts")
    for checkpoint in ("ck1", "ck2"):
        stream_upsert(spark, f"{root}/delta", f"{root}/main", SPEC, f"{root}/{checkpoint}", 2).awaitTermination()
        assert [r.v for r in read_current(spark, f"{root}/main", ["id"]).collect()] == ["b"]


def test_a_slice_landed_again_replaces_itself(spark, tmp_path):
    root, folder = str(tmp_path), f"{tmp_path}/{Slice.hour(T0).path('db', 't')}"
    run = lambda: landing_stream(
        spark, f"{root}/db/t/*/*/data", frame(spark, []).schema, f"{root}/delta", "ts", f"{root}/ck"
    ).awaitTermination()
    write_landing(frame(spark, [(1, 1, "a"), (2, 2, "b")]), folder)
    run()
    write_landing(frame(spark, [(2, 2, "c")]), folder)
    run()
    assert [(r.id, r.v) for r in read_delta(spark, f"{root}/delta").collect()] == [(2, "c")]


def test_an_unfinished_slice_is_loaded_by_a_later_run(spark, tmp_path):
    root, folder = str(tmp_path), f"{tmp_path}/{Slice.hour(T0).path('db', 't')}"
    rows = frame(spark, [(1, 1, "a")])
    run = lambda: landing_stream(
        spark, f"{root}/db/t/*/*/data", rows.schema, f"{root}/delta", "ts", f"{root}/ck"
    ).awaitTermination()
    write_landing(rows, folder)
    os.rename(f"{folder}/schema.json", f"{folder}/hidden")
    with pytest.raises(Exception, match="not finished"):
        run()
    os.rename(f"{folder}/hidden", f"{folder}/schema.json")
    run()
    assert rows_of(read_delta(spark, f"{root}/delta")) == rows_of(rows)


def test_old_files_are_taken(spark, tmp_path):
    root = str(tmp_path)
    for n, days in enumerate((0, 20, 4000)):
        append_delta(frame(spark, [(n, n, "x")]), f"{root}/delta", f"s{n}", "ts")
        for folder, _, files in os.walk(f"{root}/delta/slice=s{n}"):
            for file in files:
                at = datetime.now().timestamp() - days * 86_400
                os.utime(f"{folder}/{file}", (at, at))
        stream_upsert(spark, f"{root}/delta", f"{root}/main", SPEC, f"{root}/ck", 2).awaitTermination()
    assert read_current(spark, f"{root}/main", ["id"]).count() == 3


def test_merges_go_to_a_catalog_table_where_one_is_named(spark, tmp_path, monkeypatch):
    calls = []
    monkeypatch.setattr(snapshots, "merge_into_table", lambda s, table, df, keys, audit: calls.append((table, df.count(), keys, audit)))
    append_delta(frame(spark, [(1, 1, "a"), (1, 2, "b"), (2, 3, "c")]), f"{tmp_path}/delta", "s", "ts")
    stream_upsert(spark, f"{tmp_path}/delta", f"{tmp_path}/main", SPEC, f"{tmp_path}/ck", catalog_table="lake.t").awaitTermination()
    assert calls == [("lake.t", 2, ("id",), "ts")] and not os.path.exists(f"{tmp_path}/main")


def test_a_first_version_is_sized_by_its_log(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "BUCKET_BYTES", 100)
    append_delta(frame(spark, [(n, n, "x" * 50) for n in range(50)]), f"{tmp_path}/delta", "s", "ts")
    stream_upsert(spark, f"{tmp_path}/delta", f"{tmp_path}/main", SPEC, f"{tmp_path}/ck").awaitTermination()
    assert read_current(spark, f"{tmp_path}/main", ["id"]).count() == 50
    (folder,) = [n for n in os.listdir(f"{tmp_path}/main") if n.startswith("rows-")]
    assert int(folder.split("buckets=")[1]) > snapshots.MIN_BUCKETS


def test_many_landing_folders_are_checked_by_tasks(spark, tmp_path, monkeypatch):
    """The driver reads no schema file, and a folder of another schema, or none, stops the batch."""
    root, rows = f"{tmp_path}/with space", frame(spark, [(1, 1, "a")])
    first = f"{root}/{Slice.hour(T0).path('db', 't')}"
    write_landing(rows, first)
    hours = [T0 + timedelta(hours=h) for h in range(300)]
    for hour in hours[1:]:
        shutil.copytree(first, f"{root}/{Slice.hour(hour).path('db', 't')}")

    def run(checkpoint: str) -> None:
        load = landing_stream(spark, f"{root}/db/t/*/*/data", rows.schema, f"{root}/delta", "ts", f"{root}/{checkpoint}")
        load.awaitTermination()

    with monkeypatch.context() as patch:
        patch.setattr(landing, "landed_schema", lambda *a: pytest.fail("read by the driver"))
        run("ck")
    assert read_delta(spark, f"{root}/delta").count() == 300
    other = f"{root}/{Slice.hour(hours[150]).path('db', 't')}"
    write_landing(rows.withColumn("v", F.lit(1)), other)
    with pytest.raises(Exception, match="schema of the landing slice differs"):
        run("ck")
    write_landing(rows, other)
    write_landing(rows, first)
    run("ck")
    assert read_delta(spark, f"{root}/delta").count() == 300
