from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import plan_of, rows_of
from tidemart.functions import exact, signed_total
from tidemart.operators import asof_join, latest_per_key, upsert

T0 = datetime(2024, 1, 1)


def at(hours: float) -> datetime:
    return T0 + timedelta(hours=hours)


# latest_per_key


def test_latest_ties_and_duplicates(spark):
    rows = [(1, at(1), "a"), (1, at(2), "z"), (1, at(2), "b"), (1, at(2), "b"), (2, at(5), "x"), (2, at(5), "x")]
    df = spark.createDataFrame(rows, "id long, ts timestamp, v string")
    assert rows_of(latest_per_key(df, ["id"], "ts")) == [(1, at(2), "b"), (2, at(5), "x")]
    chosen = latest_per_key(df, ["id"], "ts", tiebreak=[F.col("v").desc()])
    assert rows_of(chosen) == [(1, at(2), "z"), (2, at(5), "x")]


def test_latest_null_audit_and_null_key(spark):
    rows = [(1, None, "n"), (1, at(0), "a"), (2, None, "only"), (None, at(1), "p"), (None, at(2), "q")]
    df = spark.createDataFrame(rows, "id long, ts timestamp, v string")
    got = {(r.id, r.v) for r in latest_per_key(df, ["id"], "ts").collect()}
    assert got == {(1, "a"), (2, "only"), (None, "q")}


def test_latest_per_day(spark):
    rows = [(1, at(1), "a"), (1, at(23.9), "b"), (1, at(24), "c"), (2, at(3), "d")]
    df = spark.createDataFrame(rows, "id long, ts timestamp, v string")
    assert sorted(r.v for r in latest_per_key(df, ["id"], "ts", per_day=True).collect()) == ["b", "c", "d"]


def test_latest_is_idempotent(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    once = latest_per_key(lines, ["l_orderkey", "l_linenumber"], "l_shipdate")
    assert rows_of(latest_per_key(once, ["l_orderkey", "l_linenumber"], "l_shipdate")) == rows_of(once)


# upsert

SCHEMA = "id long, ts timestamp, v string"


def test_upsert_cases(spark):
    main = [
        (1, at(1), "newer comes"),
        (2, at(2), "equal comes"),
        (3, at(9), "older comes"),
        (4, None, "no audit"),
        (5, at(1), "change without audit"),
        (6, at(1), "untouched"),
        (None, at(1), "no key"),
    ]
    changes = [
        (1, at(5), "new"),
        (2, at(2), "new"),
        (3, at(5), "new"),
        (4, at(5), "new"),
        (5, None, "new"),
        (7, at(1), "inserted"),
        (None, at(1), "inserted without key"),
    ]
    merged = upsert(spark.createDataFrame(main, SCHEMA), spark.createDataFrame(changes, SCHEMA), ["id"], "ts")
    assert sorted(((r.id, r.v) for r in merged.collect()), key=repr) == sorted(
        [
            (1, "new"),
            (2, "new"),
            (3, "older comes"),
            (4, "no audit"),
            (5, "change without audit"),
            (6, "untouched"),
            (7, "inserted"),
            (None, "no key"),
            (None, "inserted without key"),
        ],
        key=repr,
    )


def test_upsert_keeps_nulls_of_the_taken_row(spark):
    main = spark.createDataFrame([(1, at(1), "old")], SCHEMA)
    changes = spark.createDataFrame([(1, at(2), None)], SCHEMA)
    assert rows_of(upsert(main, changes, ["id"], "ts")) == [(1, at(2), None)]


def test_upsert_schema_follows_main(spark):
    main = spark.createDataFrame([(1, at(1), 1)], "id long, ts timestamp, a int")
    wider = spark.createDataFrame([(1, at(2), 5, "x")], "id long, ts timestamp, a long, b string")
    merged = upsert(main, wider, ["id"], "ts")
    assert merged.schema.simpleString() == main.schema.simpleString()
    assert rows_of(merged) == [(1, at(2), 5)]
    with pytest.raises(ValueError, match="a"):
        upsert(main, wider.drop("a"), ["id"], "ts")


def test_upsert_composite_key(spark):
    schema = "k1 long, k2 string, ts timestamp, v int"
    main = spark.createDataFrame([(1, "a", at(1), 1), (1, "b", at(1), 2)], schema)
    changes = spark.createDataFrame([(1, "b", at(2), 3), (2, "a", at(2), 4)], schema)
    assert {(r.k1, r.k2, r.v) for r in upsert(main, changes, ["k1", "k2"], "ts").collect()} == {
        (1, "a", 1),
        (1, "b", 3),
        (2, "a", 4),
    }


def test_upsert_is_idempotent_and_order_free(spark):
    log = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    day = lambda d: latest_per_key(log.filter(F.to_date("ts") == F.lit(d)), ["user_id"], "ts")
    main = day("2024-01-01")
    once = upsert(main, day("2024-01-02"), ["user_id"], "ts")
    assert rows_of(upsert(once, day("2024-01-02"), ["user_id"], "ts")) == rows_of(once)
    forward = upsert(once, day("2024-01-03"), ["user_id"], "ts")
    backward = upsert(upsert(main, day("2024-01-03"), ["user_id"], "ts"), day("2024-01-02"), ["user_id"], "ts")
    assert rows_of(forward) == rows_of(backward)


VERSION = st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 9))


def rank(row):
    """Latest first: audit descending with NULL last, then the payload ascending."""
    return (row[1] is None, -(row[1] or 0), row[2])


def latest_by_hand(rows):
    best = {}
    for row in rows:
        best[row[0]] = min(best.get(row[0], row), row, key=rank)
    return list(best.values())


def merge_by_hand(main, changes):
    out = list(main)
    for row in changes:
        at_key = [i for i, r in enumerate(out) if row[0] is not None and r[0] == row[0]]
        if not at_key:
            out.append(row)
        elif row[1] is not None and out[at_key[0]][1] is not None and out[at_key[0]][1] <= row[1]:
            out[at_key[0]] = row
    return sorted(out, key=repr)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(older=st.lists(VERSION, max_size=20), newer=st.lists(VERSION, max_size=20))
def test_latest_and_merge_against_brute_force(spark, older, newer):
    kind = "id int, ts int, v int"
    frames = [spark.createDataFrame(rows, kind) for rows in (older, newer)]
    by_hand = [latest_by_hand(rows) for rows in (older, newer)]
    images = [latest_per_key(df, ["id"], "ts") for df in frames]
    assert [rows_of(df) for df in images] == [sorted(rows, key=repr) for rows in by_hand]
    assert rows_of(upsert(*images, ["id"], "ts")) == merge_by_hand(*by_hand)


# asof_join

LEFT, RIGHT = "n long, k long, ts timestamp", "k long, vts timestamp, v string"


def brute_force(left, right, how="left"):
    out = []
    for n, k, ts in left:
        seen = [r for r in right if k is not None and ts is not None and r[0] == k and r[1] is not None and r[1] <= ts]
        best = max(seen, key=lambda r: r[1], default=None)
        if best is not None or how == "left":
            out.append((n, k, ts, best and best[1], best and best[2]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seconds", [3_600, 10**10])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_asof_edges(spark, seconds, how):
    left = [
        (1, 1, at(24)),  # exactly at a version
        (2, 1, at(24) - timedelta(microseconds=1)),
        (3, 1, at(-5)),  # only later versions
        (4, 1, at(500)),  # several earlier
        (5, 2, at(1)),  # key without versions
        (6, None, at(1)),
        (7, 1, None),
        (8, 1, at(24)),
        (9, 3, datetime(1969, 12, 31, 12)),
    ]
    right = [
        (1, at(0), "a"),
        (1, at(24), "b"),
        (1, at(30), "c"),
        (1, at(31), "d"),
        (None, at(0), "nokey"),
        (1, None, "notime"),
        (3, datetime(1969, 12, 30), "old"),
        (3, datetime(1970, 1, 1, 1), "epoch"),
    ]
    joined = asof_join(
        spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ["k"], "ts", "vts", how, seconds
    )
    assert joined.columns == ["n", "k", "ts", "vts", "v"]
    assert rows_of(joined) == brute_force(left, right, how)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    probes=st.lists(st.tuples(st.integers(0, 2), st.integers(-90, 200)), max_size=30),
    versions=st.sets(st.tuples(st.integers(0, 2), st.integers(-90, 200)), max_size=25),
)
def test_asof_against_brute_force(spark, probes, versions):
    left = [(n, k, at(h)) for n, (k, h) in enumerate(probes)]
    right = [(k, at(h), f"{k}@{h}") for k, h in versions]
    expected = brute_force(left, right)
    l, r = spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)
    for seconds in (3_600, 86_400, 7_200):
        assert rows_of(asof_join(l, r, ["k"], "ts", "vts", "left", seconds)) == expected


def test_asof_runs_no_job_while_it_is_built(spark):
    left, right = spark.createDataFrame([(1, 1, at(5))], LEFT), spark.createDataFrame([(1, at(1), "a")], RIGHT)
    spark.sparkContext.setJobGroup("asof", "build")
    joined = asof_join(left, right, ["k"], "ts", "vts")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("asof") == []
    spark.sparkContext.setJobGroup("tests", "")
    assert "Broadcast" not in plan_of(joined) and "Cartesian" not in plan_of(joined)


def test_asof_keeps_columns_whatever_their_names(spark):
    left = spark.sql("select 1 as `key_0`, timestamp '2024-01-01 05:00:00' as at, 'x' as row, 3 as `a.b`, 4 as slot")
    right = spark.sql("select 1 as `key_0`, timestamp '2024-01-01 04:00:00' as since, 'v' as version, 5 as `c.d`")
    joined = asof_join(left, right, ["key_0"], "at", "since")
    assert joined.columns == ["key_0", "at", "row", "a.b", "slot", "since", "version", "c.d"]
    assert [tuple(r)[2:5] + tuple(r)[6:] for r in joined.collect()] == [("x", 3, 4, "v", 5)]


def test_asof_rejects(spark):
    left = spark.createDataFrame([], LEFT)
    with pytest.raises(ValueError, match="ts"):
        asof_join(left, spark.createDataFrame([], "k long, ts timestamp"), ["k"], "ts", "ts")
    right = spark.createDataFrame([], RIGHT)
    with pytest.raises(ValueError):
        asof_join(left, right, ["k"], "ts", "vts", how="full")


RESERVED = "select 1 as id, 5 as place, 6 as there, 7 as `a.b`, timestamp '2024-01-01' as ts"


def test_latest_images_keep_columns_whatever_their_names(spark):
    rows = spark.sql(f"{RESERVED} union all select 1, 8, 9, 10, timestamp '2024-01-02'")
    assert [tuple(r)[:4] for r in latest_per_key(rows, ["id"], "ts").collect()] == [(1, 8, 9, 10)]
    assert latest_per_key(rows, ["a.b"], "ts", per_day=True).columns == rows.columns


def test_merges_keep_columns_whatever_their_names(spark):
    main, changes = spark.sql(RESERVED), spark.sql("select 2 as id, 1 as place, 0 as there, 3 as `a.b`, timestamp '2024-01-02' as ts")
    merged = upsert(main, changes, ["id"], "ts")
    assert sorted(tuple(r)[:4] for r in merged.collect()) == [(1, 5, 6, 7), (2, 1, 0, 3)]


def test_amounts_are_not_rounded(spark):
    floats = spark.sql("select * from values (0.00004d, null), (0.00004d, null), (1.23456d, null), (2e14d, null), (2e14d, 1) t(p, r)")
    assert floats.agg(signed_total(exact("p"), "r").cast("double").alias("s")).first().s == 1.23464
    decimals = spark.sql("select cast(p as decimal(12,5)) as p, cast(null as int) as r from values (0.00004), (0.00004), (1.23456) t(p)")
    total = decimals.agg(signed_total("p", "r").alias("s")).first().s
    assert str(total) == "1.23464"
