"""Sliced windows against plain windows and brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strataflow.functions.times import hour_of
from strataflow.operators import match
from strataflow.operators.ordered import change_points, with_closest
from strataflow.operators.scd import scd2_history

START = dt.datetime(2024, 1, 1)
SCHEMA = "k int, ts timestamp_ntz, v string, id int"


def sample(seed, n=400, keys=3, values=3, hours=24 * 20):
    """Rows with unique (k, ts); key 0 holds most of them, some days are empty."""
    rng = random.Random(seed)
    rows, seen = [], set()
    while len(rows) < n:
        k = 0 if rng.random() < 0.6 else rng.randrange(keys)
        ts = START + dt.timedelta(hours=rng.randrange(hours), minutes=rng.choice([0, 30]))
        if (k, ts) in seen or ts.day % 7 == 3:
            continue
        seen.add((k, ts))
        v = rng.choice([None, *"abc"[:values]])
        rows.append((k, ts, v, len(rows)))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_change_points_equal_plain_windows(spark, seed):
    df = spark.createDataFrame(sample(seed, values=2), SCHEMA)
    w = Window.partitionBy("k").orderBy("ts")
    marked = df.withColumn("before", F.lag("v").over(w)).withColumn("rn", F.row_number().over(w))
    starts = marked.filter((F.col("rn") == 1) | ~F.col("v").eqNullSafe(F.col("before")))
    want = starts.select("k", "v", "ts", F.lead("ts").over(w).alias("until"))
    got = change_points(df, ["k"], "v", "ts", until="until")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


@pytest.mark.parametrize("seed", range(3))
def test_closest_values_equal_brute_force(spark, seed):
    rows = sample(seed, n=150)
    got = with_closest(
        spark.createDataFrame(rows, SCHEMA), ["k"], ["ts"], "v", before="b", after="a"
    ).collect()
    by_id = {r.id: (r.b, r.a) for r in got}
    for k, ts, _, i in rows:
        line = sorted((r for r in rows if r[0] == k and r[2] is not None), key=lambda r: r[1])
        before = [r[2] for r in line if r[1] <= ts]
        after = [r[2] for r in line if r[1] >= ts]
        assert by_id[i] == (before[-1] if before else None, after[0] if after else None)


@pytest.mark.parametrize("seed", range(3))
def test_nearest_match_equals_brute_force(spark, seed):
    rng = random.Random(seed)

    def side(n):
        # Few distinct instants, so that ties and copies occur.
        return [
            (rng.randrange(3), START + dt.timedelta(hours=6 * rng.randrange(60)), i) for i in range(n)
        ]

    left, right = side(80), side(60) + [(9, START, 999)]
    schema = "k int, t timestamp_ntz, id int"
    matched = match.nearest_match(
        spark.createDataFrame(left, schema),
        spark.createDataFrame([r for r in right if r[0] != 2], schema),
        ["k"],
        "t",
        ["id"],
        right_tie=["id"],
    ).collect()
    assert len(matched) == len(left)
    got = {r.id: (r.matched_t, r.matched_id) for r in matched}
    for k, t, i in left:
        options = [(abs(rt - t), rt, ri) for rk, rt, ri in right if rk == k and k != 2]
        assert got[i] == (min(options)[1:] if options else (None, None))


def test_nearest_match_tolerance_and_reconcile(spark):
    schema = "k int, t timestamp_ntz, m double"
    stored = spark.createDataFrame([(1, START, 10.0), (2, START, 1.0), (3, START, 1.0)], schema)
    source = spark.createDataFrame(
        [(1, START + dt.timedelta(hours=1), 10.5), (2, START + dt.timedelta(days=3), 1.0)], schema
    )
    rows = match.reconcile(stored, source, ["k"], "t", {"m": 1.0}, tolerance_seconds=7200)
    got = {r.k: (r.source_m, r.m_ok, r.time_diff_seconds) for r in rows.collect()}
    assert got == {1: (10.5, True, 3600.0), 2: (None, None, None), 3: (None, None, None)}


def test_slice_width_changes_no_row(spark):
    df = spark.createDataFrame(sample(0, n=200, values=2), SCHEMA)
    default = change_points(df, ["k"], "v", "ts", until="until").collect()
    for slice_by in (F.to_date("ts"), hour_of(F.col("ts")), F.date_trunc("second", "ts"), F.lit(1)):
        cut = change_points(df, ["k"], "v", "ts", until="until", slice_by=slice_by).collect()
        assert sorted(map(repr, cut)) == sorted(map(repr, default))


@pytest.mark.parametrize("row", [(None, START, "a", 9), (1, None, "a", 9)])
def test_changes_without_key_or_time_are_not_lost_in_silence(spark, row):
    rows = [(1, START, "a", 1), row]
    with pytest.raises(Exception, match="NULL in one of"):
        scd2_history(spark.createDataFrame(rows, SCHEMA), ["k"], "v", "ts").collect()


def test_history_keeps_the_last_of_simultaneous_changes(spark):
    rows = [(1, START, "a", 1), (1, START, "b", 2), (1, START + dt.timedelta(days=40), "a", 3)]
    got = scd2_history(spark.createDataFrame(rows, SCHEMA), ["k"], "v", "ts", last_by=["id"]).collect()
    assert sorted((r.v, r.valid_from, r.valid_to, r.is_current) for r in got) == [
        ("a", START + dt.timedelta(days=40), None, True),
        ("b", START, START + dt.timedelta(days=40), False),
    ]
