import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strataflow.operators import aggregate, merge, pick
from strataflow.operators.keys import dense_ids, placeholder_ids, surrogate_ids
from strataflow.operators.scd import scd2_apply, scd2_history

NOW = dt.datetime(2024, 2, 1)
T0 = dt.datetime(2024, 1, 1)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def hour(n):
    return T0 + dt.timedelta(hours=n)


# Picks


def test_latest_ignores_row_order_and_puts_nulls_first(spark):
    data = [("a", hour(1), 1), ("a", hour(2), 2), ("a", hour(2), 3), ("b", None, 4), ("b", hour(9), 5), (None, hour(1), 6)]
    want = [("a", 3), ("b", 4), (None, 6)]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k string, at timestamp_ntz, id int").repartition(seed + 1)
        got = pick.latest_per_key(df, ["k"], "at", ["id"])
        assert rows(got, "k", "id") == sorted(want, key=repr)


def test_limit_is_applied_before_the_shuffle(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    plan = pick.latest_per_key(df, ["k"], "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_rows_at_max_keeps_ties(spark):
    df = spark.createDataFrame([(1, 5, "x"), (1, 5, "y"), (1, 4, "z"), (2, 1, "w")], "k int, t int, v string")
    assert rows(pick.rows_at_max(df, ["k"], "t"), "v") == [("w",), ("x",), ("y",)]


def titles_to_try(city, region, country, alternative):
    out = []
    for name in [city or alternative] + ([alternative] if alternative and alternative != (city or alternative) else []):
        if region and country:
            out.append(f"{name}, {region}, {country}")
        if region:
            out.append(f"{name}, {region}")
        if country:
            out.append(f"{name}, {country}")
        out.append(name)
    return out


def test_candidates_in_order_of_specificity(spark):
    data = [
        ("Paris", "Texas", "US", "Paris"),
        ("Paris", "", "France", "Paris city"),
        ("Bonn", None, None, "Bonn"),
        ("", "R", "C", "Alt"),
    ]
    df = spark.createDataFrame(data, "city string, region string, country string, alt string")
    titles = pick.candidate_titles(*[F.col(c) for c in df.columns])
    got = df.select(F.array_compact(F.array(*titles))).collect()
    assert [r[0] for r in got] == [titles_to_try(*d) for d in data]


def test_first_match_takes_the_first_hit(spark):
    entities = spark.createDataFrame([(1, "a", "b"), (2, "x", "b"), (3, "x", "y")], "id int, c1 string, c2 string")
    lookup = spark.createDataFrame([("a", 10), ("b", 20)], "title string, page int")
    got = pick.first_match(entities, [F.col("c1"), F.col("c2")], lookup, "title", ["id"])
    assert rows(got, "id", "candidate_position", "page") == [(1, 0, 10), (2, 1, 20)]


def test_mode_takes_the_smallest_on_ties_and_skips_nulls(spark):
    data = [(1, "b"), (1, "a"), (1, None), (1, None), (1, None), (2, None)]
    df = spark.createDataFrame(data, "k int, v string")
    assert rows(aggregate.mode_per_group(df, ["k"], "v"), "k", "v") == [(1, "a"), (2, None)]


# Upserts

FACT = "loc int, at timestamp_ntz, temp double, note string, created timestamp_ntz"
BATCH = "loc int, at timestamp_ntz, temp double, pos int"


def upsert(target, batch, **kw):
    return merge.merge_upsert(
        target, batch, ["loc", "at"], ["temp"], last_by=["pos"], insert_values={"created": F.lit(NOW)}, **kw
    )


def test_upsert_overwrites_with_null_and_keeps_the_rest(spark):
    target = spark.createDataFrame([(1, hour(0), 1.0, "n", T0), (1, hour(1), 2.0, "m", T0)], FACT)
    batch = spark.createDataFrame([(1, hour(0), 7.0, 0), (1, hour(0), None, 1), (2, hour(0), 3.0, 0)], BATCH)
    once = upsert(target, batch)
    want = [
        (1, hour(0), None, "n", T0),
        (1, hour(1), 2.0, "m", T0),
        (2, hour(0), 3.0, None, NOW),
    ]
    assert rows(once, *target.columns) == sorted(want, key=repr)
    assert rows(upsert(once, batch), *target.columns) == sorted(want, key=repr)


def test_guarded_upsert_does_not_depend_on_batch_order(spark):
    empty = spark.createDataFrame([], "k int, v int, at int")
    batches = [spark.createDataFrame([(1, n, n), (n, n, n)], "k int, v int, at int") for n in (2, 3, 4)]

    def fold(order):
        table = empty
        for b in order:
            table = merge.merge_upsert(table, b, ["k"], ["v", "at"], guard="at")
        return rows(table, "k", "v")

    assert fold(batches) == fold(batches[::-1]) == [(1, 4), (2, 2), (3, 3), (4, 4)]


def test_dim_upsert_numbers_new_rows_only(spark):
    dim = spark.createDataFrame(
        [(5, "a", "x", T0, T0), (9, "b", "y", T0, T0)],
        "id long, name string, city string, created_at timestamp_ntz, updated_at timestamp_ntz",
    )
    batch = spark.createDataFrame([("b", "z"), ("c", "w"), ("d", "v")], "name string, city string")
    kw = dict(id_col="id", now=NOW, created_cols=("created_at",))
    touched = merge.dim_upsert(dim, batch, ["name"], ["city"], touch_cols=("updated_at",), **kw)
    got = {r.name: r for r in touched.collect()}
    assert (got["a"].id, got["a"].updated_at) == (5, T0)
    assert (got["b"].id, got["b"].city, got["b"].created_at, got["b"].updated_at) == (9, "z", T0, NOW)
    assert {got["c"].id, got["d"].id} == {10, 11} and got["c"].created_at == NOW
    again = {r.name: r.id for r in merge.dim_upsert(touched, batch, ["name"], ["city"], **kw).collect()}
    assert again == {n: r.id for n, r in got.items()}


def test_insert_ignore_keeps_the_first_and_is_idempotent(spark):
    table = spark.createDataFrame([(1, "old")], "k int, v string")
    batch = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a")], "k int, v string")
    once = merge.insert_ignore(table, batch, ["k"], first_by=["v"])
    assert rows(once, "k", "v") == [(1, "old"), (2, "a")]
    assert merge.rows_to_insert(once, batch, ["k"], first_by=["v"]).count() == 0


def test_replace_range_is_idempotent_and_rejects_stray_rows(spark):
    schema = "at timestamp_ntz, v int"
    table = spark.createDataFrame([(hour(0), 0), (hour(1), 1), (hour(2), 2)], schema)
    batch = spark.createDataFrame([(hour(1), 10)], schema)
    once = merge.replace_range(table, batch, "at", hour(1), hour(2))
    assert rows(once, "v") == sorted([(0,), (10,), (2,)], key=repr)
    assert rows(merge.replace_range(once, batch, "at", hour(1), hour(2)), "v") == rows(once, "v")
    stray = spark.createDataFrame([(hour(2), 10)], schema)
    with pytest.raises(PySparkException):
        merge.replace_range(table, stray, "at", hour(1), hour(2)).collect()


def test_delete_keeps_rows_where_the_condition_is_null(spark):
    df = spark.createDataFrame([(1,), (None,), (9,)], "v int")
    assert rows(merge.delete_where(df, F.col("v") > 5), "v") == [(1,), (None,)]


def test_one_bad_row_voids_its_entity(spark):
    df = spark.createDataFrame([("a", 1), ("a", 99), ("b", 2)], "k string, v int")
    good, voided = merge.split_atomic(df, ["k"], F.col("v") > 50)
    assert rows(good, "k") == [("b",)] and voided.count() == 2
    none = spark.createDataFrame([(None, 1), (None, 99), ("b", 2)], "k string, v int")
    good, voided = merge.split_atomic(none, ["k"], F.col("v") > 50)
    assert rows(good, "k") == [("b",)] and rows(voided, "v") == [(1,), (99,)]


def test_a_key_listed_twice_is_one_row_of_the_dimension(spark):
    dim = spark.createDataFrame([(1, "a", "old")], "id bigint, k string, v string")
    batch = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("b", "y")], "k string, v string")
    now = dt.datetime(2024, 1, 1)
    once = merge.dim_upsert(dim, batch, ["k"], ["v"], id_col="id", now=now)
    twice = merge.dim_upsert(once, batch, ["k"], ["v"], id_col="id", now=now)
    assert rows(once, "id", "k", "v") == rows(twice, "id", "k", "v") == [(1, "a", "y"), (2, "b", "y")]


# Keys


def test_dense_ids_have_no_gaps(spark):
    new = spark.range(5000).withColumnRenamed("id", "n")
    ids = sorted(r[0] for r in surrogate_ids(new, spark.range(3), "id", ["n"]).select("id").collect())
    assert ids == list(range(3, 5003))
    again = dense_ids(new.repartition(7), "id", ["n"])
    assert rows(dense_ids(new, "id", ["n"]), "n", "id") == rows(again, "n", "id")


@pytest.mark.parametrize(("lowest", "first"), [(None, -2), (-1, -2), (-7, -8)])
def test_placeholders_go_down_in_seed_order(spark, lowest, first):
    known = [("kept", 3)] + ([("held", lowest)] if lowest else [])
    existing = spark.createDataFrame(known, "title string, id long")
    wanted = spark.createDataFrame([(0, "kept"), (1, "z"), (2, "a")], "position int, title string")
    got = placeholder_ids(wanted, existing, "id", ["title"], "position")
    assert rows(got, "title", "id") == [("a", first - 1), ("z", first)]


# Type-2 dimensions

DIM = "id long, k int, title string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean"


def apply(spark, dim, changes, now):
    batch = spark.createDataFrame(changes, "k int, title string")
    return scd2_apply(dim, batch, ["k"], "title", now, id_col="id")


def test_scd2_opens_closes_and_leaves_alone(spark):
    empty = spark.createDataFrame([], DIM)
    first = apply(spark, empty, [(1, "a"), (2, "b")], hour(0))
    second = apply(spark, first, [(1, "a2"), (2, "b"), (3, "c")], hour(1))
    got = rows(second, "k", "title", "valid_from", "valid_to", "is_current")
    assert got == sorted(
        [
            (1, "a", hour(0), hour(1), False),
            (1, "a2", hour(1), None, True),
            (2, "b", hour(0), None, True),
            (3, "c", hour(1), None, True),
        ],
        key=repr,
    )
    ids = [r.id for r in second.collect()]
    assert sorted(ids) == [1, 2, 3, 4]
    again = apply(spark, second, [(1, "a2"), (2, "b"), (3, "c")], hour(2))
    assert rows(again, *second.columns) == rows(second, *second.columns)


def test_history_equals_folding_the_changes(spark):
    rng = random.Random(5)
    steps = 6
    changes = [
        (k, rng.choice("ab"), T0 + dt.timedelta(days=3 * s)) for s in range(steps) for k in range(4) if rng.random() < 0.7
    ]
    dim = spark.createDataFrame([], DIM)
    for s in range(steps):
        at = T0 + dt.timedelta(days=3 * s)
        batch = [(k, v) for k, v, t in changes if t == at]
        if batch:
            folded = apply(spark, dim, batch, at).collect()
            dim = spark.createDataFrame(folded, DIM)
    history = scd2_history(
        spark.createDataFrame(changes, "k int, title string, ts timestamp_ntz"), ["k"], "title", "ts"
    )
    columns = ("k", "title", "valid_from", "valid_to", "is_current")
    assert rows(history, *columns) == rows(dim, *columns)
    assert dim.filter("is_current").groupBy("k").count().filter("count > 1").count() == 0
