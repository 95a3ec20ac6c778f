import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strataflow.functions import numbers, text, times

DAY = dt.datetime(2024, 11, 8)

ISO = [
    ("2024-11-08T00:00", DAY),
    ("2024-11-08T00:00Z", DAY),
    ("2024-11-08 01:02:03.5", DAY + dt.timedelta(hours=1, minutes=2, seconds=3.5)),
    ("2024-11-08T01:00+05:30", DAY - dt.timedelta(hours=4, minutes=30)),
    ("2024-11-08T01:00:00-02:00", DAY + dt.timedelta(hours=3)),
    ("2024-11-08", DAY),
    ("2024", None),
    ("2024-11", None),
    ("2024-13-01", None),
    (" 2024-11-08", None),
    ("soon", None),
    ("", None),
    (None, None),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_iso_times_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(s,) for s, _ in ISO], "s string")
        parsed = df.select(times.iso_to_utc(F.col("s")).cast("string").alias("t")).collect()
        want = [None if w is None else w.isoformat(sep=" ") for _, w in ISO]
        assert [None if r.t is None else dt.datetime.fromisoformat(r.t).isoformat(sep=" ") for r in parsed] == want
        # 02:30 on this day does not exist in New York.
        gap = spark.sql("select timestamp_ntz'2024-03-10 02:30:00' as t")
        row = gap.select(times.hour_of(F.col("t")).cast("string"), times.month_of(F.col("t")).cast("string")).first()
        assert tuple(row) == ("2024-03-10 02:00:00", "2024-03-01")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_fallback_for_unreadable_times(spark):
    df = spark.createDataFrame([("x",), ("2024-11-08T00:00Z",)], "s string")
    rows = df.select(times.iso_or(F.col("s"), times.ntz(dt.datetime(2025, 1, 1))).alias("t")).collect()
    assert [r.t for r in rows] == [dt.datetime(2025, 1, 1), DAY]


def test_months_touched():
    start, end = dt.datetime(2024, 11, 30), dt.datetime(2025, 1, 1)
    assert times.months_touched(start, end) == [dt.date(2024, 11, 1), dt.date(2024, 12, 1)]
    assert times.months_touched(end, end + dt.timedelta(seconds=1)) == [dt.date(2025, 1, 1)]


def test_units_and_rounding(spark):
    df = spark.sql("select 12.5D as wind, 0D as c, 999.995D as big, -1.005D as neg, 7 as a, 0 as b")
    row = df.select(
        numbers.narrow(numbers.kmh_to_mps(F.col("wind"))).alias("mps"),
        numbers.celsius_to_fahrenheit(F.col("c")).alias("f"),
        numbers.narrow(F.col("big")).alias("overflow"),
        numbers.round_numeric(F.col("neg"), 2).alias("rounded"),
        numbers.ratio(F.col("a"), F.col("b")).alias("ratio"),
    ).first()
    assert row.mps == Decimal("3.47")
    assert (row.f, row.overflow, row.rounded, row.ratio) == (32.0, None, -1.01, None)


def test_json_and_text(spark):
    docs = [
        ('{"t": {"source": "a"}, "namespace": {"id": 4}}', "a", 4, "object"),
        ('{"t": "b", "namespace": 2}', "b", 2, "object"),
        ('{"x": [1]}', None, 0, "object"),
        (' [1]', None, 0, "array"),
        ('"s"', None, 0, "string"),
        ("12", None, 0, "number"),
        ("true", None, 0, "boolean"),
        ("null", None, 0, "null"),
        (None, None, 0, None),
    ]
    df = spark.createDataFrame([(d[0],) for d in docs], "p string")
    p = F.col("p")
    rows = df.select(
        text.json_inner_or_self(p, "t", "source"),
        text.namespace_id(text.json_text(p, "namespace")),
        text.json_kind(p),
    ).collect()
    assert [tuple(r) for r in rows] == [d[1:] for d in docs]


def test_names_and_previews(spark):
    df = spark.createDataFrame([("St. Louis", "", None, "x" * 501)], "title string, a string, b string, long string")
    row = df.select(
        text.slug(F.col("title")),
        text.first_filled(F.col("a"), F.col("b"), F.col("title")),
        text.join_filled(", ", F.col("title"), F.col("a"), F.col("b")),
        F.length(text.preview(F.col("long"))),
        text.utf8_bytes(F.lit("é")),
    ).first()
    assert tuple(row) == ("St._Louis", "St. Louis", "St. Louis", 503, 2)
