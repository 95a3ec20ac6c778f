"""The analyst queries over raw, core and mart tables. Every date is a parameter."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow import schemas
from strataflow.functions.numbers import ratio, round_numeric
from strataflow.functions.text import json_kind, json_text
from strataflow.functions.times import days_before, hour_of, on_day, within
from strataflow.operators.aggregate import count_if, duplicate_keys, span
from strataflow.operators.pick import newest_first, rows_at_max, top_rows

def count_rows(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def exact_avg(name: str) -> Column:
    """Average of a decimal column from its exact sum."""
    return F.sum(name).cast("double") / F.count(name)


# Dimensions and raw tables


def location_names(location: DataFrame) -> DataFrame:
    return location.select("location_name", "city", "country").orderBy("location_name")


def current_titles(page: DataFrame) -> DataFrame:
    return page.filter("is_current").select("page_title", "page_language").orderBy("page_title")


def locations_to_process(location: DataFrame) -> DataFrame:
    return location.select(*schemas.LOCATION_KEY).orderBy("location_name")


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    return df.agg(count_rows(name))


def weather_payload_peek(raw: DataFrame) -> DataFrame:
    """Payload type and first timestamp per raw row, newest first."""
    return raw.select(
        "location_name",
        "ingested_at",
        json_kind(F.col("payload")).alias("has_payload"),
        json_text(F.col("payload"), "hourly", "time", 0).alias("first_timestamp"),
    ).orderBy(F.col("ingested_at").desc_nulls_first())


def page_payload_peek(raw: DataFrame) -> DataFrame:
    return raw.select(
        "page_title",
        "revision_id",
        "ingested_at",
        "revision_size_bytes",
        json_kind(F.col("payload")).alias("has_payload"),
    ).orderBy(F.col("ingested_at").desc_nulls_first())


def newest_payloads(raw: DataFrame, n: int = 5) -> DataFrame:
    newest = top_rows(raw, newest_first("ingested_at", ["id"]), n)
    return newest.select("location_name", "ingested_at", "payload")


def raw_freshness(raw: DataFrame, location_name: str | None = None) -> DataFrame:
    """Raw rows and latest load per location."""
    if location_name is not None:
        raw = raw.filter(F.col("location_name") == location_name)
    return (
        raw.groupBy("location_name")
        .agg(count_rows("raw_count"), F.max("ingested_at").alias("latest_ingest"))
        .orderBy("location_name")
    )


def labelled_counts(tables: Sequence[tuple[str, DataFrame, str]], label: str = "layer") -> DataFrame:
    """Row count and latest timestamp (as text) of each (label, table, column), one line per table."""
    lines = [
        df.agg(
            F.lit(name).alias(label),
            count_rows("row_count"),
            F.max(column).cast("string").alias("latest_timestamp"),
        )
        for name, df, column in tables
    ]
    out = lines[0]
    for line in lines[1:]:
        out = out.unionByName(line)
    return out


def lineage_check(
    raw_weather: DataFrame,
    raw_pages: DataFrame,
    weather: DataFrame,
    revision: DataFrame,
    daily_weather: DataFrame,
    daily_pages: DataFrame,
    day: dt.date,
) -> DataFrame:
    """Rows and freshness of each layer for one day: raw to core to mart."""
    return labelled_counts(
        [
            ("Raw Weather", raw_weather, "ingested_at"),
            ("Raw Wikipedia", raw_pages, "ingested_at"),
            ("Core Weather Facts", weather.filter(on_day(F.col("observed_at"), day)), "created_at"),
            ("Core Revision Facts", revision.filter(on_day(F.col("fetched_at"), day)), "fetched_at"),
            ("Mart Weather Aggregates", _mart_day(daily_weather, "observation_date", day), "observation_date"),
            ("Mart Wikipedia Stats", _mart_day(daily_pages, "revision_date", day), "revision_date"),
        ]
    )


# Core facts


def _weather_day(weather: DataFrame, day: dt.date) -> DataFrame:
    rows = weather.filter(on_day(F.col("observed_at"), day))
    return rows.filter(F.col("obs_month") == F.lit(day.replace(day=1))) if "obs_month" in weather.columns else rows


def weather_on_day(weather: DataFrame, location: DataFrame, day: dt.date) -> DataFrame:
    """Hours of one day per location, averages rounded to two digits.

    The day is aggregated per location id first; the join then sees one row per id.
    """
    measures = {
        "temperature_celsius": "avg_temp_c",
        "humidity_percent": "avg_humidity_pct",
        "wind_speed_mps": "avg_wind_mps",
    }
    partial, merged = [count_rows("n")], [F.sum("n").alias("observation_count")]
    partial += [F.min("observed_at").alias("lo"), F.max("observed_at").alias("hi")]
    merged += [F.min("lo").alias("first_observation"), F.max("hi").alias("last_observation")]
    for source, name in measures.items():
        partial += [F.sum(source).alias(f"s_{name}"), F.count(source).alias(f"n_{name}")]
        merged.append(F.round(ratio(F.sum(f"s_{name}"), F.sum(f"n_{name}")), 2).alias(name))
    by_id = _weather_day(weather, day).groupBy("location_id").agg(*partial)
    named = by_id.join(location.select("location_id", "location_name", "city"), "location_id")
    return named.groupBy("location_name", "city").agg(*merged).orderBy("location_name")


def revisions_on_day(revision: DataFrame, page: DataFrame, day: dt.date) -> DataFrame:
    """Revisions fetched on one day per current page."""
    by_id = (
        revision.filter(on_day(F.col("fetched_at"), day))
        .groupBy("page_id")
        .agg(
            count_rows("n"),
            F.min("fetched_at").alias("lo"),
            F.max("fetched_at").alias("hi"),
            F.sum("content_len").alias("total"),
            F.count("content_len").alias("sized"),
        )
    )
    named = by_id.join(page.filter("is_current").select("page_id", "page_title"), "page_id")
    return (
        named.groupBy("page_title")
        .agg(
            F.sum("n").alias("revision_count"),
            F.min("lo").alias("first_fetch"),
            F.max("hi").alias("last_fetch"),
            F.sum("total").alias("total_bytes"),
            round_numeric(ratio(F.sum("total"), F.sum("sized")), 0).alias("avg_content_bytes"),
        )
        .orderBy("page_title")
    )


def duplicate_observations(weather: DataFrame, day: dt.date | None = None) -> DataFrame:
    """(location, time) pairs that occur more than once; none in a sound fact."""
    rows = weather if day is None else _weather_day(weather, day)
    return duplicate_keys(rows, schemas.WEATHER_KEY)


def range_violations(weather: DataFrame, day: dt.date | None = None) -> DataFrame:
    """Rows and out-of-range rows per check, from one pass over the fact."""
    rows = weather if day is None else _weather_day(weather, day)
    checks = (
        ("Temperature range check", "temperature_celsius", schemas.TEMPERATURE_RANGE),
        ("Humidity range check", "humidity_percent", schemas.HUMIDITY_RANGE),
    )
    totals = rows.agg(
        count_rows("n"),
        *[
            count_if((F.col(c) < low) | (F.col(c) > high)).alias(f"bad_{c}")
            for _, c, (low, high) in checks
        ],
    )
    lines = [
        F.struct(F.lit(name).alias("check_name"), F.col("n").alias("violations"), F.col(f"bad_{c}").alias("out_of_range"))
        for name, c, _ in checks
    ]
    return totals.select(F.inline(F.array(*lines)))


def temperature_outliers(weather: DataFrame, bounds: tuple[float, float] = schemas.TEMPERATURE_RANGE) -> DataFrame:
    low, high = bounds
    t = F.col("temperature_celsius")
    return (
        weather.filter((t < low) | (t > high))
        .select("location_id", "observed_at", "temperature_celsius")
        .orderBy(F.col("observed_at").desc())
    )


def daily_counts(weather: DataFrame, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """Rows and distinct locations per day in a half-open range.

    Counted per (day, location) first, so no task holds all rows of a day.
    """
    rows = weather.filter(within(F.col("observed_at"), start, end))
    if "obs_month" in weather.columns:
        rows = rows.filter(
            (F.col("obs_month") >= F.lit(start.date().replace(day=1))) & (F.col("obs_month") <= F.lit(end.date()))
        )
    per_location = rows.groupBy(F.to_date("observed_at").alias("date"), "location_id").agg(count_rows("n"))
    return (
        per_location.groupBy("date")
        .agg(F.sum("n").alias("observation_count"), F.count("location_id").alias("location_count"))
        .orderBy("date")
    )


def loaded_by_date(weather: DataFrame, start: dt.datetime, end: dt.datetime) -> DataFrame:
    return daily_counts(weather, start, end).select("date", F.col("observation_count").alias("count"))


def runs_per_day(raw: DataFrame) -> DataFrame:
    """Loads and distinct load hours per day."""
    per_hour = raw.groupBy(hour_of(F.col("ingested_at")).alias("hour")).agg(count_rows("n"))
    return (
        per_hour.groupBy(F.to_date("hour").alias("run_date"))
        .agg(F.sum("n").alias("run_count"), F.count("hour").alias("distinct_hours"))
        .orderBy(F.col("run_date").desc())
    )


def fact_span(weather: DataFrame, location: DataFrame, location_name: str | None = None) -> DataFrame:
    """Rows, first and last hour per location name."""
    dim = location.select("location_id", "location_name")
    if location_name is not None:
        dim = dim.filter(F.col("location_name") == location_name)
        weather = weather.join(dim.select("location_id"), "location_id", "left_semi")
    by_id = span(weather, ["location_id"], "observed_at", n="n", first="lo", last="hi")
    return (
        by_id.join(dim, "location_id")
        .groupBy("location_name")
        .agg(F.sum("n").alias("fact_count"), F.min("lo").alias("first_obs"), F.max("hi").alias("last_obs"))
        .orderBy("location_name")
    )


def latest_observations(weather: DataFrame, location: DataFrame) -> DataFrame:
    """Rows at the newest time of each location, with its name."""
    newest = rows_at_max(weather, ["location_id"], "observed_at")
    return (
        newest.join(location.select("location_id", "location_name"), "location_id")
        .select("location_name", "observed_at", "temperature_celsius", "humidity_percent", "wind_speed_mps")
        .orderBy("location_name")
    )


# Marts


def _mart_day(mart: DataFrame, date_col: str, day: dt.date) -> DataFrame:
    return mart.filter(F.col(date_col) == F.lit(day))


def weather_mart_day(mart: DataFrame, day: dt.date) -> DataFrame:
    return (
        _mart_day(mart, "observation_date", day)
        .select(
            "location_name",
            "city",
            "country",
            "observation_date",
            "observation_count",
            round_numeric(F.col("avg_temperature_celsius"), 2).alias("avg_temp_c"),
            round_numeric(F.col("min_temperature_celsius"), 2).alias("min_temp_c"),
            round_numeric(F.col("max_temperature_celsius"), 2).alias("max_temp_c"),
            round_numeric(F.col("avg_humidity_percent"), 2).alias("avg_humidity_pct"),
            "most_common_conditions",
        )
        .orderBy("location_name")
    )


def page_mart_day(mart: DataFrame, day: dt.date) -> DataFrame:
    return (
        _mart_day(mart, "revision_date", day)
        .select(
            "page_title",
            "page_language",
            "revision_date",
            "revision_count",
            "unique_editors",
            "total_bytes_changed",
            round_numeric(F.col("avg_bytes_per_revision"), 0).alias("avg_bytes_per_rev"),
        )
        .orderBy("page_title")
    )


def warmest_first(mart: DataFrame, day: dt.date) -> DataFrame:
    return (
        _mart_day(mart, "observation_date", day)
        .select(
            "location_name",
            "observation_count",
            "avg_temperature_celsius",
            "avg_humidity_percent",
            "avg_wind_speed_kmh",
            "most_common_conditions",
        )
        .orderBy(F.col("avg_temperature_celsius").desc_nulls_first())
    )


def most_active_pages(mart: DataFrame, day: dt.date | None = None) -> DataFrame:
    """Pages by revisions, then bytes, with the safe average size."""
    rows = mart if day is None else _mart_day(mart, "revision_date", day)
    average = ratio(F.col("total_bytes_changed").cast("decimal(38,6)"), F.col("revision_count"))
    return rows.select(
        "page_title",
        "revision_count",
        "unique_editors",
        "total_bytes_changed",
        F.round(average, 0).alias("avg_bytes_per_revision"),
    ).orderBy(
        F.col("revision_count").desc_nulls_first(), F.col("total_bytes_changed").desc_nulls_first(), "page_title"
    )


def temperature_ranges(mart: DataFrame, day: dt.date | None = None) -> DataFrame:
    """Max minus min temperature per location, widest first."""
    rows = mart if day is None else _mart_day(mart, "observation_date", day)
    return rows.select(
        "location_name",
        "min_temperature_celsius",
        "max_temperature_celsius",
        F.round(F.col("max_temperature_celsius") - F.col("min_temperature_celsius"), 2).alias("temperature_range"),
        "avg_temperature_celsius",
    ).orderBy(F.col("temperature_range").desc_nulls_first(), "location_name")


def newest_mart_rows(mart: DataFrame, n: int = 10) -> DataFrame:
    return top_rows(mart, [F.col("observation_date").desc(), F.col("location_name").asc()], n).select(
        "location_name",
        "observation_date",
        "observation_count",
        round_numeric(F.col("avg_temperature_celsius"), 2).alias("avg_temp"),
    )


def mart_spans(daily_weather: DataFrame, daily_pages: DataFrame) -> DataFrame:
    """Row count and date span of both marts."""

    def line(df: DataFrame, name: str, date_col: str) -> DataFrame:
        return df.agg(
            F.lit(name).alias("view_name"),
            count_rows("row_count"),
            F.min(date_col).alias("min_date"),
            F.max(date_col).alias("max_date"),
        )

    return line(daily_weather, "daily_weather_aggregates", "observation_date").unionByName(
        line(daily_pages, "daily_wikipedia_page_stats", "revision_date")
    )


def locations_per_day(mart: DataFrame, as_of: dt.date, days: int = 7) -> DataFrame:
    """Mart rows per day over a trailing window, newest first."""
    return (
        mart.filter(F.col("observation_date") >= days_before(as_of, days).cast("date"))
        .groupBy("observation_date")
        .agg(count_rows("location_count"))
        .orderBy(F.col("observation_date").desc())
    )


def mart_history(mart: DataFrame, location_name: str | None = None) -> DataFrame:
    """Mart rows of one location, newest first, or of all by name."""
    if location_name is not None:
        return mart.filter(F.col("location_name") == location_name).orderBy(F.col("observation_date").desc())
    return mart.orderBy("location_name", F.col("observation_date").desc())
