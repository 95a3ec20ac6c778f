"""Read models: what a dashboard or a lookup shows, as DataFrames."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions.text import inner_or_self, preview, same_ignoring_case
from strataflow.functions.times import days_before
from strataflow.operators.pick import first_n_per_key, latest_n_per_key, latest_per_key, newest_first, top_rows
from strataflow.operators.shape import optional
from strataflow.schemas import MEASURES, PAGE_SUMMARY

# Row limits of the location view and of the city report.
OBSERVATION_LIMIT = 200
REPORT_HOURS = 24
VERIFY_ROWS = 5

LOCATION_COLUMNS = (
    "location_id",
    "location_name",
    "city",
    "region",
    "country",
    "latitude",
    "longitude",
    "created_at",
)


def list_locations(location: DataFrame) -> DataFrame:
    """One location per name, the newest, by name."""
    newest = latest_per_key(location, ["location_name"], "created_at", ["location_id"])
    return newest.select(*LOCATION_COLUMNS).orderBy("location_name")


def location_info(location: DataFrame, location_id: int) -> DataFrame:
    return location.filter(F.col("location_id") == location_id).select(
        "location_name", "city", "region", "country", "latitude", "longitude"
    )


def recent_observations(
    weather: DataFrame, as_of: dt.date, *, location_id: int | None = None, limit: int | None = OBSERVATION_LIMIT
) -> DataFrame:
    """Hours from the day before `as_of` on, oldest first, of each location at most `limit`; measures the table lacks come as NULL."""
    rows = weather.filter(F.col("observed_at") >= days_before(as_of, 1))
    if "obs_month" in weather.columns:
        first_month = (as_of - dt.timedelta(days=1)).replace(day=1)
        rows = rows.filter(F.col("obs_month") >= F.lit(first_month))
    if location_id is not None:
        rows = rows.filter(F.col("location_id") == location_id)
    measures = [optional(rows, m, "decimal(5,2)") for m in MEASURES]
    hours = rows.select("location_id", "observed_at", *measures)
    if limit is not None:
        order = [F.col(c).asc_nulls_last() for c in ("observed_at", *MEASURES)]
        hours = first_n_per_key(hours, ["location_id"], order, limit)
    return hours.orderBy("observed_at", "location_id")


def weather_stats(weather: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Count and averages of all hours, or of each group."""
    exact = lambda c: F.sum(c).cast("double") / F.count(c)
    return weather.groupBy(*by).agg(
        F.count(F.lit(1)).alias("count"),
        exact("temperature_celsius").alias("avg_temp"),
        F.min("temperature_celsius").alias("min_temp"),
        F.max("temperature_celsius").alias("max_temp"),
        exact("humidity_percent").alias("avg_humidity"),
        exact("wind_speed_mps").alias("avg_wind"),
    )


def location_weather(
    location: DataFrame, weather: DataFrame, location_id: int, as_of: dt.date
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(location info, recent observations, stats over all its hours) of one location."""
    mine = weather.filter(F.col("location_id") == location_id)
    return (
        location_info(location, location_id),
        recent_observations(mine, as_of, location_id=location_id),
        weather_stats(mine),
    )


def list_pages(page: DataFrame) -> DataFrame:
    """Current page versions by title."""
    return (
        page.filter("is_current")
        .select("page_id", "wikipedia_page_id", "page_title", "page_language", "valid_from", "is_current")
        .orderBy("page_title", "page_id")
    )


def with_document(raw: DataFrame) -> DataFrame:
    """Raw pages with the summary fields of the payload, parsed once, as `doc`."""
    return raw.withColumn("doc", F.from_json("payload", PAGE_SUMMARY))


def page_summary() -> list[Column]:
    """The summary columns of `doc`; the thumbnail may be an object or a plain text."""
    return [
        F.col("doc.title").alias("title"),
        F.col("doc.extract").alias("extract"),
        F.col("doc.content_urls.desktop.page").alias("url"),
        inner_or_self(F.col("doc.thumbnail"), "source").alias("thumbnail"),
        F.col("doc.description").alias("description"),
    ]


def page_details(page: DataFrame, raw: DataFrame, revision: DataFrame) -> DataFrame:
    """Every current page with its newest summary (title matched ignoring case) and its revision count."""
    newest = latest_per_key(
        raw.select(F.lower("page_title").alias("__title"), "payload", "ingested_at", "id"),
        ["__title"],
        "ingested_at",
        ["id"],
    )
    summaries = with_document(newest).select("__title", *page_summary(), F.col("ingested_at").alias("fetched_at"))
    counts = revision.groupBy("page_id").agg(F.count(F.lit(1)).alias("revision_count"))
    pages = page.filter("is_current").select("page_id", "page_title", "page_language", "wikipedia_page_id")
    return (
        pages.withColumn("__title", F.lower("page_title"))
        .join(summaries, "__title", "left")
        .join(counts, "page_id", "left")
        .drop("__title")
        .withColumn("revision_count", F.coalesce("revision_count", F.lit(0)))
    )


def page_detail(page: DataFrame, raw: DataFrame, revision: DataFrame, page_id: int) -> DataFrame:
    """One page. The id reaches the scans of pages and revisions; raw payloads are read, but only those with
    the page's title are dealt by it."""
    mine = page.filter((F.col("page_id") == page_id) & F.col("is_current"))
    titles = mine.select(F.lower("page_title").alias("__wanted")).distinct()
    own = raw.join(titles, F.lower(raw["page_title"]) == titles["__wanted"], "left_semi")
    return page_details(mine, own, revision.filter(F.col("page_id") == page_id))


def summary_by_title(raw: DataFrame, title: str, *, ignore_case: bool = True) -> DataFrame:
    """The newest payload summary for a title."""
    wanted = F.lit(title)
    match = same_ignoring_case(F.col("page_title"), wanted) if ignore_case else F.col("page_title") == wanted
    newest = top_rows(raw.filter(match), newest_first("ingested_at", ["id"]), 1)
    return with_document(newest).select(
        *page_summary(), F.col("doc.pageid").alias("pageid"), F.col("ingested_at").alias("fetched_at")
    )


def dashboard_stats(location: DataFrame, weather: DataFrame, page: DataFrame) -> DataFrame:
    """One row: locations, weather observations, current pages, latest observation."""
    none = F.lit(None).cast("timestamp_ntz")
    parts = (
        location.agg(F.lit("l").alias("k"), F.count(F.lit(1)).alias("n"), none.alias("t")),
        weather.agg(F.lit("w").alias("k"), F.count(F.lit(1)).alias("n"), F.max("observed_at").alias("t")),
        page.filter("is_current").agg(F.lit("p").alias("k"), F.count(F.lit(1)).alias("n"), none.alias("t")),
    )
    lines = parts[0].unionByName(parts[1]).unionByName(parts[2])

    def of(kind: str) -> Column:
        return F.max(F.when(F.col("k") == kind, F.col("n")))

    return lines.agg(
        of("l").alias("locations"),
        of("w").alias("weather_observations"),
        of("p").alias("wikipedia_pages"),
        F.max("t").alias("latest_weather"),
    )


def latest_hours(weather: DataFrame, n: int = REPORT_HOURS) -> DataFrame:
    """The newest n hours of every location."""
    return latest_n_per_key(weather, ["location_id"], "observed_at", n).select(
        "location_id", "observed_at", "temperature_celsius", "humidity_percent", "wind_speed_mps"
    )


def newest_location(location: DataFrame, name: str) -> DataFrame:
    """The location of that name with the highest id."""
    return top_rows(location.filter(F.col("location_name") == name), [F.col("location_id").desc()], 1)


def city_hours(location: DataFrame, weather: DataFrame, hours: int = REPORT_HOURS) -> DataFrame:
    """The newest hours of every location name: of several locations of one name the highest id counts."""
    places = location.groupBy("location_name").agg(F.max("location_id").alias("location_id"))
    return latest_hours(weather, hours).join(places, "location_id").drop("location_id")


def city_report(
    location: DataFrame, weather: DataFrame, raw_pages: DataFrame, name: str, hours: int = REPORT_HOURS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(location, its newest hours, its page summary with a shortened extract) of a city."""
    place = newest_location(location, name)
    mine = weather.join(place.select("location_id"), "location_id", "left_semi")
    observations = top_rows(mine, [F.col("observed_at").desc()], hours).select(
        "observed_at", "temperature_celsius", "humidity_percent", "wind_speed_mps"
    )
    summary = summary_by_title(raw_pages, name, ignore_case=False)
    return place, observations, summary.withColumn("extract", preview(F.col("extract")))
