"""Daily marts.

Both marts aggregate the fact by its own key first and join the dimension to
the reduced rows, so a hot location or page is combined before any shuffle and
the join moves one row per key, day and value instead of every fact row.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataflow.functions.numbers import mean, mps_to_kmh
from strataflow.operators.aggregate import mode_of
from strataflow.operators.merge import merge_upsert

WEATHER_GRAIN = ("location_name", "city", "country", "observation_date")
PAGE_GRAIN = ("page_title", "page_language", "revision_date")


AVERAGED = ("temperature_celsius", "humidity_percent", "pressure_hpa", "wind_speed_mps")


def weather_days(weather: DataFrame) -> DataFrame:
    """The fact summed up per location, day and conditions. Rows of one key can be added up, so parts can be merged."""
    partial = [F.count(F.lit(1)).alias("n")]
    for name in AVERAGED:
        partial += [F.sum(name).alias(f"sum_{name}"), F.count(name).alias(f"n_{name}")]
    partial += [F.min("temperature_celsius").alias("lo"), F.max("temperature_celsius").alias("hi")]
    return weather.groupBy("location_id", F.to_date("observed_at").alias("observation_date"), "conditions").agg(*partial)


def weather_mart_of(days: DataFrame, location: DataFrame) -> DataFrame:
    """The weather mart from stored days: names joined, days of locations that share a name merged."""
    merged = [F.sum("n").alias("n")]
    for name in AVERAGED:
        merged += [F.sum(f"sum_{name}").alias(f"sum_{name}"), F.sum(f"n_{name}").alias(f"n_{name}")]
    merged += [F.min("lo").alias("lo"), F.max("hi").alias("hi")]
    named = days.join(location.select("location_id", "location_name", "city", "country"), "location_id")
    # One shuffle and one sort by the grain serve both the count per condition and the rest, which then pass as a stream.
    dealt = named.repartition(*WEATHER_GRAIN)
    of_condition = F.sum("n").over(Window.partitionBy(*WEATHER_GRAIN, "conditions"))
    daily = mode_of(dealt.withColumn("n_conditions", of_condition), WEATHER_GRAIN, "conditions", "n_conditions", merged)
    return daily.select(
        *WEATHER_GRAIN,
        F.col("n").alias("observation_count"),
        mean(F.col("sum_temperature_celsius"), F.col("n_temperature_celsius")).alias("avg_temperature_celsius"),
        F.col("lo").alias("min_temperature_celsius"),
        F.col("hi").alias("max_temperature_celsius"),
        mean(F.col("sum_humidity_percent"), F.col("n_humidity_percent")).alias("avg_humidity_percent"),
        mean(F.col("sum_pressure_hpa"), F.col("n_pressure_hpa")).alias("avg_pressure_hpa"),
        # Converted once per day; the sum is exact, so this equals converting every hour.
        mean(mps_to_kmh(F.col("sum_wind_speed_mps")), F.col("n_wind_speed_mps")).alias("avg_wind_speed_kmh"),
        F.col("conditions").alias("most_common_conditions"),
    )


def daily_weather_aggregates(weather: DataFrame, location: DataFrame) -> DataFrame:
    """Per location and day: row count, temperature avg/min/max, other averages, most common conditions."""
    return weather_mart_of(weather_days(weather), location)


def page_days(revision: DataFrame) -> DataFrame:
    """The revisions summed up per page, day and editor. Rows of one key can be added up, so parts can be merged."""
    return revision.groupBy("page_id", F.to_date("revision_timestamp").alias("revision_date"), "revision_user").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("content_len").alias("total"),
        F.count("content_len").alias("sized"),
        F.min("content_len").alias("lo"),
        F.max("content_len").alias("hi"),
    )


def merged_page_days(days: DataFrame) -> DataFrame:
    """Stored days and those of new revisions as one row per page, day and editor."""
    return days.groupBy("page_id", "revision_date", "revision_user").agg(
        F.sum("n").alias("n"),
        F.sum("total").alias("total"),
        F.sum("sized").alias("sized"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
    )


def page_mart_of(days: DataFrame, page: DataFrame) -> DataFrame:
    """The page mart from stored days."""
    named = days.join(page.select("page_id", "page_title", "page_language"), "page_id")
    return (
        named.groupBy(*PAGE_GRAIN)
        .agg(
            F.sum("n").alias("revision_count"),
            F.count_distinct("revision_user").alias("unique_editors"),
            F.sum("total").alias("total_bytes_changed"),
            F.sum("sized").alias("sized"),
            F.min("lo").alias("min_revision_size"),
            F.max("hi").alias("max_revision_size"),
        )
        .select(
            *PAGE_GRAIN,
            "revision_count",
            "unique_editors",
            "total_bytes_changed",
            mean(F.col("total_bytes_changed"), F.col("sized")).alias("avg_bytes_per_revision"),
            "min_revision_size",
            "max_revision_size",
        )
    )


def daily_page_stats(revision: DataFrame, page: DataFrame, current_only: bool = False) -> DataFrame:
    """Per page title, language and day: revisions, distinct editors, and sum/avg/min/max of the size."""
    if current_only:
        page = page.filter("is_current")
    return page_mart_of(page_days(revision), page)


def refresh_dates(mart: DataFrame, recomputed: DataFrame, date_col: str, first: dt.date) -> DataFrame:
    """Mart after a refresh of all days from `first` on: older days stay, later ones are the recomputed rows."""
    return mart.filter(F.col(date_col) < F.lit(first)).unionByName(recomputed.select(*mart.columns))


def refresh_keys(mart: DataFrame, recomputed: DataFrame, grain: Iterable[str]) -> DataFrame:
    """Mart after an upsert of the recomputed rows on its full grain."""
    grain = list(grain)
    rest = [c for c in mart.columns if c not in grain]
    return merge_upsert(mart, recomputed, grain, rest)
