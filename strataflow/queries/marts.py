"""Daily marts and aggregates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.functions.times import ntz
from strataflow.operators import aggregate
from strataflow.operators.keys import surrogate_ids
from strataflow.operators.ordered import with_closest
from strataflow.operators.scd import scd2_history
from strataflow.plans import marts, reads, reports
from strataflow.queries import bind
from strataflow.registry import Tables, query
from strataflow.session import stage

WEATHER = (bind.FACT, bind.LOCATION, bind.WEATHER_MART)
PAGES = (bind.REVISION, bind.PAGE, bind.PAGE_MART)
EXTREMES = ("min_temperature_celsius", "max_temperature_celsius")


def weather_mart(t: Tables) -> DataFrame:
    return bind.doubles(marts.daily_weather_aggregates(bind.fact(t), bind.location(t)), *EXTREMES)


def page_mart(t: Tables) -> DataFrame:
    return marts.daily_page_stats(bind.revision(t), bind.page(t))


@query(bind.sql(*WEATHER, body="SELECT * FROM weather_mart"))
def daily_weather_aggregates(t: Tables) -> DataFrame:
    return weather_mart(t)


@query(bind.sql(*PAGES, body="SELECT * FROM page_mart"))
def daily_page_stats(t: Tables) -> DataFrame:
    return page_mart(t)


@query(
    bind.sql(
        bind.REVISION,
        "all_pages AS (SELECT c_custkey AS page_id, c_mktsegment AS page_title, n_name AS page_language,"
        " c_acctbal >= 0 AS is_current FROM customer JOIN nation ON c_nationkey = n_nationkey)",
        "page AS (SELECT * FROM all_pages WHERE is_current)",
        bind.PAGE_MART,
        body="SELECT * FROM page_mart",
    )
)
def daily_page_stats_current(t: Tables) -> DataFrame:
    return marts.daily_page_stats(bind.revision(t), bind.page(t), current_only=True)


@query("""
SELECT l_suppkey, l_returnflag FROM (
  SELECT l_suppkey, l_returnflag, COUNT(*) AS n FROM lineitem GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_returnflag) = 1
""")
def mode_per_group(t: Tables) -> DataFrame:
    return aggregate.mode_per_group(t.lineitem, ["l_suppkey"], "l_returnflag")


# A refresh of all days from this one on.
REFRESH_FROM = dt.date(2024, 1, 15)


@query(bind.sql(*WEATHER, body="SELECT * FROM weather_mart"))
def mart_incremental_refresh(t: Tables) -> DataFrame:
    """A mart that stops in the middle of a day, brought up to date from REFRESH_FROM on."""
    fact, location = bind.fact(t), bind.location(t)
    stale = marts.daily_weather_aggregates(
        fact.filter(F.col("observed_at") < ntz(dt.datetime(2024, 1, 20, 12))), location
    )
    first = dt.datetime.combine(REFRESH_FROM, dt.time())
    recomputed = marts.daily_weather_aggregates(fact.filter(F.col("observed_at") >= ntz(first)), location)
    refreshed = marts.refresh_dates(stale, recomputed, "observation_date", REFRESH_FROM)
    return bind.doubles(refreshed, *EXTREMES)


@query(bind.sql(*WEATHER, body="SELECT * FROM weather_mart"))
def mart_key_refresh(t: Tables) -> DataFrame:
    """The same, as an upsert of the recomputed rows on the mart's full grain."""
    fact, location = bind.fact(t), bind.location(t)
    stale = marts.daily_weather_aggregates(
        fact.filter(F.col("observed_at") < ntz(dt.datetime(2024, 1, 20, 12))), location
    )
    first = dt.datetime.combine(REFRESH_FROM, dt.time())
    recomputed = marts.daily_weather_aggregates(fact.filter(F.col("observed_at") >= ntz(first)), location)
    return bind.doubles(marts.refresh_keys(stale, recomputed, marts.WEATHER_GRAIN), *EXTREMES)


@query(
    bind.sql(
        bind.FACT,
        body="""
SELECT location_id, COUNT(*) AS count,
       CAST(SUM(temperature_celsius) AS DOUBLE) / COUNT(temperature_celsius) AS avg_temp,
       CAST(MIN(temperature_celsius) AS DOUBLE) AS min_temp, CAST(MAX(temperature_celsius) AS DOUBLE) AS max_temp,
       CAST(SUM(humidity_percent) AS DOUBLE) / COUNT(humidity_percent) AS avg_humidity,
       CAST(SUM(wind_speed_mps) AS DOUBLE) / COUNT(wind_speed_mps) AS avg_wind
FROM fact GROUP BY location_id""",
    )
)
def entity_summary(t: Tables) -> DataFrame:
    return bind.doubles(reads.weather_stats(bind.fact(t), ["location_id"]), "min_temp", "max_temp")


@query("""
SELECT CAST(ts AS DATE) AS run_date, COUNT(*) AS run_count,
       COUNT(DISTINCT date_trunc('hour', ts)) AS distinct_hours
FROM events GROUP BY 1
""")
def hourly_run_counts(t: Tables) -> DataFrame:
    return reports.runs_per_day(t.events.withColumnRenamed("ts", "ingested_at"))


@query(
    bind.sql(
        bind.FACT,
        body="""
SELECT 'Temperature range check' AS check_name, COUNT(*) AS violations,
       COUNT(*) FILTER (WHERE temperature_celsius < -50 OR temperature_celsius > 60) AS out_of_range FROM fact
UNION ALL
SELECT 'Humidity range check', COUNT(*),
       COUNT(*) FILTER (WHERE humidity_percent < 0 OR humidity_percent > 100) FROM fact""",
    )
)
def filtered_counts(t: Tables) -> DataFrame:
    return reports.range_violations(bind.fact(t))


@query("""
SELECT l_orderkey, l_linenumber, COUNT(*) AS duplicate_count
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1
""")
def duplicate_keys(t: Tables) -> DataFrame:
    return aggregate.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    bind.sql(
        bind.FACT,
        bind.LOCATION,
        body="""
SELECT location_name, COUNT(*) AS fact_count, MIN(observed_at) AS first_obs, MAX(observed_at) AS last_obs
FROM fact f JOIN location l ON f.location_id = l.location_id GROUP BY location_name""",
    )
)
def group_span(t: Tables) -> DataFrame:
    return reports.fact_span(bind.fact(t), bind.location(t))


@query(
    bind.sql(
        bind.FACT,
        bind.PAGE,
        body="""
SELECT (SELECT COUNT(*) FROM customer) AS locations, (SELECT COUNT(*) FROM fact) AS weather_observations,
       (SELECT COUNT(*) FROM page WHERE is_current) AS wikipedia_pages,
       (SELECT MAX(observed_at) FROM fact) AS latest_weather""",
    )
)
def dashboard_stats(t: Tables) -> DataFrame:
    return reads.dashboard_stats(t.customer, bind.fact(t), bind.page(t))


@query(
    bind.sql(
        bind.FACT,
        bind.LOCATION,
        body="""
SELECT location_name, city, COUNT(*) AS observation_count,
       MIN(observed_at) AS first_observation, MAX(observed_at) AS last_observation,
       CAST((CAST(SUM(temperature_celsius) * 200 AS HUGEINT) + COUNT(*)) // (2 * COUNT(*)) AS DOUBLE) / 100
         AS avg_temp_c,
       CAST((CAST(SUM(humidity_percent) * 200 AS HUGEINT) + COUNT(*)) // (2 * COUNT(*)) AS DOUBLE) / 100
         AS avg_humidity_pct,
       CAST((CAST(SUM(wind_speed_mps) * 200 AS HUGEINT) + COUNT(*)) // (2 * COUNT(*)) AS DOUBLE) / 100
         AS avg_wind_mps
FROM fact f JOIN location l ON f.location_id = l.location_id
WHERE CAST(observed_at AS DATE) = DATE '2024-01-15'
GROUP BY location_name, city""",
    )
)
def fact_dim_join_daily(t: Tables) -> DataFrame:
    rows = reports.weather_on_day(bind.fact(t), bind.location(t), bind.DAY)
    return bind.doubles(rows, "avg_temp_c", "avg_humidity_pct", "avg_wind_mps")


@query("""
WITH marked AS (
  SELECT user_id, event_type, ts, lag(event_type) OVER w AS before, row_number() OVER w AS rn
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
starts AS (
  SELECT user_id, event_type, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to
  FROM marked WHERE rn = 1 OR event_type IS DISTINCT FROM before)
SELECT s.user_id, s.event_type, s.valid_from, COUNT(*) AS row_count, MIN(e.ts) AS first_ts, MAX(e.ts) AS last_ts
FROM starts s JOIN events e ON s.user_id = e.user_id
WHERE s.valid_to IS NULL GROUP BY ALL
""")
def fact_scd2_join(t: Tables) -> DataFrame:
    """Facts joined to the current version of their dimension row."""
    versions = scd2_history(t.events, ["user_id"], "event_type", "ts").filter("is_current")
    totals = aggregate.span(t.events, ["user_id"], "ts", n="row_count", first="first_ts", last="last_ts")
    return versions.select("user_id", "event_type", "valid_from").join(totals, "user_id")


@query("""
WITH marked AS (
  SELECT user_id, event_type, ts, lag(event_type) OVER w AS before, row_number() OVER w AS rn
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
starts AS (
  SELECT user_id, event_type, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to
  FROM marked WHERE rn = 1 OR event_type IS DISTINCT FROM before)
SELECT s.user_id, s.event_type, s.valid_from, s.valid_to IS NULL AS is_current,
       COUNT(*) AS row_count, MIN(e.ts) AS first_ts, MAX(e.ts) AS last_ts
FROM starts s JOIN events e
  ON s.user_id = e.user_id AND e.ts >= s.valid_from AND (s.valid_to IS NULL OR e.ts < s.valid_to)
GROUP BY ALL
""")
def fact_version_join(t: Tables) -> DataFrame:
    """Facts that were loaded with the surrogate of their time's version, joined to all versions on it."""
    history = scd2_history(t.events, ["user_id"], "event_type", "ts")
    numbered = surrogate_ids(history, history.select(F.lit(0).alias("version_id")).limit(0), "version_id", ["user_id", "valid_from"])
    dim = stage(numbered, "versions")
    starts = dim.select("user_id", F.col("valid_from").alias("ts"), F.lit(-1).cast("bigint").alias("event_id"), "version_id")
    line = starts.unionByName(t.events.select("user_id", "ts", "event_id"), allowMissingColumns=True)
    loaded = with_closest(line, ["user_id"], ["ts", "event_id"], "version_id", before="page_version", after="__later")
    fact = loaded.filter(F.col("event_id") >= 0).select("ts", F.col("page_version").alias("version_id"))
    totals = aggregate.span(fact, ["version_id"], "ts", n="row_count", first="first_ts", last="last_ts")
    return dim.join(totals, "version_id").select(
        "user_id", "event_type", "valid_from", "is_current", "row_count", "first_ts", "last_ts"
    )


@query(
    bind.sql(
        *PAGES,
        body="""
SELECT page_title, revision_count, unique_editors, total_bytes_changed,
       CAST((2 * total_bytes_changed + revision_count) // (2 * revision_count) AS DOUBLE) AS avg_bytes_per_revision
FROM page_mart""",
    )
)
def most_active(t: Tables) -> DataFrame:
    return bind.doubles(reports.most_active_pages(page_mart(t)), "avg_bytes_per_revision")


@query(
    bind.sql(
        *WEATHER,
        body="""
SELECT location_name, min_temperature_celsius, max_temperature_celsius,
       CAST(CAST(max_temperature_celsius AS DECIMAL(18,2)) - CAST(min_temperature_celsius AS DECIMAL(18,2)) AS DOUBLE)
         AS temperature_range,
       avg_temperature_celsius
FROM weather_mart""",
    )
)
def daily_range_rank(t: Tables) -> DataFrame:
    mart = marts.daily_weather_aggregates(bind.fact(t), bind.location(t))
    return bind.doubles(reports.temperature_ranges(mart), *EXTREMES, "temperature_range")
