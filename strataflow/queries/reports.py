"""Read models and analyst reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.plans import reads, reports
from strataflow.queries import bind
from strataflow.queries.marts import PAGES, WEATHER, page_mart, weather_mart
from strataflow.registry import Tables, query

MEASURE_COLUMNS = ("temperature_celsius", "humidity_percent", "wind_speed_mps")
MEASURE_SQL = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in MEASURE_COLUMNS)
OPTIONAL_SQL = "CAST(NULL AS DOUBLE) AS precipitation_mm, CAST(NULL AS DOUBLE) AS cloud_cover_percent"
OPTIONAL_COLUMNS = ("precipitation_mm", "cloud_cover_percent")


@query(
    bind.sql(
        bind.FACT,
        body=f"""
SELECT location_id, observed_at, {MEASURE_SQL}, {OPTIONAL_SQL} FROM fact
WHERE observed_at >= TIMESTAMP '2024-01-29 00:00:00'
QUALIFY row_number() OVER (PARTITION BY location_id ORDER BY observed_at, temperature_celsius, humidity_percent,
                           pressure_hpa, wind_speed_mps) <= 2""",
    )
)
def recent_window(t: Tables) -> DataFrame:
    """The oldest observations of each location from the day before on, with a limit that cuts here."""
    return bind.doubles(
        reads.recent_observations(bind.fact(t), bind.AS_OF, limit=2), *MEASURE_COLUMNS, *OPTIONAL_COLUMNS
    )


@query(
    bind.sql(
        bind.FACT,
        body=f"""
SELECT location_id, observed_at, {MEASURE_SQL}, {OPTIONAL_SQL} FROM fact
WHERE observed_at >= TIMESTAMP '2024-01-29 00:00:00'""",
    )
)
def optional_columns(t: Tables) -> DataFrame:
    """The whole window; two measures that this fact lacks come as NULL."""
    rows = reads.recent_observations(bind.fact(t), bind.AS_OF, limit=None)
    return bind.doubles(rows, *MEASURE_COLUMNS, *OPTIONAL_COLUMNS)


@query(
    bind.sql(
        bind.FACT,
        body="""
SELECT CAST(observed_at AS DATE) AS date, COUNT(*) AS observation_count,
       COUNT(DISTINCT location_id) AS location_count
FROM fact
WHERE observed_at >= TIMESTAMP '2024-01-08 00:00:00' AND observed_at < TIMESTAMP '2024-01-15 00:00:00'
GROUP BY 1""",
    )
)
def range_daily_counts(t: Tables) -> DataFrame:
    return reports.daily_counts(bind.fact(t), dt.datetime(2024, 1, 8), dt.datetime(2024, 1, 15))


@query(
    bind.sql(
        bind.FACT,
        body="""
SELECT location_id, observed_at, CAST(temperature_celsius AS DOUBLE) AS temperature_celsius
FROM fact WHERE temperature_celsius < -50 OR temperature_celsius > 60""",
    )
)
def outlier_rows(t: Tables) -> DataFrame:
    return bind.doubles(reports.temperature_outliers(bind.fact(t)), "temperature_celsius")


@query(
    bind.sql(
        bind.PAGE,
        body="SELECT page_id, wikipedia_page_id, page_title, page_language, valid_from, is_current"
        " FROM page WHERE is_current",
    )
)
def list_current_pages(t: Tables) -> DataFrame:
    return reads.list_pages(bind.page(t))


def page_tables(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(page dimension, raw summaries with upper-case titles, revisions) over the web pages."""
    dim = t.pages.select(
        "page_id",
        F.col("url").alias("page_title"),
        F.lit("en").alias("page_language"),
        (F.col("page_id") + 1000).alias("wikipedia_page_id"),
        F.lit(True).alias("is_current"),
    )
    text = F.to_json(
        F.struct(
            F.col("url").alias("title"),
            F.col("html").alias("extract"),
            F.struct(F.struct(F.col("url").alias("page")).alias("desktop")).alias("content_urls"),
            F.lit("plain").alias("thumbnail"),
        )
    )
    raw = t.pages.select(
        F.col("page_id").alias("id"),
        F.upper("url").alias("page_title"),
        text.alias("payload"),
        F.timestamp_add("SECOND", F.col("page_id"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("ingested_at"),
    )
    return dim, raw, t.orders.select(F.col("o_custkey").alias("page_id"))


@query("""
WITH counts AS (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey),
newest AS (
  SELECT lower(url) AS key, url, html, page_id FROM pages
  QUALIFY row_number() OVER (PARTITION BY lower(url) ORDER BY page_id DESC) = 1)
SELECT p.page_id, p.url AS page_title, 'en' AS page_language, p.page_id + 1000 AS wikipedia_page_id,
       n.url AS title, n.html AS extract, n.url AS url, 'plain' AS thumbnail, CAST(NULL AS VARCHAR) AS description,
       TIMESTAMP '2024-01-01 00:00:00' + to_seconds(n.page_id) AS fetched_at, COALESCE(c.n, 0) AS revision_count
FROM pages p LEFT JOIN newest n ON lower(p.url) = n.key LEFT JOIN counts c ON c.o_custkey = p.page_id
""")
def page_detail(t: Tables) -> DataFrame:
    """Every page with its newest summary (title matched ignoring case) and its revision count."""
    return reads.page_details(*page_tables(t))


@query(
    bind.sql(
        bind.FACT,
        body="""
SELECT 'Core Weather Facts' AS layer, COUNT(*) AS row_count, CAST(MAX(observed_at) AS VARCHAR) AS latest_timestamp
FROM fact
UNION ALL SELECT 'Core Revision Facts', COUNT(*), CAST(MAX(o_orderdate) AS VARCHAR) FROM orders
UNION ALL SELECT 'Raw Lines', COUNT(*), CAST(MAX(l_shipdate) AS VARCHAR) FROM lineitem
UNION ALL SELECT 'Raw Wikipedia', COUNT(*), MAX(url) FROM pages""",
    )
)
def layer_summary(t: Tables) -> DataFrame:
    return reports.labelled_counts(
        [
            ("Core Weather Facts", bind.fact(t), "observed_at"),
            ("Core Revision Facts", t.orders, "o_orderdate"),
            ("Raw Lines", t.lineitem, "l_shipdate"),
            ("Raw Wikipedia", t.pages, "url"),
        ]
    )


@query(
    bind.sql(
        bind.FACT,
        bind.LOCATION,
        bind.REVISION,
        bind.PAGE,
        bind.WEATHER_MART,
        bind.PAGE_MART,
        body="""
SELECT 'Raw Weather' AS layer, COUNT(*) AS row_count, CAST(MAX(ts) AS VARCHAR) AS latest_timestamp FROM events
UNION ALL SELECT 'Raw Wikipedia', COUNT(*), CAST(MAX(o_orderdate) AS VARCHAR) FROM orders
UNION ALL SELECT 'Core Weather Facts', COUNT(*), CAST(MAX(observed_at) AS VARCHAR) FROM fact
  WHERE CAST(observed_at AS DATE) = DATE '2000-01-15'
UNION ALL SELECT 'Core Revision Facts', COUNT(*), CAST(MAX(fetched_at) AS VARCHAR) FROM revision
  WHERE CAST(fetched_at AS DATE) = DATE '2000-01-15'
UNION ALL SELECT 'Mart Weather Aggregates', COUNT(*), CAST(MAX(observation_date) AS VARCHAR) FROM weather_mart
  WHERE observation_date = DATE '2000-01-15'
UNION ALL SELECT 'Mart Wikipedia Stats', COUNT(*), CAST(MAX(revision_date) AS VARCHAR) FROM page_mart
  WHERE revision_date = DATE '2000-01-15'""",
    )
)
def lineage_check(t: Tables) -> DataFrame:
    """Rows and freshness per layer for one day; no hour falls on it, some revisions do."""
    fact = bind.fact(t).withColumn("created_at", F.col("observed_at"))
    return reports.lineage_check(
        t.events.withColumnRenamed("ts", "ingested_at"),
        t.orders.withColumnRenamed("o_orderdate", "ingested_at"),
        fact,
        bind.revision(t),
        weather_mart(t),
        page_mart(t),
        dt.date(2000, 1, 15),
    )


@query("""
SELECT user_id AS location_name, COUNT(*) AS raw_count, MAX(ts) AS latest_ingest FROM events GROUP BY user_id
""")
def raw_freshness(t: Tables) -> DataFrame:
    raw = t.events.select(F.col("user_id").alias("location_name"), F.col("ts").alias("ingested_at"))
    return reports.raw_freshness(raw)


@query("""
SELECT user_id AS location_name, ts AS ingested_at, 'object' AS has_payload,
       CAST(NULL AS VARCHAR) AS first_timestamp FROM events
""")
def payload_peek(t: Tables) -> DataFrame:
    raw = t.events.select(
        F.col("user_id").alias("location_name"), F.col("ts").alias("ingested_at"), F.col("props").alias("payload")
    )
    return reports.weather_payload_peek(raw)


@query(
    bind.sql(
        bind.REVISION,
        bind.PAGE,
        body="""
SELECT page_title, COUNT(*) AS revision_count, MIN(fetched_at) AS first_fetch, MAX(fetched_at) AS last_fetch,
       CAST(SUM(content_len) AS BIGINT) AS total_bytes,
       CAST((2 * CAST(SUM(content_len) AS BIGINT) + COUNT(*)) // (2 * COUNT(*)) AS DOUBLE) AS avg_content_bytes
FROM revision r JOIN page p ON r.page_id = p.page_id
WHERE is_current AND CAST(fetched_at AS DATE) = DATE '2000-01-15' GROUP BY page_title""",
    )
)
def revisions_on_day(t: Tables) -> DataFrame:
    rows = reports.revisions_on_day(bind.revision(t), bind.page(t), dt.date(2000, 1, 15))
    return bind.doubles(rows, "avg_content_bytes")


@query(
    bind.sql(
        *WEATHER,
        body="""
SELECT location_name, observation_count, avg_temperature_celsius, avg_humidity_percent, avg_wind_speed_kmh,
       most_common_conditions FROM weather_mart WHERE observation_date = DATE '2024-01-15'""",
    )
)
def warmest_first(t: Tables) -> DataFrame:
    return reports.warmest_first(weather_mart(t), bind.DAY)


@query(
    bind.sql(
        *WEATHER,
        body="""
SELECT observation_date, COUNT(*) AS location_count FROM weather_mart
WHERE observation_date >= DATE '2024-01-23' GROUP BY observation_date""",
    )
)
def locations_per_day(t: Tables) -> DataFrame:
    return reports.locations_per_day(weather_mart(t), bind.AS_OF)


@query(
    bind.sql(
        *WEATHER,
        bind.REVISION,
        bind.PAGE,
        bind.PAGE_MART,
        body="""
SELECT 'daily_weather_aggregates' AS view_name, COUNT(*) AS row_count, MIN(observation_date) AS min_date,
       MAX(observation_date) AS max_date FROM weather_mart
UNION ALL
SELECT 'daily_wikipedia_page_stats', COUNT(*), MIN(revision_date), MAX(revision_date) FROM page_mart""",
    )
)
def mart_spans(t: Tables) -> DataFrame:
    return reports.mart_spans(weather_mart(t), page_mart(t))


@query(bind.sql(*WEATHER, body="SELECT * FROM weather_mart"))
def mart_history(t: Tables) -> DataFrame:
    return reports.mart_history(weather_mart(t))


@query(
    bind.sql(
        *WEATHER,
        body="""
SELECT location_name, observation_date, observation_count,
       CAST((2 * CAST(round(avg_temperature_celsius * observation_count * 100) AS HUGEINT) + observation_count)
            // (2 * observation_count) AS DOUBLE) / 100 AS avg_temp
FROM weather_mart ORDER BY observation_date DESC, location_name LIMIT 10""",
    )
)
def newest_mart_rows(t: Tables) -> DataFrame:
    """The newest ten mart rows, averages rounded."""
    return bind.doubles(reports.newest_mart_rows(weather_mart(t)), "avg_temp")


# Locations that share a name: ten customers whose numbers differ in the last digit.
SHARED_NAMES = """named AS (SELECT *, substring(location_name, 1, 17) AS shared_name FROM location)"""


@query(
    bind.sql(
        bind.FACT,
        bind.LOCATION,
        SHARED_NAMES,
        body=f"""
SELECT shared_name AS location_name, observed_at, {MEASURE_SQL}
FROM fact f JOIN (SELECT shared_name, MAX(location_id) AS location_id FROM named GROUP BY shared_name) n
  ON f.location_id = n.location_id
QUALIFY row_number() OVER (PARTITION BY f.location_id ORDER BY observed_at DESC) <= 24""",
    )
)
def city_report(t: Tables) -> DataFrame:
    """The newest 24 hours of the newest location of every name."""
    named = bind.location(t).withColumn("location_name", F.substring("location_name", 1, 17))
    return bind.doubles(reads.city_hours(named, bind.fact(t)), *MEASURE_COLUMNS)


@query(
    bind.sql(
        bind.LOCATION,
        SHARED_NAMES,
        body="""
SELECT location_id, shared_name AS location_name, city, region, country, CAST(latitude AS DOUBLE) AS latitude,
       CAST(longitude AS DOUBLE) AS longitude, created_at
FROM named
QUALIFY row_number() OVER (PARTITION BY shared_name ORDER BY created_at DESC, location_id DESC) = 1""",
    )
)
def location_list(t: Tables) -> DataFrame:
    """One location per name."""
    named = bind.location(t).withColumn("location_name", F.substring("location_name", 1, 17))
    return bind.doubles(reads.list_locations(named), "latitude", "longitude")


@query(
    bind.sql(
        *WEATHER,
        body="""
SELECT location_name, city, country, observation_date, observation_count,
       CAST((2 * CAST(round(avg_temperature_celsius * observation_count * 100) AS HUGEINT) + observation_count)
            // (2 * observation_count) AS DOUBLE) / 100 AS avg_temp_c,
       min_temperature_celsius AS min_temp_c, max_temperature_celsius AS max_temp_c,
       CAST((2 * CAST(round(avg_humidity_percent * observation_count * 100) AS HUGEINT) + observation_count)
            // (2 * observation_count) AS DOUBLE) / 100 AS avg_humidity_pct,
       most_common_conditions
FROM weather_mart WHERE observation_date = DATE '2024-01-15'""",
    )
)
def weather_mart_day(t: Tables) -> DataFrame:
    return reports.weather_mart_day(weather_mart(t), bind.DAY)


@query(
    bind.sql(
        *PAGES,
        body="""
SELECT page_title, page_language, revision_date, revision_count, unique_editors, total_bytes_changed,
       CAST((2 * total_bytes_changed + revision_count) // (2 * revision_count) AS DOUBLE) AS avg_bytes_per_rev
FROM page_mart WHERE revision_date = DATE '2000-01-15'""",
    )
)
def page_mart_day(t: Tables) -> DataFrame:
    return reports.page_mart_day(page_mart(t), dt.date(2000, 1, 15))


@query("""
SELECT upper(url) AS page_title, CAST(page_id AS VARCHAR) AS revision_id,
       TIMESTAMP '2024-01-01 00:00:00' + to_seconds(page_id) AS ingested_at,
       strlen(html) AS revision_size_bytes, 'object' AS has_payload FROM pages
""")
def page_payload_peek(t: Tables) -> DataFrame:
    _, raw, _ = page_tables(t)
    sizes = t.pages.select(
        F.col("page_id").alias("id"),
        F.col("page_id").cast("string").alias("revision_id"),
        F.octet_length("html").alias("revision_size_bytes"),
    )
    return reports.page_payload_peek(raw.join(sizes, "id"))


@query("SELECT user_id AS location_name, ts AS ingested_at, props AS payload FROM events"
       " ORDER BY ts DESC, event_id DESC LIMIT 5")
def newest_payloads(t: Tables) -> DataFrame:
    """The five newest raw payloads: a top-k report."""
    raw = t.events.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("location_name"),
        F.col("ts").alias("ingested_at"),
        F.col("props").alias("payload"),
    )
    return reports.newest_payloads(raw)


@query(bind.sql(bind.LOCATION, body="SELECT location_name, city, country FROM location"))
def location_names(t: Tables) -> DataFrame:
    return reports.location_names(bind.location(t))
