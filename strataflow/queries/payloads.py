"""Payload parsing: envelopes, guards, parallel arrays, lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.operators.payload import explode_parallel
from strataflow.plans import pages, weather
from strataflow.queries import bind
from strataflow.registry import Tables, query
from strataflow.schemas import WEATHER_PAYLOAD
from strataflow.sources.landing import page_envelope, weather_envelope

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def iso(ts: Column) -> Column:
    return F.date_format(ts, ISO_MICROS)


def hours_payload() -> Column:
    """One payload per event with three hours: humidity is one short, wind one long, cloud cover missing."""
    k = F.get_json_object("props", "$.k").cast("int")
    times = F.array(*[iso(F.timestamp_add("HOUR", F.lit(h), F.col("ts"))) for h in range(3)])
    return F.to_json(
        F.struct(
            F.lit(0).alias("utc_offset_seconds"),
            F.struct(
                times.alias("time"),
                F.array(F.col("value"), F.lit(None).cast("double"), F.col("value")).alias("temperature_2m"),
                F.array(k, k + 1).alias("relativehumidity_2m"),
                F.array(k, k + 1, k + 2, k + 3).alias("windspeed_10m"),
            ).alias("hourly"),
        ),
        {"ignoreNullFields": "false"},
    )


def raw_weather(t: Tables, payload: Column) -> DataFrame:
    """events as raw weather rows: one payload each."""
    zero = F.lit("0")
    return t.events.select(
        F.col("event_id").alias("id"),
        F.format_string("Customer#%09d", "user_id").alias("location_name"),
        zero.cast("decimal(10,8)").alias("latitude"),
        zero.cast("decimal(11,8)").alias("longitude"),
        payload.alias("payload"),
        F.col("ts").alias("ingested_at"),
        F.lit("open-meteo").alias("source"),
    )


def named_locations(t: Tables) -> DataFrame:
    """customer as locations at (0, 0), found by name."""
    zero = F.lit("0")
    return t.customer.select(
        F.col("c_custkey").alias("location_id"),
        F.col("c_name").alias("location_name"),
        zero.cast("decimal(10,8)").alias("latitude"),
        zero.cast("decimal(11,8)").alias("longitude"),
    )


# The hours of hours_payload(): position p of event e.
HOURS = """hours AS (
  SELECT event_id AS raw_id, user_id AS location_id, p AS pos,
         ts + to_hours(CAST(p AS INTEGER)) AS observed_at,
         CASE WHEN p = 1 THEN NULL ELSE value END AS temperature_celsius,
         CASE WHEN p < 2 THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) + p END AS humidity_percent,
         CAST(json_extract_string(props, '$.k') AS INTEGER) + p AS wind_kmh,
         'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS name, ts AS ingested_at
  FROM events, (VALUES (0), (1), (2)) AS positions(p))"""

MEASURE_TYPES = ("temperature_celsius", "humidity_percent", "wind_speed_mps")


@query(
    bind.sql(
        HOURS,
        body="""
SELECT raw_id, location_id, pos, observed_at, temperature_celsius, humidity_percent,
       CAST(CAST(wind_kmh / 3.6 AS DECIMAL(5,2)) AS DOUBLE) AS wind_speed_mps FROM hours""",
    )
)
def hourly_explode(t: Tables) -> DataFrame:
    """Payloads to typed, converted hours through the whole parser: guards, location lookup, void check."""
    parsed = weather.parse_once(raw_weather(t, hours_payload()), named_locations(t))
    hours = weather.good_hours(parsed).select("raw_id", "location_id", "pos", "observed_at", *MEASURE_TYPES)
    return bind.doubles(hours, *MEASURE_TYPES)


@query(
    bind.sql(
        HOURS,
        body="""
SELECT raw_id, pos, strftime(observed_at, '%Y-%m-%dT%H:%M:%S.%f') AS time,
       CASE WHEN pos = 1 THEN NULL ELSE temperature_celsius END AS temperature,
       humidity_percent AS humidity, CAST(wind_kmh AS DOUBLE) AS wind, CAST(NULL AS DOUBLE) AS cloud
FROM hours""",
    )
)
def hourly_explode_ragged(t: Tables) -> DataFrame:
    """The bare explode: short arrays pad with NULL, long ones are cut, a missing one is all NULL."""
    hourly = F.from_json(hours_payload(), WEATHER_PAYLOAD)["hourly"]
    docs = t.events.select(F.col("event_id").alias("raw_id"), hourly.alias("h"))
    values = {
        "temperature": F.col("h.temperature_2m"),
        "humidity": F.col("h.relativehumidity_2m"),
        "wind": F.col("h.windspeed_10m"),
        "cloud": F.col("h.cloudcover"),
    }
    rows = explode_parallel(docs, F.col("h.time"), values, keep=["raw_id"], driver_name="time")
    return bind.doubles(rows, *values)


def broken_payload() -> Column:
    """A fault per event type; purchases are sound, errors have an unparsable time, large values overflow."""
    kind = F.col("event_type")
    return (
        F.when(kind == "view", F.lit(None).cast("string"))
        .when(kind == "click", F.lit('{"hourly": {}}'))
        .when(kind == "signup", F.lit('{"hourly": {"time": []}}'))
        .when(kind == "error", F.lit('{"hourly": {"time": ["2024-01-01T00:00", "2024"]}}'))
        .otherwise(
            F.concat(
                F.lit('{"hourly": {"time": ["'),
                iso(F.col("ts")),
                F.lit('"], "temperature_2m": ['),
                (F.col("value") * 10).cast("string"),
                F.lit("]}}"),
            )
        )
    )


FAULTS = """faults AS (
  SELECT event_id, user_id,
         CASE event_type WHEN 'view' THEN 'no_payload' WHEN 'click' THEN 'no_hourly'
                         WHEN 'signup' THEN 'no_time' WHEN 'error' THEN 'bad_time'
              ELSE CASE WHEN value * 10 >= 999.995 THEN 'overflow' END END AS reason
  FROM events)"""


@query(
    bind.sql(
        FAULTS, body="SELECT event_id AS raw_id, reason FROM faults WHERE reason IS NOT NULL"
    )
)
def payload_guards(t: Tables) -> DataFrame:
    """Every payload that is skipped or voided, with the reason."""
    parsed = weather.parse_once(raw_weather(t, broken_payload()), named_locations(t))
    return weather.rejected(parsed).select("raw_id", "reason")


@query(
    bind.sql(
        FAULTS,
        body="""
SELECT COUNT(*) AS payloads, COUNT(reason) AS rejected, COUNT(*) - COUNT(reason) AS applied,
       COUNT(DISTINCT user_id) FILTER (WHERE reason IS NULL) AS locations_processed,
       COUNT(*) FILTER (WHERE reason IS NULL) AS rows_applied
FROM faults""",
    )
)
def run_metrics(t: Tables) -> DataFrame:
    """Counts of a transform run, from one pass over the parsed payloads."""
    return weather.run_metrics(weather.parse_payloads(raw_weather(t, broken_payload()), named_locations(t)))


@query(
    bind.sql(
        HOURS,
        body="""
SELECT raw_id, location_id, pos, observed_at, ingested_at AS raw_ingested_at, 'open-meteo' AS raw_source,
       '{"raw_table":"weather_observations","raw_id":' || raw_id || ',"name":"' || name || '"}' AS raw_ref
FROM hours""",
    )
)
def lineage_trace(t: Tables) -> DataFrame:
    """Fact hours traced back to their raw rows."""
    raw = raw_weather(t, hours_payload())
    hours = weather.good_hours(weather.parse_once(raw, named_locations(t)))
    traced = weather.trace_to_raw(hours, raw, ["ingested_at", "source"])
    return traced.select(
        "raw_id",
        "location_id",
        "pos",
        "observed_at",
        "raw_ingested_at",
        "raw_source",
        F.to_json(F.struct("raw_ref.raw_table", "raw_ref.raw_id", "raw_ref.name")).alias("raw_ref"),
    )


@query("""
SELECT 'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS location_name, props AS payload,
       TIMESTAMP '2024-02-01 00:00:00' AS ingested_at, 'open-meteo' AS source
FROM events
""")
def land_weather_envelope(t: Tables) -> DataFrame:
    landing = t.events.select(
        F.format_string("Customer#%09d", "user_id").alias("location_name"),
        F.lit("42.3601").cast("decimal(10,8)").alias("latitude"),
        F.lit("-71.0589").cast("decimal(11,8)").alias("longitude"),
        F.col("props").alias("payload"),
    )
    return weather_envelope(landing, bind.NOW).drop("latitude", "longitude")


def page_landing(t: Tables) -> DataFrame:
    """pages as landed summaries: namespace is an object, a number or absent; every third field may be missing."""
    secure = F.col("url").startswith("https")
    mobile = F.col("url").contains("://m.")
    namespace = (
        F.when(mobile, F.lit(', "namespace": {"id": 4, "text": "x"}'))
        .when(secure, F.lit(', "namespace": 2'))
        .otherwise(F.lit(""))
    )
    stamp = F.when(secure, F.lit(', "timestamp": "2024-01-05T06:07:08+02:00"')).otherwise(F.lit(""))
    payload = F.concat(
        F.lit('{"pageid": '),
        F.col("page_id").cast("string"),
        F.lit(', "title": '),
        F.to_json(F.struct(F.col("url").alias("u"))).substr(F.lit(6), F.length("url") + 2),
        F.lit(', "revision": '),
        (F.col("page_id") + 1000).cast("string"),
        namespace,
        stamp,
        F.lit("}"),
    )
    return t.pages.select(
        F.lit("requested").alias("page_title"),
        F.when(mobile, F.lit(None).cast("string")).otherwise(F.lit("de")).alias("page_language"),
        payload.alias("payload"),
        F.octet_length("html").alias("content_size"),
    )


@query("""
SELECT page_id, url AS page_title,
       CASE WHEN url LIKE '%://m.%' THEN 4 WHEN url LIKE 'https%' THEN 2 ELSE 0 END AS namespace,
       CAST(page_id + 1000 AS VARCHAR) AS revision_id,
       CASE WHEN url LIKE 'https%' THEN TIMESTAMP '2024-01-05 04:07:08' ELSE TIMESTAMP '2024-02-01 00:00:00' END
         AS revision_timestamp,
       strlen(html) AS revision_size_bytes,
       CASE WHEN url LIKE '%://m.%' THEN 'en' ELSE 'de' END AS page_language,
       TIMESTAMP '2024-02-01 00:00:00' AS ingested_at, 'mediawiki-rest-api' AS source
FROM pages
""")
def land_page_envelope(t: Tables) -> DataFrame:
    return page_envelope(page_landing(t), bind.NOW).drop("payload")


@query("""
SELECT page_id AS wikipedia_page_id, url AS page_title,
       CASE WHEN url LIKE '%://m.%' THEN 4 WHEN url LIKE 'https%' THEN 2 ELSE 0 END AS namespace,
       CASE WHEN url LIKE '%://m.%' THEN 'en' ELSE 'de' END AS page_language,
       CAST(page_id + 1000 AS VARCHAR) AS revision_id,
       CASE WHEN url LIKE 'https%' THEN TIMESTAMP '2024-01-05 04:07:08' ELSE TIMESTAMP '2024-02-01 00:00:00' END
         AS revision_timestamp,
       strlen(html) AS content_len
FROM pages
""")
def page_payload_fields(t: Tables) -> DataFrame:
    """Newest payload per page, parsed for the dimension and the revision fact."""
    raw = page_envelope(page_landing(t), bind.NOW).withColumn("id", F.col("page_id"))
    parsed = pages.parse_pages(pages.latest_pages(raw), bind.NOW)
    return parsed.drop("raw_id", "requested_title", "ingested_at")
