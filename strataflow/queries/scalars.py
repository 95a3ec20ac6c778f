"""Scalar expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions import numbers, text, times
from strataflow.queries import bind
from strataflow.queries.payloads import iso
from strataflow.registry import Tables, query
from strataflow.sources.seeds import location_defaults, page_defaults


@query("SELECT event_id, value / 3.6::DOUBLE AS mps, value * 9 / 5 + 32 AS fahrenheit FROM events")
def unit_convert(t: Tables) -> DataFrame:
    value = F.col("value")
    return t.events.select(
        "event_id",
        numbers.kmh_to_mps(value).alias("mps"),
        numbers.celsius_to_fahrenheit(value).alias("fahrenheit"),
    )


@query("""
SELECT event_id, value / NULLIF(CAST(json_extract_string(props, '$.k') AS DOUBLE), 0) AS ratio FROM events
""")
def safe_ratio(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("double")
    return t.events.select("event_id", numbers.ratio(F.col("value"), k).alias("ratio"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST((CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) + 50) // 100 AS DOUBLE) AS rounded,
       CASE WHEN l_extendedprice < 999.995 THEN l_extendedprice END AS narrowed
FROM lineitem
""")
def decimal_rounding(t: Tables) -> DataFrame:
    """Half-away rounding, and narrowing to DECIMAL(5,2) where overflow gives NULL."""
    price = F.col("l_extendedprice")
    rows = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        numbers.round_numeric(price, 0).alias("rounded"),
        numbers.narrow(price).alias("narrowed"),
    )
    return bind.doubles(rows, "rounded", "narrowed")


def written_time() -> Column:
    """The event time in a notation that depends on the event type; errors are written as garbage."""
    kind, stamp = F.col("event_type"), iso(F.col("ts"))
    return (
        F.when(kind == "view", F.concat(stamp, F.lit("Z")))
        .when(kind == "click", F.concat(stamp, F.lit("+05:30")))
        .when(kind == "signup", F.date_format("ts", "yyyy-MM-dd"))
        .when(kind == "error", F.date_format("ts", "yyyy-MM"))
        .otherwise(stamp)
    )


@query("""
SELECT event_id,
       CASE event_type WHEN 'click' THEN ts - INTERVAL 330 MINUTE
                       WHEN 'signup' THEN date_trunc('day', ts)
                       WHEN 'error' THEN NULL ELSE ts END AS parsed,
       CASE event_type WHEN 'click' THEN ts - INTERVAL 330 MINUTE
                       WHEN 'signup' THEN date_trunc('day', ts)
                       WHEN 'error' THEN TIMESTAMP '2024-02-01 00:00:00' ELSE ts END AS parsed_or_now
FROM events
""")
def iso_parse(t: Tables) -> DataFrame:
    written = t.events.select("event_id", written_time().alias("w"))
    return written.select(
        "event_id",
        times.iso_to_utc(F.col("w")).alias("parsed"),
        times.iso_or(F.col("w"), times.ntz(bind.NOW)).cast("timestamp_ntz").alias("parsed_or_now"),
    )


@query("""
SELECT event_id, date_trunc('hour', ts) AS hour, CAST(date_trunc('month', ts) AS DATE) AS month,
       CAST(ts AS DATE) AS day, epoch_us(ts) AS micros
FROM events
""")
def time_parts(t: Tables) -> DataFrame:
    ts = F.col("ts")
    return t.events.select(
        "event_id",
        times.hour_of(ts).alias("hour"),
        times.month_of(ts).alias("month"),
        F.to_date(ts).alias("day"),
        times.micros(ts).alias("micros"),
    )


def summary_payload() -> Column:
    """A page summary per event; the thumbnail is an object, a text or absent by event type."""
    kind, number = F.col("event_type"), F.col("event_id").cast("string")
    thumbnail = (
        F.when(kind == "view", F.concat(F.lit(', "thumbnail": {"source": "img'), number, F.lit('", "width": 1}')))
        .when(kind == "click", F.concat(F.lit(', "thumbnail": "img'), number, F.lit('"')))
        .otherwise(F.lit(""))
    )
    namespace = (
        F.when(kind == "signup", F.lit(', "namespace": {"id": 4, "text": "t"}'))
        .when(kind == "error", F.lit(', "namespace": 2'))
        .otherwise(F.lit(""))
    )
    return F.concat(
        F.lit('{"title": "T'),
        number,
        F.lit('", "content_urls": {"desktop": {"page": "u'),
        number,
        F.lit('"}}, "hourly": {"time": ["'),
        iso(F.col("ts")),
        F.lit('", "x"]}'),
        thumbnail,
        namespace,
        F.lit("}"),
    )


@query("""
SELECT event_id, 'T' || event_id AS title, 'u' || event_id AS url,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS first_time, CAST(NULL AS VARCHAR) AS missing,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
FROM events
""")
def json_paths(t: Tables) -> DataFrame:
    p = F.col("p")
    return t.events.select("event_id", "props", summary_payload().alias("p")).select(
        "event_id",
        text.json_text(p, "title").alias("title"),
        text.json_text(p, "content_urls", "desktop", "page").alias("url"),
        text.json_text(p, "hourly", "time", 0).alias("first_time"),
        text.json_text(p, "content_urls", "mobile", "page").alias("missing"),
        text.json_text(F.col("props"), "k").cast("int").alias("k"),
    )


@query("""
SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN 'img' || event_id END AS thumbnail,
       CASE event_type WHEN 'signup' THEN 4 WHEN 'error' THEN 2 ELSE 0 END AS namespace
FROM events
""")
def json_polymorphic(t: Tables) -> DataFrame:
    p = F.col("p")
    return t.events.select("event_id", summary_payload().alias("p")).select(
        "event_id",
        text.json_inner_or_self(p, "thumbnail", "source").alias("thumbnail"),
        text.namespace_id(text.json_text(p, "namespace")).alias("namespace"),
    )


@query("""
SELECT event_id,
       CASE event_type WHEN 'view' THEN 'object' WHEN 'click' THEN 'array' WHEN 'signup' THEN 'string'
                       WHEN 'error' THEN CASE WHEN value < 5 THEN 'null' ELSE 'boolean' END ELSE 'number' END AS kind
FROM events
""")
def json_typeof(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    document = (
        F.when(kind == "view", F.col("props"))
        .when(kind == "click", F.concat(F.lit(" ["), F.col("props"), F.lit("]")))
        .when(kind == "signup", F.lit('"text"'))
        .when(kind == "error", F.when(F.col("value") < 5, "null").otherwise("true"))
        .otherwise(F.col("value").cast("string"))
    )
    return t.events.select("event_id", text.json_kind(document).alias("kind"))


TITLE = r"<title>([^<]*)</title>"


@query(f"SELECT page_id, replace(regexp_extract(html, '{TITLE}', 1), ' ', '_') AS slug FROM pages")
def title_slug(t: Tables) -> DataFrame:
    title = F.regexp_extract("html", TITLE, 1)
    return t.pages.select("page_id", text.slug(title).alias("slug"))


@query("""
SELECT doc_id, CASE WHEN length(text) > 500 THEN substring(text, 1, 500) || '...' ELSE text END AS preview
FROM documents
""")
def text_preview(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.preview(F.col("text")).alias("preview"))


@query("SELECT page_id, strlen(html) AS bytes, length(html) AS chars FROM pages")
def content_bytes(t: Tables) -> DataFrame:
    return t.pages.select("page_id", text.utf8_bytes(F.col("html")).alias("bytes"), F.length("html").alias("chars"))


@query(
    bind.sql(
        bind.LOCATION,
        """parts AS (
  SELECT location_id, location_name, CASE WHEN balance > 5000 THEN city ELSE '' END AS city,
         CASE WHEN balance > 2500 THEN 'Town ' || city END AS town,
         CASE WHEN balance > 0 THEN 'Village ' || city END AS village,
         CASE WHEN region = 'ASIA' THEN '' ELSE region END AS region,
         CASE WHEN balance < 0 THEN NULL ELSE country END AS country FROM location)""",
        """chosen AS (
  SELECT *, COALESCE(NULLIF(city, ''), NULLIF(town, ''), NULLIF(village, ''), location_name) AS place FROM parts)""",
        body="""
SELECT location_id, place AS city,
       place || CASE WHEN region = '' THEN '' ELSE ', ' || region END
             || CASE WHEN country IS NULL THEN '' ELSE ', ' || country END AS display_name
FROM chosen""",
    )
)
def address_normalize(t: Tables) -> DataFrame:
    balance = F.col("balance")
    city = F.when(balance > 5000, F.col("city")).otherwise("")
    town = F.when(balance > 2500, F.concat(F.lit("Town "), "city"))
    village = F.when(balance > 0, F.concat(F.lit("Village "), "city"))
    place = text.first_filled(city, town, village, F.col("location_name"))
    region = F.when(F.col("region") == "ASIA", "").otherwise(F.col("region"))
    country = F.when(~(balance < 0), F.col("country"))
    return bind.location(t).select(
        "location_id",
        place.alias("city"),
        text.join_filled(", ", place, region, country).alias("display_name"),
    )


@query("""
SELECT p_name || ' #' || p_partkey AS location_name, CAST(CAST(round(p_retailprice * 100) AS BIGINT) AS DOUBLE) / 10000 AS latitude,
       COALESCE(CASE WHEN p_type <> 'SMALL' THEN p_brand END, 'US') AS country,
       COALESCE(CASE WHEN p_size > 25 THEN p_type END, '') AS region,
       COALESCE(CASE WHEN p_size > 10 THEN p_name END, p_name || ' #' || p_partkey) AS city
FROM part
""")
def seed_defaults(t: Tables) -> DataFrame:
    """Seed records with absent fields."""
    size = F.col("p_size")
    name = F.concat("p_name", F.lit(" #"), F.col("p_partkey").cast("string"))
    seeds = t.part.select(
        name.alias("name"),
        (F.col("p_retailprice").cast(bind.MONEY) / 100).cast("decimal(10,8)").alias("latitude"),
        F.lit("0").cast("decimal(11,8)").alias("longitude"),
        F.when(F.col("p_type") != "SMALL", F.col("p_brand")).alias("country"),
        F.when(size > 25, F.col("p_type")).alias("region"),
        F.when(size > 10, F.col("p_name")).alias("city"),
    )
    return bind.doubles(location_defaults(seeds).drop("longitude"), "latitude")


@query("""
SELECT p_partkey AS position, p_name AS page_title,
       COALESCE(CASE WHEN p_size > 25 THEN 'de' END, 'en') AS page_language,
       COALESCE(CASE WHEN p_size > 10 THEN p_size END, 0) AS namespace
FROM part
""")
def seed_page_defaults(t: Tables) -> DataFrame:
    size = F.col("p_size")
    return page_defaults(
        t.part.select(
            F.col("p_partkey").alias("position"),
            F.col("p_name").alias("title"),
            F.when(size > 25, F.lit("de")).alias("language"),
            F.when(size > 10, size).alias("namespace"),
        )
    )
