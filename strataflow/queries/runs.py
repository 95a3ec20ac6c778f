"""Bounded runs on stored tables: two runs against one result, archives, schema versions, lookups of one entity."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.functions.times import ntz
from strataflow.operators.shape import conform, evolve
from strataflow.plans import daily, pages, reads, reports
from strataflow.queries import bind
from strataflow.queries.marts import page_mart, weather_mart
from strataflow.queries.payloads import hours_payload, named_locations, raw_weather
from strataflow.queries.reports import page_tables
from strataflow.queries.storage import one_hour_payload
from strataflow.registry import Tables, query
from strataflow.schemas import RAW_PAGES
from strataflow.session import run_dir
from strataflow.sources import landing, seeds
from strataflow.sources.months import MonthTable, archive_months, with_month
from strataflow.sources.tables import Warehouse, months_in

LATER = bind.NOW + dt.timedelta(days=1)


def two_runs(t: Tables) -> Warehouse:
    """Payloads of the first half of the month, a run; those of the second half, a second run with every rule on."""
    wh = Warehouse(t.spark, run_dir(t.spark, "two-runs"))
    seen = t.events.select(F.col("user_id").alias("location_id")).distinct()
    wh.replace("core.location", named_locations(t).join(seen, "location_id", "left_semi"))
    raw = raw_weather(t, one_hour_payload())
    early = F.col("ingested_at") < ntz(bind.CUT)
    wh.append("raw.weather_observations", raw.filter(early))
    daily.run_daily(t.spark, wh.root, bind.NOW, all_locations=False)
    wh.append("raw.weather_observations", raw.filter(~early))
    daily.run_daily(t.spark, wh.root, LATER, all_locations=True)
    return wh


# In each run the newest payload of a location counts; of two for one hour that of the later run.
TWO_RUNS = """applied AS (
  SELECT user_id AS location_id, date_trunc('hour', ts) AS observed_at, event_id AS raw_id, ts,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, ts < TIMESTAMP '2024-01-15 00:00:00' ORDER BY ts DESC, event_id DESC) = 1),
fact AS (SELECT * FROM applied QUALIFY row_number() OVER (PARTITION BY location_id, observed_at ORDER BY ts DESC) = 1)"""


@query(
    bind.sql(
        TWO_RUNS,
        body="""
SELECT location_id, observed_at, k / 2 AS temperature_celsius, CAST(k AS DOUBLE) AS humidity_percent,
       CAST(CAST(k / 3.6 AS DECIMAL(5,2)) AS DOUBLE) AS wind_speed_mps, raw_id,
       CASE WHEN ts < TIMESTAMP '2024-01-15 00:00:00' THEN TIMESTAMP '2024-02-01 00:00:00'
            ELSE TIMESTAMP '2024-02-02 00:00:00' END AS created_at
FROM fact""",
    )
)
def two_runs_fact(t: Tables) -> DataFrame:
    """The hourly fact after two bounded runs."""
    fact = two_runs(t).read("core.weather").select(
        "location_id", "observed_at", "temperature_celsius", "humidity_percent", "wind_speed_mps",
        F.col("raw_ref.raw_id").alias("raw_id"), "created_at",
    )
    return bind.doubles(fact, "temperature_celsius", "humidity_percent", "wind_speed_mps")


@query(
    bind.sql(
        TWO_RUNS,
        body="""
SELECT 'Customer#' || lpad(CAST(location_id AS VARCHAR), 9, '0') AS location_name,
       CAST(observed_at AS DATE) AS observation_date, COUNT(*) AS observation_count,
       CAST(SUM(CAST(k AS DECIMAL(9,2)) / 2) AS DOUBLE) / COUNT(*) AS avg_temperature_celsius,
       MIN(k / 2) AS min_temperature_celsius, MAX(k / 2) AS max_temperature_celsius,
       CAST(SUM(k) AS DOUBLE) / COUNT(*) AS avg_humidity_percent
FROM fact GROUP BY 1, 2""",
    )
)
def two_runs_mart(t: Tables) -> DataFrame:
    """The weather mart after two bounded runs, refreshed by the months that changed."""
    mart = two_runs(t).read("mart.daily_weather_aggregates").select(
        "location_name", "observation_date", "observation_count", "avg_temperature_celsius",
        "min_temperature_celsius", "max_temperature_celsius", "avg_humidity_percent",
    )
    return bind.doubles(mart, "min_temperature_celsius", "max_temperature_celsius")


@query(
    bind.sql(
        TWO_RUNS,
        body="""
SELECT name, evaluated, unexpected FROM (
  SELECT COUNT(*) AS n, COUNT(DISTINCT location_id) AS places,
         COUNT(*) FILTER (WHERE k / 2 NOT BETWEEN -50 AND 60) AS cold,
         COUNT(*) FILTER (WHERE k NOT BETWEEN 0 AND 100) AS wet,
         COUNT(*) FILTER (WHERE CAST(k / 3.6 AS DECIMAL(5,2)) NOT BETWEEN 0 AND 200) AS windy FROM fact) AS counts,
LATERAL (VALUES ('temperature_celsius_in_range', n, cold), ('humidity_percent_in_range', n, wet),
  ('wind_speed_mps_in_range', n, windy), ('unique_location_id_observed_at', n, 0),
  ('min_rows_per_location_id', places, 0)) AS lines(name, evaluated, unexpected)""",
    )
)
def two_runs_gate(t: Tables) -> DataFrame:
    """What the gate finds in the weather fact after two runs, the minimum of rows per location from stored days."""
    lines = daily.quality_results(two_runs(t)).filter("checkpoint_name = 'weather_fact_checkpoint' AND kind <> 'required'")
    return lines.select("name", "evaluated", "unexpected")


@query(
    """
SELECT CAST(page_id + 1 AS BIGINT) AS wikipedia_page_id, url AS page_title, 'en' AS page_language,
       CAST(page_id AS VARCHAR) AS revision_id, strlen(html) AS content_len, DATE '2024-02-01' AS revision_date,
       1 AS revision_count, strlen(html) AS total_bytes_changed
FROM pages"""
)
def page_run_tables(t: Tables) -> DataFrame:
    """Pages landed in two batches, a run after each: dimension, revisions and page mart joined."""
    wh = Warehouse(t.spark, run_dir(t.spark, "page-runs"))
    payload = F.to_json(
        F.struct((F.col("page_id") + 1).alias("pageid"), F.col("url").alias("title"), F.col("page_id").cast("string").alias("revision"))
    )
    landed = t.pages.select(
        F.col("url").alias("page_title"), F.lit("en").alias("page_language"), payload.alias("payload"),
        F.octet_length("html").alias("content_size"), "url",
    )
    secure = F.col("url").startswith("https")
    for batch in (landed.filter(secure), landed.filter(~secure)):
        daily.run_daily(t.spark, wh.root, bind.NOW, page_landing=batch.drop("url"))
    dim = wh.read("core.wikipedia_page").select("page_id", "wikipedia_page_id", "page_title", "page_language")
    mart = wh.read("mart.daily_wikipedia_page_stats").select(
        "page_title", "page_language", "revision_date", "revision_count", "total_bytes_changed"
    )
    revision = wh.read("core.revision").select("page_id", "revision_id", "content_len")
    return dim.join(revision, "page_id").drop("page_id").join(mart, ["page_title", "page_language"])


# Orders as a stored table in months, keyed by order.
ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


@query("""
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate,
       CASE WHEN o_orderdate < TIMESTAMP '1998-07-01 00:00:00' THEN 'archived' ELSE 'kept' END AS place
FROM orders
""")
def archived_twice(t: Tables) -> DataFrame:
    """Orders archived, then the urgent ones come late, some of them with rows that were there before, and a second archive."""
    orders = with_month(t.orders.select(*ORDER_COLUMNS, "o_orderpriority"), "o_orderdate")
    schema = orders.drop("o_orderpriority").schema
    table = MonthTable(t.spark, run_dir(t.spark, "orders"), schema)
    archive = MonthTable(t.spark, run_dir(t.spark, "old-orders"), schema)
    late = F.coalesce(F.col("o_orderpriority") == "1-URGENT", F.lit(False))
    first = orders.filter(~late).withColumn("o_totalprice", F.lit(0.0))
    for batch in (first, orders):  # the second corrects the rows of the first
        rows = batch.drop("o_orderpriority")
        table.replace(rows, months_in(rows, "obs_month"), ["o_orderkey"])
        archive_months(table, archive, dt.date(1998, 7, 15), ["o_orderkey"])
    both = archive.read().withColumn("place", F.lit("archived")).unionByName(table.read().withColumn("place", F.lit("kept")))
    return both.drop("obs_month")


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_totalprice AS DECIMAL(18,2))::DOUBLE AS total,
       CASE WHEN o_orderdate < TIMESTAMP '1999-01-01 00:00:00' THEN 'old' ELSE o_orderpriority END AS priority
FROM orders
""")
def stored_schema_versions(t: Tables) -> DataFrame:
    """Months written under three versions of a schema, read as one: a rename, two changes of type, a new column."""
    shapes = (
        "o_orderkey long, price string, obs_month date",
        "o_orderkey long, total double, obs_month date",
        "order_id string, total decimal(18,2), priority string, obs_month date",
    )
    oldest, middle, newest = (t.spark.createDataFrame([], s).schema for s in shapes)
    steps = [
        (oldest, lambda df: evolve(df, rename={"price": "total"}, retype={"total": "double"})),
        (
            middle,
            lambda df: evolve(
                df, rename={"o_orderkey": "order_id"}, retype={"order_id": "string", "total": "decimal(18,2)"},
                add={"priority": "string"}, backfill={"priority": F.lit("old")},
            ),
        ),
    ]
    orders = with_month(t.orders, "o_orderdate")
    path = run_dir(t.spark, "orders-of-three-shapes")
    ends = (dt.date(1997, 1, 1), dt.date(1999, 1, 1), dt.date(9999, 1, 1))
    shaped = (
        orders.withColumn("price", F.col("o_totalprice").cast("string")),
        orders.withColumn("total", F.col("o_totalprice")),
        orders.withColumns({"order_id": F.col("o_orderkey").cast("string"), "total": F.col("o_totalprice"), "priority": F.col("o_orderpriority")}),
    )
    begin = dt.date(1900, 1, 1)
    for k, (schema, rows, end) in enumerate(zip((oldest, middle, newest), shaped, ends, strict=True)):
        part = conform(rows.filter((F.col("obs_month") >= F.lit(begin)) & (F.col("obs_month") < F.lit(end))), schema)
        MonthTable(t.spark, path, schema, migrations=steps[:k]).replace(part, months_in(part, "obs_month"))
        begin = end
    table = MonthTable(t.spark, path, newest, migrations=steps)
    return bind.doubles(table.read(), "total").drop("obs_month")


# Dimensions merged in one pass


def stored_pages(t: Tables) -> tuple[Warehouse, DataFrame, DataFrame]:
    """(warehouse, page dimension before, the same after a batch): customers, of whom every urgent orderer is renamed."""
    wh = Warehouse(t.spark, run_dir(t.spark, "merged-pages"))
    dim = t.customer.filter(F.col("c_nationkey") < 20).select(
        (F.col("c_custkey") + 1).alias("page_id"),
        F.col("c_custkey").alias("wikipedia_page_id"),
        F.col("c_mktsegment").alias("page_title"),
        F.lit("en").alias("page_language"),
        (F.col("c_acctbal") >= 0).alias("is_current"),
    )
    wh.replace("core.wikipedia_page", dim)
    renamed = t.orders.filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey")).distinct()
    batch = t.customer.join(renamed.withColumn("new", F.lit(" (new)")), "c_custkey", "left").select(
        F.col("c_custkey").alias("wikipedia_page_id"),
        F.lit("en").alias("page_language"),
        F.concat("c_mktsegment", F.coalesce("new", F.lit(""))).alias("page_title"),
    )
    before = wh.read("core.wikipedia_page")
    wh.merge_dimension("core.wikipedia_page", pages.merged_pages(before, batch, bind.NOW), "page_id", ("wikipedia_page_id", "page_language"))
    return wh, before, wh.read("core.wikipedia_page")


STORED_PAGES = """dim AS (
  SELECT c_custkey + 1 AS page_id, c_custkey, c_mktsegment AS page_title, c_acctbal >= 0 AS is_current FROM customer WHERE c_nationkey < 20),
batch AS (
  SELECT c_custkey, c_mktsegment || CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
                                         THEN ' (new)' ELSE '' END AS page_title FROM customer),
opened AS (
  SELECT b.* FROM batch b LEFT JOIN dim d ON b.c_custkey = d.c_custkey AND d.is_current
  WHERE d.c_custkey IS NULL OR d.page_title <> b.page_title)"""


@query(
    bind.sql(
        STORED_PAGES,
        body="""
SELECT d.c_custkey AS wikipedia_page_id, d.page_title, d.page_id AS old_id, d.is_current AND o.c_custkey IS NULL AS is_current,
       CASE WHEN d.is_current AND o.c_custkey IS NOT NULL THEN TIMESTAMP '2024-02-01 00:00:00' END AS valid_to
FROM dim d LEFT JOIN opened o ON d.c_custkey = o.c_custkey
UNION ALL SELECT c_custkey, page_title, NULL, true, NULL FROM opened""",
    )
)
def merged_pages_stored(t: Tables) -> DataFrame:
    """A stored type-2 dimension after a merge in one pass: kept, closed and new versions; ids of the old ones stay."""
    _, before, after = stored_pages(t)
    known = before.select("page_id", F.col("page_id").alias("old_id"))
    columns = ("wikipedia_page_id", "page_title", "old_id", "is_current", "valid_to")
    return after.join(known, "page_id", "left").select(*columns)


@query(
    bind.sql(
        STORED_PAGES,
        body="""
SELECT (SELECT COUNT(*) FROM dim) + COUNT(*) AS row_count, (SELECT COUNT(*) FROM dim) + COUNT(*) AS distinct_ids,
       (SELECT MAX(page_id) FROM dim) + 1 AS lowest_new, (SELECT MAX(page_id) FROM dim) + COUNT(*) AS highest_new,
       (SELECT MAX(page_id) FROM dim) + COUNT(*) AS noted
FROM opened""",
    )
)
def merged_page_ids(t: Tables) -> DataFrame:
    """The surrogates of a merge: new versions go on above the old ones without gaps, and the highest is noted."""
    wh, before, after = stored_pages(t)
    known = before.select("page_id", F.lit(True).alias("old"))
    new = F.when(F.col("old").isNull(), F.col("page_id"))
    return after.join(known, "page_id", "left").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("page_id").alias("distinct_ids"),
        F.min(new).alias("lowest_new"),
        F.max(new).alias("highest_new"),
        F.lit(wh.highest_id("core.wikipedia_page", "page_id")).alias("noted"),
    )


# One entity


def first_url(t: Tables) -> str:
    return t.pages.agg(F.min_by("url", "page_id")).first()[0]


@query("""
SELECT url AS title, html AS extract, url, 'plain' AS thumbnail, CAST(NULL AS VARCHAR) AS description,
       CAST(NULL AS VARCHAR) AS pageid, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(page_id) AS fetched_at
FROM pages WHERE lower(url) = (SELECT lower(arg_min(url, page_id)) FROM pages)
QUALIFY row_number() OVER (ORDER BY page_id DESC) = 1
""")
def page_by_title(t: Tables) -> DataFrame:
    """The newest summary of one title, ignoring case, from the landed pages that are dealt by title."""
    wh = Warehouse(t.spark, run_dir(t.spark, "titles"))
    wh.append("raw.wikipedia_pages", conform(page_tables(t)[1], RAW_PAGES))
    wh.index_titles()
    title = first_url(t)
    return reads.summary_by_title(wh.titles().find(title.upper()), title)


@query("""
SELECT p.page_id, url AS page_title, 'en' AS page_language, p.page_id + 1000 AS wikipedia_page_id, url AS title,
       html AS extract, url AS url, 'plain' AS thumbnail, CAST(NULL AS VARCHAR) AS description,
       TIMESTAMP '2024-01-01 00:00:00' + to_seconds(p.page_id) AS fetched_at,
       (SELECT COUNT(*) FROM orders WHERE o_custkey = p.page_id) AS revision_count
FROM pages p WHERE p.page_id = (SELECT MIN(page_id) FROM pages)
""")
def page_detail_of_one(t: Tables) -> DataFrame:
    """One page with its newest summary and its revision count; its raw rows come from the title lookup."""
    dim, raw, revision = page_tables(t)
    wh = Warehouse(t.spark, run_dir(t.spark, "titles"))
    wh.append("raw.wikipedia_pages", conform(raw, RAW_PAGES))
    wh.index_titles()
    return reads.page_detail(dim, wh.titles().find(first_url(t)), revision, t.pages.agg(F.min("page_id")).first()[0])


@query(
    bind.sql(
        bind.FACT,
        bind.LOCATION,
        body="""
SELECT l.location_name, l.city, l.region, l.country, s.*
FROM location l, (
  SELECT COUNT(*) AS "count", CAST(SUM(temperature_celsius) AS DOUBLE) / COUNT(temperature_celsius) AS avg_temp,
         CAST(MIN(temperature_celsius) AS DOUBLE) AS min_temp, CAST(MAX(temperature_celsius) AS DOUBLE) AS max_temp,
         CAST(SUM(humidity_percent) AS DOUBLE) / COUNT(humidity_percent) AS avg_humidity,
         CAST(SUM(wind_speed_mps) AS DOUBLE) / COUNT(wind_speed_mps) AS avg_wind
  FROM fact WHERE location_id = 7) AS s
WHERE l.location_id = 7""",
    )
)
def location_weather_stats(t: Tables) -> DataFrame:
    """One location's card: what it is, and statistics over all its hours."""
    info, _, stats = reads.location_weather(bind.location(t), bind.fact(t), 7, bind.AS_OF)
    return bind.doubles(info.drop("latitude", "longitude").join(stats), "min_temp", "max_temp")


@query(
    bind.sql(
        bind.FACT,
        body="""
SELECT location_id, observed_at, CAST(temperature_celsius AS DOUBLE) AS temperature_celsius,
       CAST(humidity_percent AS DOUBLE) AS humidity_percent, CAST(wind_speed_mps AS DOUBLE) AS wind_speed_mps
FROM fact WHERE location_id = 7 AND observed_at >= TIMESTAMP '2024-01-29 00:00:00'
QUALIFY row_number() OVER (ORDER BY observed_at, temperature_celsius, humidity_percent, wind_speed_mps) <= 200""",
    )
)
def location_recent_hours(t: Tables) -> DataFrame:
    """One location's hours since the day before, at most 200."""
    _, recent, _ = reads.location_weather(bind.location(t), bind.fact(t), 7, bind.AS_OF)
    hours = recent.drop("precipitation_mm", "cloud_cover_percent")
    return bind.doubles(hours, "temperature_celsius", "humidity_percent", "wind_speed_mps")


@query("""
SELECT upper(url) AS asked, url AS title, CASE WHEN length(html) > 500 THEN substr(html, 1, 500) || '...' ELSE html END AS extract, url
FROM pages WHERE page_id = (SELECT MIN(page_id) FROM pages)
""")
def city_page_summary(t: Tables) -> DataFrame:
    """The page part of a city's report: the newest summary under exactly its name, the extract shortened."""
    name = first_url(t).upper()
    _, _, summary = reads.city_report(bind.location(t), bind.fact(t), page_tables(t)[1], name)
    return summary.select(F.lit(name).alias("asked"), "title", "extract", "url")


# Seeds, pass-through models, the request window


@query("""
SELECT s.name, count(c_custkey) > 0 AS has_customers FROM (VALUES ('Boston'), ('New York'), ('Chicago')) AS s(name)
LEFT JOIN customer ON c_name = s.name GROUP BY s.name
""")
def inline_seeds_known(t: Tables) -> DataFrame:
    """Seeds that are given inline, and whether a customer has their name."""
    rows = [{"name": n, "latitude": 1.0, "longitude": 2.0} for n in ("Boston", "New York", "Chicago")]
    places = seeds.location_defaults(seeds.seed_frames(t.spark, rows, [])[0])
    names = t.customer.select(F.col("c_name").alias("location_name"), F.lit(True).alias("there")).distinct()
    joined = places.select("location_name").join(names, "location_name", "left")
    return joined.select(F.col("location_name").alias("name"), F.coalesce("there", F.lit(False)).alias("has_customers"))


@query(
    bind.sql(
        bind.FACT,
        bind.PAGE,
        body="""
SELECT 'weather' AS model, COUNT(*) AS row_count FROM fact
UNION ALL SELECT 'wikipedia_page', COUNT(*) FROM page WHERE is_current
UNION ALL SELECT 'location', COUNT(*) FROM customer""",
    )
)
def core_model_counts(t: Tables) -> DataFrame:
    """Rows of the core tables as downstream models see them: pages only in their current version."""
    wh = Warehouse(t.spark, run_dir(t.spark, "core-models"))
    fact = with_month(bind.fact(t), "observed_at")
    wh.replace_months("core.weather", fact, months_in(fact, "obs_month"))
    wh.replace("core.location", named_locations(t))
    wh.replace("core.wikipedia_page", bind.page(t))
    models = daily.core_models(wh)
    named = [(n, models[n], None) for n in ("weather", "wikipedia_page", "location")]
    parts = [df.agg(F.lit(n).alias("model"), F.count(F.lit(1)).alias("row_count")) for n, df, _ in named]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("""
SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-14 00:00:00' AND ts < TIMESTAMP '2024-01-23 00:00:00'
""")
def request_window_rows(t: Tables) -> DataFrame:
    """The rows that one request at noon of 2024-01-15 asks for: from the day before on, nine days."""
    start, end = landing.request_window(dt.datetime(2024, 1, 15, 12))
    return t.events.filter((F.col("ts") >= ntz(start)) & (F.col("ts") < ntz(end))).select("event_id", "ts")


# Reports with values of the tables


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
  WHERE CAST(observed_at AS DATE) = DATE '2024-01-15'
UNION ALL SELECT 'Core Revision Facts', COUNT(*), CAST(MAX(fetched_at) AS VARCHAR) FROM revision
  WHERE CAST(fetched_at AS DATE) = DATE '2024-01-15'
UNION ALL SELECT 'Mart Weather Aggregates', COUNT(*), CAST(MAX(observation_date) AS VARCHAR) FROM weather_mart
  WHERE observation_date = DATE '2024-01-15'
UNION ALL SELECT 'Mart Wikipedia Stats', COUNT(*), CAST(MAX(revision_date) AS VARCHAR) FROM page_mart
  WHERE revision_date = DATE '2024-01-15'""",
    )
)
def lineage_check_weather(t: Tables) -> DataFrame:
    """Rows and freshness per layer for a day that has hours."""
    return reports.lineage_check(
        t.events.withColumnRenamed("ts", "ingested_at"),
        t.orders.withColumnRenamed("o_orderdate", "ingested_at"),
        bind.fact(t).withColumn("created_at", F.col("observed_at")),
        bind.revision(t),
        weather_mart(t),
        page_mart(t),
        bind.DAY,
    )


@query("""
SELECT 'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS location_name, ts AS ingested_at, 'object' AS has_payload,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS first_timestamp FROM events
""")
def payload_first_times(t: Tables) -> DataFrame:
    """What a look into landed weather payloads shows: their kind and the first hour they bring."""
    return reports.weather_payload_peek(raw_weather(t, hours_payload()))


@query("""
SELECT url AS page_title, page_id AS wikipedia_page_id, 'en' AS page_language FROM pages
""")
def newest_page_rows(t: Tables) -> DataFrame:
    """Landed twice, the second time in lower case: the newest raw row of each page, told by the table of newest rows."""
    wh = Warehouse(t.spark, run_dir(t.spark, "newest-pages"))
    first = page_tables(t)[1].withColumn("page_id", F.col("id") + 1).withColumn("page_language", F.lit("en"))
    again = first.withColumns({"page_title": F.get_json_object("payload", "$.title"), "ingested_at": ntz(bind.NOW)})
    for batch in (first, again):
        wh.append("raw.wikipedia_pages", conform(batch, RAW_PAGES))
    latest = pages.latest_pages(daily.unapplied(wh, "raw.wikipedia_pages"))
    return latest.select("page_title", (F.col("page_id") - 1).alias("wikipedia_page_id"), "page_language")
