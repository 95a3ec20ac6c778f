"""Layouts, schema evolution, refreshes, and the batch and incremental runs on files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from strataflow.functions.text import json_text
from strataflow.operators.shape import contract_report, evolve
from strataflow.plans import daily, marts
from strataflow.queries import bind
from strataflow.queries.marts import EXTREMES
from strataflow.queries.payloads import iso, named_locations, raw_weather
from strataflow.registry import Tables, query
from strataflow.session import run_dir
from strataflow.sources.tables import Warehouse, by_month, read_version, with_month, write_months, write_version
from strataflow.streaming.incremental import run_incremental


@query("""
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS obs_month, COUNT(*) AS row_count,
       MIN(o_orderdate) AS first_ts, MAX(o_orderdate) AS last_ts
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00' GROUP BY 1
""")
def month_partition_layout(t: Tables) -> DataFrame:
    """orders written by month and read back with a partition filter."""
    path = run_dir(t.spark, "orders-by-month")
    write_months(by_month(with_month(t.orders, "o_orderdate"), "obs_month"), path, "obs_month", ["o_custkey"])
    stored = t.spark.read.parquet(path).filter(F.col("obs_month") >= F.lit(dt.date(1998, 1, 1)))
    return stored.groupBy("obs_month").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("o_orderdate").alias("first_ts"),
        F.max("o_orderdate").alias("last_ts"),
    )


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_acctbal, c_mktsegment AS segment,
       CASE WHEN c_nationkey < 10 THEN c_name ELSE 'new' END AS note, c_nationkey < 10 AS is_old
FROM customer
""")
def schema_evolution(t: Tables) -> DataFrame:
    """Old rows are renamed, retyped, extended and backfilled, then united with rows of the new shape."""
    columns = ("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    old = t.customer.filter(F.col("c_nationkey") < 10).select(*columns, F.lit(True).alias("is_old"))
    new = t.customer.filter(F.col("c_nationkey") >= 10).select(
        F.col("c_custkey").cast("string").alias("c_custkey"),
        "c_name",
        "c_acctbal",
        F.col("c_mktsegment").alias("segment"),
        F.lit("new").alias("note"),
    )
    migrated = evolve(
        old,
        rename={"c_mktsegment": "segment"},
        retype={"c_custkey": "string"},
        add={"note": "string"},
        backfill={"note": F.col("c_name")},
    )
    both = migrated.unionByName(new, allowMissingColumns=True)
    return evolve(both, backfill={"is_old": F.lit(False)})


CUSTOMER_CONTRACT = StructType(
    [
        StructField("c_custkey", LongType()),
        StructField("c_name", StringType()),
        StructField("c_nationkey", LongType()),
        StructField("c_acctbal", DoubleType()),
        StructField("c_phone", StringType()),
        StructField("c_mktsegment", IntegerType()),
    ]
)


@query("""
SELECT * FROM (VALUES
  ('c_custkey', 'bigint', 'bigint', true, (SELECT COUNT(*) - COUNT(c_custkey) FROM customer)),
  ('c_name', 'string', 'string', true, (SELECT COUNT(*) - COUNT(c_name) FROM customer)),
  ('c_nationkey', 'bigint', 'int', false, (SELECT COUNT(*) - COUNT(c_nationkey) FROM customer)),
  ('c_acctbal', 'double', 'double', true, (SELECT COUNT(*) - COUNT(c_acctbal) FROM customer)),
  ('c_phone', 'string', NULL, false, NULL),
  ('c_mktsegment', 'int', 'string', false, (SELECT COUNT(*) - COUNT(c_mktsegment) FROM customer)))
AS c(column_name, expected_type, actual_type, ok, null_count)
""")
def schema_contract(t: Tables) -> DataFrame:
    """customer against a contract that it breaks in three columns."""
    return contract_report(t.customer, CUSTOMER_CONTRACT).drop("is_nullable")


@query(
    bind.sql(
        bind.FACT,
        bind.LOCATION,
        bind.WEATHER_MART,
        body="SELECT *, 2 AS version FROM weather_mart",
    )
)
def mart_refresh(t: Tables) -> DataFrame:
    """A mart published twice; readers see the second version."""
    path = run_dir(t.spark, "mart")
    fact, location = bind.fact(t), bind.location(t)
    early = fact.filter(F.col("observed_at") < F.lit("2024-01-15").cast("timestamp_ntz"))
    write_version(marts.daily_weather_aggregates(early, location), path)
    refreshed = marts.daily_weather_aggregates(fact, location)
    version = write_version(refreshed, path)
    current = read_version(t.spark, path, refreshed.schema)
    return bind.doubles(current, *EXTREMES).withColumn("version", F.lit(version))


def one_hour_payload():
    """A payload with the hour of the event, its value halved as a temperature, and props.k as the rest."""
    k = json_text(F.col("props"), "k").cast("int")
    return F.to_json(
        F.struct(
            F.struct(
                F.array(iso(F.date_trunc("hour", "ts").cast("timestamp_ntz"))).alias("time"),
                F.array(k / 2).alias("temperature_2m"),
                F.array(k).alias("relativehumidity_2m"),
                F.array(k).alias("windspeed_10m"),
            ).alias("hourly")
        )
    )


ONE_HOUR = """hour_rows AS (
  SELECT user_id AS location_id, date_trunc('hour', ts) AS observed_at, event_id AS raw_id, ts AS ingested_at,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events)"""


@query(
    bind.sql(
        ONE_HOUR,
        body="""
SELECT location_id, observed_at, k / 2 AS temperature_celsius, CAST(k AS DOUBLE) AS humidity_percent,
       CAST(CAST(k / 3.6 AS DECIMAL(5,2)) AS DOUBLE) AS wind_speed_mps, raw_id
FROM hour_rows
QUALIFY row_number() OVER (PARTITION BY location_id ORDER BY ingested_at DESC, raw_id DESC) = 1""",
    )
)
def incremental_equals_batch(t: Tables) -> DataFrame:
    """Raw payloads, several per location, read as a stream in shuffled micro-batches.

    The result has to be that of one batch over all payloads: the newest of each location.
    """
    wh = Warehouse(t.spark, run_dir(t.spark, "incremental"))
    wh.replace("core.location", named_locations(t))
    raw = raw_weather(t, one_hour_payload()).repartition(6, "id")
    wh.append("raw.weather_observations", raw)
    run_incremental(wh, run_dir(t.spark, "stream-state"), bind.NOW, files_per_batch=3)
    fact = wh.read("core.weather").select(
        "location_id",
        "observed_at",
        "temperature_celsius",
        "humidity_percent",
        "wind_speed_mps",
        F.col("raw_ref.raw_id").alias("raw_id"),
    )
    return bind.doubles(fact, "temperature_celsius", "humidity_percent", "wind_speed_mps")


@query(
    bind.sql(
        """chosen AS (
  SELECT user_id, date_trunc('hour', MAX(ts)) AS observed_at FROM events GROUP BY user_id)""",
        body="""
SELECT (SELECT COUNT(*) FROM customer) AS locations, (SELECT COUNT(*) FROM chosen) AS weather_payloads,
       (SELECT COUNT(*) FROM chosen) AS weather_rows_applied, 0 AS weather_rejected,
       (SELECT COUNT(*) FROM pages) AS pages_processed, (SELECT COUNT(*) FROM pages) AS revisions_inserted,
       true AS quality_passed, 2 AS views_refreshed, 'success' AS run_status""",
    )
)
def daily_run(t: Tables) -> DataFrame:
    """Every layer once: customers as seeds, events and pages as landed payloads, gate, both marts."""
    seeds = (
        named_locations(t).select(
            F.col("location_id").cast("int").alias("position"),
            F.col("location_name").alias("name"),
            "latitude",
            "longitude",
            F.lit(None).cast("string").alias("country"),
            F.lit(None).cast("string").alias("region"),
            F.lit(None).cast("string").alias("city"),
        ),
        t.nation.select(
            F.col("n_nationkey").alias("position"),
            F.col("n_name").alias("title"),
            F.lit(None).cast("string").alias("language"),
            F.lit(0).alias("namespace"),
        ),
    )
    landing = raw_weather(t, one_hour_payload()).select("location_name", "latitude", "longitude", "payload")
    page_payload = F.to_json(
        F.struct(
            (F.col("page_id") + 1).alias("pageid"),
            F.col("url").alias("title"),
            F.col("page_id").cast("string").alias("revision"),
        )
    )
    page_landing = t.pages.select(
        F.col("url").alias("page_title"),
        F.lit("en").alias("page_language"),
        page_payload.alias("payload"),
        F.octet_length("html").alias("content_size"),
    )
    return daily.run_daily(
        t.spark,
        run_dir(t.spark, "warehouse"),
        bind.NOW,
        weather_landing=landing,
        page_landing=page_landing,
        seeds=seeds,
        all_locations=False,
    )
