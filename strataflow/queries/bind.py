"""The input tables in warehouse shape, as DataFrames and as SQL common table expressions.

`events` play the hourly fact (user = location), `customer` with `nation` and
`region` the location dimension, `orders` the revision fact, and `customer` the
page dimension.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.registry import Tables

NOW = dt.datetime(2024, 2, 1)
AS_OF = dt.date(2024, 1, 30)
DAY = dt.date(2024, 1, 15)
CUT = dt.datetime(2024, 1, 15)

MONEY = "decimal(18,2)"
# Wide enough for any event value, narrow enough that Spark keeps its sums in a long.
READING = "decimal(8,2)"


def fact(t: Tables) -> DataFrame:
    """events as the hourly fact: value as temperature, props.k as humidity and wind."""
    k = F.get_json_object("props", "$.k").cast(READING)
    return t.events.select(
        "event_id",
        F.col("user_id").alias("location_id"),
        F.col("ts").alias("observed_at"),
        F.col("value").cast(READING).alias("temperature_celsius"),
        k.alias("humidity_percent"),
        (k + 1000).cast(READING).alias("pressure_hpa"),
        k.alias("wind_speed_mps"),
        F.col("event_type").alias("conditions"),
    )


FACT = """fact AS (
  SELECT event_id, user_id AS location_id, ts AS observed_at,
         CAST(value AS DECIMAL(18,2)) AS temperature_celsius,
         CAST(json_extract_string(props, '$.k') AS DECIMAL(18,2)) AS humidity_percent,
         CAST(json_extract_string(props, '$.k') AS DECIMAL(18,2)) + 1000 AS pressure_hpa,
         CAST(json_extract_string(props, '$.k') AS DECIMAL(18,2)) AS wind_speed_mps,
         event_type AS conditions
  FROM events)"""


def location(t: Tables) -> DataFrame:
    """customer with nation and region as the location dimension."""
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("location_id"),
        F.col("c_name").alias("location_name"),
        (F.col("c_acctbal").cast(MONEY) / 1000).cast("decimal(10,8)").alias("latitude"),
        F.col("c_nationkey").cast("decimal(11,8)").alias("longitude"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("region"),
        F.col("c_mktsegment").alias("city"),
        F.col("c_acctbal").cast(MONEY).alias("balance"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("created_at"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("updated_at"),
    )


LOCATION = """location AS (
  SELECT c_custkey AS location_id, c_name AS location_name,
         CAST(CAST(c_acctbal AS DECIMAL(18,2)) / 1000 AS DECIMAL(10,8)) AS latitude,
         CAST(c_nationkey AS DECIMAL(11,8)) AS longitude,
         n_name AS country, r_name AS region, c_mktsegment AS city,
         CAST(c_acctbal AS DECIMAL(18,2)) AS balance,
         TIMESTAMP '2024-01-01 00:00:00' AS created_at, TIMESTAMP '2024-01-01 00:00:00' AS updated_at
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def revision(t: Tables) -> DataFrame:
    """orders as the revision fact: price in whole units as size, priority as editor."""
    return t.orders.select(
        F.col("o_custkey").alias("page_id"),
        F.col("o_orderkey").cast("string").alias("revision_id"),
        F.col("o_orderdate").alias("revision_timestamp"),
        F.col("o_orderdate").alias("fetched_at"),
        F.col("o_orderpriority").alias("revision_user"),
        F.floor("o_totalprice").cast("bigint").alias("content_len"),
    )


REVISION = """revision AS (
  SELECT o_custkey AS page_id, CAST(o_orderkey AS VARCHAR) AS revision_id,
         o_orderdate AS revision_timestamp, o_orderdate AS fetched_at, o_orderpriority AS revision_user,
         CAST(floor(o_totalprice) AS BIGINT) AS content_len
  FROM orders)"""


def page(t: Tables) -> DataFrame:
    """customer as the page dimension: segment as title, nation as language, current unless overdrawn."""
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("page_id"),
        (F.col("c_custkey") + 100000).alias("wikipedia_page_id"),
        F.col("c_mktsegment").alias("page_title"),
        F.col("n_name").alias("page_language"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("valid_from"),
        (F.col("c_acctbal") >= 0).alias("is_current"),
    )


PAGE = """page AS (
  SELECT c_custkey AS page_id, c_custkey + 100000 AS wikipedia_page_id, c_mktsegment AS page_title,
         n_name AS page_language, TIMESTAMP '2024-01-01 00:00:00' AS valid_from,
         c_acctbal >= 0 AS is_current
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

# The daily weather mart over FACT and LOCATION, with the mode spelled out.
WEATHER_MART = """joined AS (
  SELECT location_name, city, country, CAST(observed_at AS DATE) AS observation_date, f.*
  FROM fact f JOIN location l ON f.location_id = l.location_id),
counted AS (
  SELECT location_name, city, country, observation_date, conditions, COUNT(*) AS n
  FROM joined WHERE conditions IS NOT NULL GROUP BY ALL),
modes AS (
  SELECT location_name, city, country, observation_date, conditions AS most_common_conditions
  FROM counted
  QUALIFY row_number() OVER (PARTITION BY location_name, city, country, observation_date
                             ORDER BY n DESC, conditions) = 1),
weather_mart AS (
  SELECT j.location_name, j.city, j.country, j.observation_date,
         COUNT(*) AS observation_count,
         CAST(SUM(temperature_celsius) AS DOUBLE) / COUNT(temperature_celsius) AS avg_temperature_celsius,
         CAST(MIN(temperature_celsius) AS DOUBLE) AS min_temperature_celsius,
         CAST(MAX(temperature_celsius) AS DOUBLE) AS max_temperature_celsius,
         CAST(SUM(humidity_percent) AS DOUBLE) / COUNT(humidity_percent) AS avg_humidity_percent,
         CAST(SUM(pressure_hpa) AS DOUBLE) / COUNT(pressure_hpa) AS avg_pressure_hpa,
         CAST(SUM(wind_speed_mps * CAST(3.6 AS DECIMAL(2,1))) AS DOUBLE) / COUNT(wind_speed_mps)
           AS avg_wind_speed_kmh,
         MAX(m.most_common_conditions) AS most_common_conditions
  FROM joined j LEFT JOIN modes m
    ON j.location_name = m.location_name AND j.city = m.city AND j.country = m.country
   AND j.observation_date = m.observation_date
  GROUP BY j.location_name, j.city, j.country, j.observation_date)"""

PAGE_MART = """page_mart AS (
  SELECT page_title, page_language, CAST(revision_timestamp AS DATE) AS revision_date,
         COUNT(*) AS revision_count, COUNT(DISTINCT revision_user) AS unique_editors,
         CAST(SUM(content_len) AS BIGINT) AS total_bytes_changed,
         CAST(SUM(content_len) AS DOUBLE) / COUNT(content_len) AS avg_bytes_per_revision,
         MIN(content_len) AS min_revision_size, MAX(content_len) AS max_revision_size
  FROM revision r JOIN page p ON r.page_id = p.page_id
  GROUP BY ALL)"""


def sql(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def doubles(df: DataFrame, *columns: str) -> DataFrame:
    """Decimals as DOUBLE, so that both engines return one type."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})
