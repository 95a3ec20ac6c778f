"""Landed API responses to raw envelopes. Raw tables are append-only."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.functions.text import namespace_id
from strataflow.functions.times import iso_or, ntz
from strataflow.operators.shape import conform
from strataflow.schemas import PAGE_PAYLOAD, RAW_PAGES, RAW_WEATHER

# Source labels of the two feeds.
WEATHER_SOURCE = "open-meteo"
PAGE_SOURCE = "mediawiki-rest-api"

# Landing files are JSON lines, one response per line, with the payload as JSON text.
WEATHER_LANDING = "location_name STRING, latitude DECIMAL(10,8), longitude DECIMAL(11,8), payload STRING"
PAGE_LANDING = "page_title STRING, page_language STRING, payload STRING, content_size INT"


def read_landing(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Landed JSON lines. A nested payload object is read as its JSON text."""
    return spark.read.schema(schema).json(path)


def request_window(now: dt.datetime) -> tuple[dt.datetime, dt.datetime]:
    """The data window of one batch: yesterday 00:00 up to the end of the day a week ahead."""
    midnight = now.replace(hour=0, minute=0, second=0, microsecond=0)
    return midnight - dt.timedelta(days=1), midnight + dt.timedelta(days=8)


def weather_envelope(landing: DataFrame, now: dt.datetime) -> DataFrame:
    """Weather landing rows with audit columns; `id` is given when the rows are appended."""
    return conform(
        landing.withColumn("ingested_at", ntz(now)).withColumn("source", F.lit(WEATHER_SOURCE)), RAW_WEATHER
    ).drop("id")


def page_envelope(landing: DataFrame, now: dt.datetime) -> DataFrame:
    """Page landing rows with the envelope fields lifted out of the payload.

    Missing parts fall back: title to the requested one, timestamp to `now`,
    page id and namespace to 0, revision id to the empty text.
    """
    doc, stamp = F.col("doc"), ntz(now)
    lifted = landing.withColumn("doc", F.from_json("payload", PAGE_PAYLOAD)).select(
        F.coalesce(doc["pageid"].try_cast("bigint"), F.lit(0)).alias("page_id"),
        F.coalesce(doc["title"], F.col("page_title")).alias("page_title"),
        namespace_id(doc["namespace"]).alias("namespace"),
        F.coalesce(doc["revision"], F.lit("")).alias("revision_id"),
        iso_or(doc["timestamp"], stamp).alias("revision_timestamp"),
        F.col("content_size").alias("revision_size_bytes"),
        F.coalesce(F.col("page_language"), F.lit("en")).alias("page_language"),
        "payload",
        stamp.alias("ingested_at"),
        F.lit(PAGE_SOURCE).alias("source"),
    )
    return conform(lifted, RAW_PAGES).drop("id")


def numbered_from(envelope: DataFrame, highest: int) -> DataFrame:
    """Unique ids above the highest one given so far, without a shuffle; gaps are allowed as in a sequence."""
    return envelope.select((F.lit(highest + 1) + F.monotonically_increasing_id()).alias("id"), "*")


def with_raw_ids(envelope: DataFrame, existing: DataFrame) -> DataFrame:
    """`numbered_from` for rows that are at hand only as a table; a warehouse has its highest id in the log."""
    return numbered_from(envelope, existing.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0])
