"""Raw weather payloads to the hourly fact."""

from __future__ import annotations

import datetime as dt
import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions.numbers import kmh_to_mps, narrow
from strataflow.functions.text import filled
from strataflow.functions.times import has_offset, iso_to_utc, month_of, ntz
from strataflow.operators.aggregate import count_if
from strataflow.operators.merge import merge_upsert
from strataflow.operators.payload import parallel_elements
from strataflow.operators.pick import latest_per_key
from strataflow.schemas import LOCATION_KEY, MEASURES, RAW_REF, WEATHER_KEY, WEATHER_PAYLOAD
from strataflow.session import stage

# Fact measure -> payload array.
SOURCES = {
    "temperature_celsius": "temperature_2m",
    "humidity_percent": "relativehumidity_2m",
    "wind_speed_mps": "windspeed_10m",
    "precipitation_mm": "precipitation",
    "cloud_cover_percent": "cloudcover",
}
UPDATED = (*MEASURES, "raw_ref")
# Of several values for one (location, hour), the newest payload's last array position counts.
NEWEST = ("ingested_at", "raw_id", "pos")


def guard_reason(payload: Column, hourly: Column, location_id: Column) -> Column:
    """Why a payload is skipped, or NULL."""
    arrays = [hourly[a].isNull() for a in ("time", *SOURCES.values())]
    nothing = hourly.isNull() | functools.reduce(operator.and_, arrays)
    return (
        F.when(filled(F.trim(payload)).isNull(), "no_payload")
        .when(nothing, "no_hourly")
        .when(location_id.isNull(), "unknown_location")
        .when(~F.coalesce(F.size(hourly["time"]) > 0, F.lit(False)), "no_time")
    )


def _observed_at(text: Column, offset_seconds: Column) -> Column:
    """UTC time of an array element; text without an own offset is local to the payload's offset."""
    shift = F.when(has_offset(text), F.lit(0)).otherwise(F.coalesce(offset_seconds, F.lit(0)))
    return F.timestamp_add("SECOND", -shift, iso_to_utc(text))


def _typed(hours: DataFrame) -> DataFrame:
    """Element texts to the fact's types, and what is wrong with an hour.

    In two projections, the second over the results of the first: as one, the
    casts would be repeated in a generated method too long for the JIT compiler.
    """
    texts = {m: F.col(f"text_{m}") for m in SOURCES}
    stored = {
        m: narrow(kmh_to_mps(text.try_cast("double"))) if m == "wind_speed_mps" else narrow(text)
        for m, text in texts.items()
    }
    observed = _observed_at(F.col("driver"), F.col("utc_offset_seconds"))
    first = hours.withColumns({**stored, "observed_at": observed})

    def any_of(conditions: list[Column]) -> Column:
        return functools.reduce(operator.or_, conditions)

    unstored = any_of([text.isNotNull() & F.col(m).isNull() for m, text in texts.items()])
    no_number = any_of([text.isNotNull() & text.try_cast("double").isNull() for text in texts.values()])
    problem = F.when(F.col("observed_at").isNull(), "bad_time").when(
        unstored, F.when(no_number, "bad_value").otherwise("overflow")
    )
    return first.withColumn("problem", F.when(F.col("reason").isNull(), problem))


PARSED = (
    "raw_id",
    "location_name",
    "location_id",
    "ingested_at",
    "reason",
    "pos",
    "observed_at",
    *MEASURES,
    "problem",
)


def parse_payloads(raw: DataFrame, location: DataFrame) -> DataFrame:
    """One row per hour of each payload, typed and converted; one row without an hour for a skipped payload.

    `reason` says why a payload is skipped, `problem` what is wrong with an
    hour. Each payload is parsed once and only the explode is interpreted; the
    typing after it runs in generated code. `inline` keeps the optimizer from
    copying the JSON parse into every reference to a field.
    """
    dim = location.select("location_id", *LOCATION_KEY)
    doc = F.inline(F.array(F.from_json("payload", WEATHER_PAYLOAD))).alias("utc_offset_seconds", "hourly")
    docs = raw.join(dim, list(LOCATION_KEY), "left").select(
        F.col("id").alias("raw_id"), "location_name", "location_id", "ingested_at", "payload", doc
    )
    hourly = F.col("hourly")
    reason = guard_reason(F.col("payload"), hourly, F.col("location_id"))
    elements = parallel_elements(hourly["time"], {f"text_{m}": hourly[array] for m, array in SOURCES.items()})
    kept = ("raw_id", "location_name", "location_id", "ingested_at", "utc_offset_seconds", "reason")
    # The arrays are zipped one step before the explode, which then carries no array along.
    zipped = docs.withColumn("reason", reason).select(
        *kept, F.when(F.col("reason").isNull(), elements).alias("hours")
    )
    hours = zipped.select(*kept, F.inline_outer("hours"))
    return _typed(hours).select(*PARSED)


def parse_once(raw: DataFrame, location: DataFrame) -> DataFrame:
    """`parse_payloads`, staged: good hours, rejects and counts then read typed columns, not JSON."""
    return stage(parse_payloads(raw, location), "parsed-weather")


def _voided(parsed: DataFrame) -> DataFrame:
    """The first problem of each payload that has one."""
    return (
        parsed.filter(F.col("problem").isNotNull())
        .groupBy("raw_id", "location_name")
        .agg(F.min_by("problem", "pos").alias("reason"))
    )


def good_hours(parsed: DataFrame, on_error: str = "entity") -> DataFrame:
    """Hourly rows ready for the fact. With on_error='entity' one bad hour voids its payload, with 'row' only itself.

    Voided payloads are one row each, so where they are few Spark broadcasts them and the hours stay in place.
    """
    hours = parsed.filter(F.col("reason").isNull() & F.col("problem").isNull())
    if on_error == "entity":
        hours = hours.join(_voided(parsed).select("raw_id"), "raw_id", "left_anti")
    return (
        hours.withColumn("raw_ref", raw_ref("weather_observations", F.col("location_name")))
        .withColumn("obs_month", month_of(F.col("observed_at")))
        .drop("problem", "reason", "location_name")
    )


def rejected(parsed: DataFrame, on_error: str = "entity") -> DataFrame:
    """Rejects with their reason: one per payload, or one per bad hour with on_error='row'."""
    skipped = parsed.filter(F.col("reason").isNotNull()).select("raw_id", "location_name", "reason")
    if on_error == "row":
        bad = parsed.filter(F.col("problem").isNotNull()).select(
            "raw_id", "location_name", F.col("problem").alias("reason")
        )
    else:
        bad = _voided(parsed)
    return skipped.unionByName(bad).select(
        F.lit("weather_observations").alias("source_table"), "raw_id", F.col("location_name").alias("entity"), "reason"
    )


def raw_ref(table: str, name: Column) -> Column:
    """Lineage struct of a core row: where it came from."""
    return F.struct(
        F.lit(table).alias("raw_table"),
        F.col("raw_id").alias("raw_id"),
        name.alias("name"),
        F.col("ingested_at").alias("ingested_at"),
    ).cast(RAW_REF)


def latest_payloads(raw: DataFrame) -> DataFrame:
    """The newest payload per (name, latitude, longitude)."""
    return latest_per_key(raw, LOCATION_KEY, "ingested_at", ["id"])


def newest_of(batch: DataFrame, newest: DataFrame) -> DataFrame:
    """The batch rows that are the newest payload of their location, by the table of newest rows (id, b) of all that landed."""
    return latest_payloads(batch).join(newest.select("id", "b"), ["id", "b"], "left_semi")


def parse_weather(raw: DataFrame, location: DataFrame, on_error: str = "entity") -> tuple[DataFrame, DataFrame]:
    """(good hourly rows, rejects) from the newest payload of each location."""
    parsed = parse_once(latest_payloads(raw), location)
    return good_hours(parsed, on_error), rejected(parsed, on_error)


def upsert_weather(fact: DataFrame, hours: DataFrame, now: dt.datetime, *, guard: bool = False) -> DataFrame:
    """Fact after applying the hours: measures and lineage replaced, created_at kept.

    With `guard`, hours from an older payload never replace those of a newer one; of
    payloads loaded at one time that with the higher id is the newer.
    """
    return merge_upsert(
        fact,
        hours,
        WEATHER_KEY,
        UPDATED,
        last_by=NEWEST,
        insert_values={"created_at": ntz(now)},
        guard=("raw_ref.ingested_at", "raw_ref.raw_id") if guard else (),
    )


def trace_to_raw(core: DataFrame, raw: DataFrame, columns: list[str]) -> DataFrame:
    """Core rows with the columns of the raw row that `raw_ref` points to."""
    source = raw.select(F.col("id").alias("__raw_id"), *[F.col(c).alias(f"raw_{c}") for c in columns])
    return core.join(source, F.col("raw_ref.raw_id") == F.col("__raw_id")).drop("__raw_id")


def run_metrics(parsed: DataFrame) -> DataFrame:
    """One row of counts over parsed payloads: what was processed, applied and rejected.

    Hours are counted per payload first, so a busy location is combined before it is grouped.
    """
    payloads = parsed.groupBy("raw_id", "location_id").agg(
        F.count("pos").alias("hours"),
        (F.count("reason") + F.count("problem") == 0).alias("sound"),
    )
    per_location = payloads.groupBy("location_id").agg(
        F.count(F.lit(1)).alias("payloads"),
        count_if(F.col("sound")).alias("applied"),
        F.sum(F.when(F.col("sound"), F.col("hours")).otherwise(0)).alias("rows_applied"),
    )
    return per_location.agg(
        F.coalesce(F.sum("payloads"), F.lit(0)).alias("payloads"),
        F.coalesce(F.sum(F.col("payloads") - F.col("applied")), F.lit(0)).alias("rejected"),
        F.coalesce(F.sum("applied"), F.lit(0)).alias("applied"),
        count_if(F.col("applied") > 0).alias("locations_processed"),
        F.coalesce(F.sum("rows_applied"), F.lit(0)).alias("rows_applied"),
    )
