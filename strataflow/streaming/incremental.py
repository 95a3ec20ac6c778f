"""New raw rows into the hourly fact, each processed once, with the same result as one full batch.

Both apply the newest payload of each location. A payload of a micro-batch that is not the newest one landed is
passed over, as the batch would, so the result is the same whatever the order and the number of micro-batches. Which
one is the newest is kept with the raw table since the payloads were landed, so no other raw row is read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strataflow.operators.merge import not_in
from strataflow.plans import weather
from strataflow.schemas import RAW_WEATHER, REJECT_KEY, WEATHER_KEY
from strataflow.session import staging
from strataflow.sources.tables import Warehouse, months_in


def apply_hours(wh: Warehouse, hours: DataFrame, now: dt.datetime) -> None:
    """Upsert hours into the fact, touching only their months.

    An older payload never replaces a newer one, so micro-batches may come in
    any order and a batch that is replayed after a failure changes nothing.
    """
    months = months_in(hours, "obs_month")
    if months:
        merged = weather.upsert_weather(wh.read("core.weather", months), hours, now, guard=True)
        wh.replace_months("core.weather", merged, months, WEATHER_KEY)


def process_new(
    spark: SparkSession,
    source: str,
    checkpoint: str,
    handle: Callable[[DataFrame, int], None],
    *,
    schema=RAW_WEATHER,
    files_per_batch: int = 1000,
) -> None:
    """Hand all files that the checkpoint has not seen to `handle`, in micro-batches, then stop."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_incremental(
    wh: Warehouse,
    checkpoint: str,
    now: dt.datetime,
    *,
    files_per_batch: int = 1000,
    on_error: str = "entity",
) -> None:
    """Process the raw weather rows that arrived since the last call."""

    raw = wh.batches("raw.weather_observations")
    raw.recover()

    def handle(batch: DataFrame, _: int) -> None:
        with staging(wh.spark):
            parsed = weather.parse_once(weather.newest_of(batch, raw.newest()), wh.read("core.location"))
            wh.append("raw.rejects", not_in(weather.rejected(parsed, on_error), wh.read("raw.rejects"), REJECT_KEY))
            apply_hours(wh, weather.good_hours(parsed, on_error), now)

    process_new(wh.spark, raw.path, checkpoint, handle, schema=raw.stored_schema(), files_per_batch=files_per_batch)
