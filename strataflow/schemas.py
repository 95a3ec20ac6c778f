"""Declared schemas of the raw, core and mart tables, payload contracts and quality thresholds."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

INT, BIGINT, DOUBLE, BOOLEAN = IntegerType(), LongType(), DoubleType(), BooleanType()
STRING, DATE, TIMESTAMP = StringType(), DateType(), TimestampNTZType()
LATITUDE, LONGITUDE = DecimalType(10, 8), DecimalType(11, 8)
MEASURE, PRESSURE = DecimalType(5, 2), DecimalType(7, 2)

# Natural keys (UNIQUE constraints).
LOCATION_KEY = ("location_name", "latitude", "longitude")
PAGE_KEY = ("wikipedia_page_id", "page_language")
WEATHER_KEY = ("location_id", "observed_at")
REVISION_KEY = ("page_id", "revision_id")
REJECT_KEY = ("source_table", "raw_id", "reason")

MEASURES = (
    "temperature_celsius",
    "humidity_percent",
    "wind_speed_mps",
    "precipitation_mm",
    "cloud_cover_percent",
)


def schema(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


RAW_WEATHER = schema(
    id=BIGINT,
    location_name=STRING,
    latitude=LATITUDE,
    longitude=LONGITUDE,
    payload=STRING,
    ingested_at=TIMESTAMP,
    source=STRING,
)

RAW_PAGES = schema(
    id=BIGINT,
    page_id=BIGINT,
    page_title=STRING,
    namespace=INT,
    revision_id=STRING,
    revision_timestamp=TIMESTAMP,
    revision_size_bytes=INT,
    page_language=STRING,
    payload=STRING,
    ingested_at=TIMESTAMP,
    source=STRING,
)

LOCATION = schema(
    location_id=BIGINT,
    location_name=STRING,
    latitude=LATITUDE,
    longitude=LONGITUDE,
    country=STRING,
    region=STRING,
    city=STRING,
    created_at=TIMESTAMP,
    updated_at=TIMESTAMP,
)

PAGE = schema(
    page_id=BIGINT,
    wikipedia_page_id=BIGINT,
    page_title=STRING,
    namespace=INT,
    page_language=STRING,
    first_seen_at=TIMESTAMP,
    last_updated_at=TIMESTAMP,
    valid_from=TIMESTAMP,
    valid_to=TIMESTAMP,
    is_current=BOOLEAN,
)

RAW_REF = schema(raw_table=STRING, raw_id=BIGINT, name=STRING, ingested_at=TIMESTAMP)

# pressure, km/h wind, direction and conditions are declared but no feed fills them.
WEATHER = schema(
    location_id=BIGINT,
    observed_at=TIMESTAMP,
    temperature_celsius=MEASURE,
    humidity_percent=MEASURE,
    pressure_hpa=PRESSURE,
    wind_speed_kmh=MEASURE,
    wind_direction_degrees=INT,
    conditions=STRING,
    wind_speed_mps=MEASURE,
    precipitation_mm=MEASURE,
    cloud_cover_percent=MEASURE,
    raw_ref=RAW_REF,
    created_at=TIMESTAMP,
    obs_month=DATE,
)

REVISION = schema(
    page_id=BIGINT,
    revision_id=STRING,
    revision_timestamp=TIMESTAMP,
    revision_user=STRING,
    content_len=INT,
    revision_number=BIGINT,
    fetched_at=TIMESTAMP,
    raw_ref=RAW_REF,
    created_at=TIMESTAMP,
)

REJECTS = schema(source_table=STRING, raw_id=BIGINT, entity=STRING, reason=STRING)

DAILY_WEATHER = schema(
    location_name=STRING,
    city=STRING,
    country=STRING,
    observation_date=DATE,
    observation_count=BIGINT,
    avg_temperature_celsius=DOUBLE,
    min_temperature_celsius=MEASURE,
    max_temperature_celsius=MEASURE,
    avg_humidity_percent=DOUBLE,
    avg_pressure_hpa=DOUBLE,
    avg_wind_speed_kmh=DOUBLE,
    most_common_conditions=STRING,
)

DAILY_PAGES = schema(
    page_title=STRING,
    page_language=STRING,
    revision_date=DATE,
    revision_count=BIGINT,
    unique_editors=BIGINT,
    total_bytes_changed=BIGINT,
    avg_bytes_per_revision=DOUBLE,
    min_revision_size=INT,
    max_revision_size=INT,
)

# Partial aggregates per key and day that the marts are made of; sums and counts of many can be added up.
SUM = DecimalType(15, 2)
WEATHER_DAYS = schema(
    location_id=BIGINT,
    observation_date=DATE,
    conditions=STRING,
    n=BIGINT,
    sum_temperature_celsius=SUM,
    n_temperature_celsius=BIGINT,
    sum_humidity_percent=SUM,
    n_humidity_percent=BIGINT,
    sum_pressure_hpa=DecimalType(17, 2),
    n_pressure_hpa=BIGINT,
    sum_wind_speed_mps=SUM,
    n_wind_speed_mps=BIGINT,
    lo=MEASURE,
    hi=MEASURE,
)

PAGE_DAYS = schema(
    page_id=BIGINT,
    revision_date=DATE,
    revision_user=STRING,
    n=BIGINT,
    total=BIGINT,
    sized=BIGINT,
    lo=INT,
    hi=INT,
)

# Table name -> (schema, partition column).
TABLES: dict[str, tuple[StructType, str | None]] = {
    "raw.weather_observations": (RAW_WEATHER, None),
    "raw.wikipedia_pages": (RAW_PAGES, None),
    "raw.rejects": (REJECTS, None),
    "core.location": (LOCATION, None),
    "core.wikipedia_page": (PAGE, None),
    "core.weather": (WEATHER, "obs_month"),
    "core.revision": (REVISION, None),
    "state.weather_days": (WEATHER_DAYS, None),
    "state.page_days": (PAGE_DAYS, None),
    "mart.daily_weather_aggregates": (DAILY_WEATHER, None),
    "mart.daily_wikipedia_page_stats": (DAILY_PAGES, None),
}

# Tables of logged batches -> the column that says when a row was loaded.
BATCHED = {
    "raw.weather_observations": "ingested_at",
    "raw.wikipedia_pages": "ingested_at",
    "core.revision": "fetched_at",
}

# Tables in month folders -> the column that a row's month comes from.
DAY_OF = {
    "core.weather": "observed_at",
    "state.weather_days": "observation_date",
    "state.page_days": "revision_date",
    "mart.daily_weather_aggregates": "observation_date",
    "mart.daily_wikipedia_page_stats": "revision_date",
}

# Keys: of a table in month folders its columns, of a raw table the SQL of those whose newest row counts.
# A page is known by its id, and by its title where there is none.
KEYS = {
    "core.weather": WEATHER_KEY,
    "raw.weather_observations": {c: c for c in LOCATION_KEY},
    "raw.wikipedia_pages": {
        "page_id": "page_id",
        "page_language": "page_language",
        "untold_title": "CASE WHEN coalesce(page_id, 0) = 0 THEN page_title END",
    },
}

# Payload contracts. Value arrays are read as text: with ARRAY<DOUBLE> one
# element that is not a number would turn the whole array into NULL.
WEATHER_ARRAYS = ("temperature_2m", "relativehumidity_2m", "precipitation", "cloudcover", "windspeed_10m")
WEATHER_PAYLOAD = schema(
    utc_offset_seconds=INT,
    hourly=schema(time=ArrayType(STRING), **{name: ArrayType(STRING) for name in WEATHER_ARRAYS}),
)

# Fields that may arrive as a number, a text or an object are read as text.
PAGE_PAYLOAD = schema(
    pageid=STRING,
    title=STRING,
    namespace=STRING,
    revision=STRING,
    timestamp=STRING,
)
PAGE_SUMMARY = schema(
    title=STRING,
    extract=STRING,
    content_urls=schema(desktop=schema(page=STRING)),
    thumbnail=STRING,
    description=STRING,
    pageid=STRING,
)

# Documented quality bounds.
TEMPERATURE_RANGE = (-50, 60)
HUMIDITY_RANGE = (0, 100)
WIND_RANGE = (0, 200)
MOSTLY = 0.95
MIN_ROWS_PER_LOCATION = 1
QUALITY_BATCH_ROWS = 1000
WEATHER_REQUIRED = ("location_id", "observed_at", "temperature_celsius", "humidity_percent", "wind_speed_mps")
REVISION_REQUIRED = ("page_id", "revision_id", "content_len")

# Reconciliation tolerances.
TOLERANCES = {"temperature_celsius": 1.0, "humidity_percent": 5.0, "wind_speed_mps": 0.5}
