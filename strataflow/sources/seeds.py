"""Seed locations and pages."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from strataflow.schemas import INT, LATITUDE, LONGITUDE, STRING, schema

# The seeded locations (name, latitude, longitude, country, region, city).
SEED_LOCATIONS = [
    ("Boston", "42.3601", "-71.0589", "US", "Massachusetts", "Boston"),
    ("St Louis", "38.6270", "-90.1994", "US", "Missouri", "St. Louis"),
    ("New York", "40.7128", "-74.0060", "US", "New York", "New York"),
    ("Chicago", "41.8781", "-87.6298", "US", "Illinois", "Chicago"),
    ("Los Angeles", "34.0522", "-118.2437", "US", "California", "Los Angeles"),
    ("Miami", "25.7617", "-80.1918", "US", "Florida", "Miami"),
    ("Seattle", "47.6062", "-122.3321", "US", "Washington", "Seattle"),
    ("Denver", "39.7392", "-104.9903", "US", "Colorado", "Denver"),
    ("Phoenix", "33.4484", "-112.0740", "US", "Arizona", "Phoenix"),
    ("Atlanta", "33.7490", "-84.3880", "US", "Georgia", "Atlanta"),
]

# The seeded pages (title, language, namespace).
SEED_PAGES = [
    ("Boston", "en", 0),
    ("St. Louis", "en", 0),
    ("New England", "en", 0),
    ("Cardinals", "en", 0),
]

# Defaults for absent seed fields.
DEFAULT_COUNTRY = "US"
DEFAULT_REGION = ""
DEFAULT_LANGUAGE = "en"
DEFAULT_NAMESPACE = 0

LOCATION_SEED = schema(
    position=INT,
    name=STRING,
    latitude=LATITUDE,
    longitude=LONGITUDE,
    country=STRING,
    region=STRING,
    city=STRING,
)
PAGE_SEED = schema(position=INT, title=STRING, language=STRING, namespace=INT)


def inline_seeds(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """The built-in seeds as (locations, pages)."""
    names = ("name", "latitude", "longitude", "country", "region", "city")
    locations = [dict(zip(names, row, strict=True)) for row in SEED_LOCATIONS]
    pages = [dict(zip(("title", "language", "namespace"), row, strict=True)) for row in SEED_PAGES]
    return seed_frames(spark, locations, pages)


def seed_frames(
    spark: SparkSession, locations: Iterable[Mapping], pages: Iterable[Mapping]
) -> tuple[DataFrame, DataFrame]:
    """Seed records, as a configuration file lists them, to DataFrames without defaults."""

    def lines(records: Iterable[Mapping]) -> list[tuple[str]]:
        return [(json.dumps({"position": i, **r}),) for i, r in enumerate(records)]

    def frame(records: Iterable[Mapping], kind: StructType) -> DataFrame:
        text = spark.createDataFrame(lines(records), "line string")
        return text.select(F.from_json("line", kind).alias("s")).select("s.*")

    return frame(locations, LOCATION_SEED), frame(pages, PAGE_SEED)


def read_seeds(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Seeds from a JSON document {"locations": [...], "wikipedia_pages": [...]}."""
    parts = {"locations": LOCATION_SEED, "wikipedia_pages": PAGE_SEED}
    document = StructType([StructField(name, ArrayType(entry)) for name, entry in parts.items()])
    whole = spark.read.schema(document).json(path, multiLine=True)

    def rows(part: str) -> DataFrame:
        listed = whole.select(F.posexplode(part).alias("__pos", "s"))
        rest = [F.col(f"s.{name}") for name in parts[part].names if name != "position"]
        return listed.select(F.coalesce("s.position", "__pos").alias("position"), *rest)

    return rows("locations"), rows("wikipedia_pages")


def location_defaults(seeds: DataFrame) -> DataFrame:
    """Location rows with defaults for absent fields: country, region, and city = name."""
    return seeds.select(
        F.col("name").alias("location_name"),
        "latitude",
        "longitude",
        F.coalesce("country", F.lit(DEFAULT_COUNTRY)).alias("country"),
        F.coalesce("region", F.lit(DEFAULT_REGION)).alias("region"),
        F.coalesce("city", "name").alias("city"),
    )


def page_defaults(seeds: DataFrame) -> DataFrame:
    """Page rows with defaults for absent fields: language and namespace."""
    return seeds.select(
        "position",
        F.col("title").alias("page_title"),
        F.coalesce("language", F.lit(DEFAULT_LANGUAGE)).alias("page_language"),
        F.coalesce("namespace", F.lit(DEFAULT_NAMESPACE)).alias("namespace"),
    )
