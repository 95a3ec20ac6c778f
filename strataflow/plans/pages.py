"""Raw page payloads to the type-2 page dimension and the revision fact."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions.text import filled, namespace_id
from strataflow.functions.times import iso_or, ntz
from strataflow.operators.merge import rows_to_insert
from strataflow.operators.pick import latest_per_key
from strataflow.operators.scd import scd2_apply, scd2_merge_rows
from strataflow.plans.weather import raw_ref
from strataflow.schemas import PAGE_KEY, PAGE_PAYLOAD, REVISION_KEY

PAGE_CREATED = ("first_seen_at", "last_updated_at")


def latest_pages(raw: DataFrame, keys: Sequence[str] = ("page_id", "page_language")) -> DataFrame:
    """The newest payload per page.

    By page id, so that a renamed page has one newest payload, and by title where there
    is no id (0, the envelope's fallback); pass ("page_title", "page_language") for one per title.
    """
    title = F.when(F.coalesce("page_id", F.lit(0)) == 0, F.col("page_title")).alias("__title")
    return latest_per_key(raw.select("*", title), [*keys, "__title"], "ingested_at", ["id"]).drop("__title")


def _without_id(doc: Column) -> Column:
    """Whether neither the payload nor the envelope names a page id."""
    return doc["pageid"].try_cast("bigint").isNull() & (F.coalesce("page_id", F.lit(0)) == 0)


def parse_pages(latest: DataFrame, now: dt.datetime) -> DataFrame:
    """Page fields from the payload, each falling back to the envelope column, timestamps to `now` at last.

    Pages without any id cannot be told apart in the dimension; they are rejected.
    """
    doc = F.col("doc")
    return (
        latest.filter(filled(F.trim("payload")).isNotNull())
        .withColumn("doc", F.from_json("payload", PAGE_PAYLOAD))
        .filter(~_without_id(doc))
        .select(
            F.col("id").alias("raw_id"),
            F.coalesce(doc["pageid"].try_cast("bigint"), F.col("page_id")).alias("wikipedia_page_id"),
            F.coalesce(doc["title"], F.col("page_title")).alias("page_title"),
            namespace_id(doc["namespace"]).alias("namespace"),
            "page_language",
            F.coalesce(doc["revision"], F.col("revision_id")).alias("revision_id"),
            iso_or(doc["timestamp"], F.col("revision_timestamp"), ntz(now)).alias("revision_timestamp"),
            F.coalesce(F.col("revision_size_bytes"), F.lit(0)).alias("content_len"),
            F.col("page_title").alias("requested_title"),
            "ingested_at",
        )
    )


def rejected_pages(latest: DataFrame) -> DataFrame:
    no_id = _without_id(F.from_json("payload", PAGE_PAYLOAD))
    reason = F.when(filled(F.trim("payload")).isNull(), "no_payload").when(F.coalesce(no_id, F.lit(True)), "no_page_id")
    return latest.select(
        F.lit("wikipedia_pages").alias("source_table"),
        F.col("id").alias("raw_id"),
        F.col("page_title").alias("entity"),
        reason.alias("reason"),
    ).filter("reason IS NOT NULL")


def upsert_pages(
    dim: DataFrame, pages: DataFrame, now: dt.datetime, *, reconcile_placeholders: bool = False
) -> DataFrame:
    """Page dimension after the batch: a changed title closes the current version and opens a new one.

    With `reconcile_placeholders`, a seeded placeholder (negative id) is closed
    once a real page with its title and language is in the batch.
    """
    return scd2_apply(
        _reconciled(dim, pages, now) if reconcile_placeholders else dim,
        pages,
        PAGE_KEY,
        "page_title",
        now,
        id_col="page_id",
        created_cols=PAGE_CREATED,
    )


def merged_pages(dim: DataFrame, pages: DataFrame, now: dt.datetime, *, reconcile_placeholders: bool = False) -> DataFrame:
    """`upsert_pages` in one pass over the dimension; new versions are marked and not numbered yet."""
    return scd2_merge_rows(
        _reconciled(dim, pages, now) if reconcile_placeholders else dim,
        pages,
        PAGE_KEY,
        "page_title",
        now,
        id_col="page_id",
        created_cols=PAGE_CREATED,
    )


def _reconciled(dim: DataFrame, pages: DataFrame, now: dt.datetime) -> DataFrame:
    """The dimension without current placeholders for titles of the batch."""
    real = pages.select("page_title", "page_language", F.lit(True).alias("__real")).distinct()
    closing = F.col("__real").isNotNull() & (F.col("wikipedia_page_id") < 0) & F.col("is_current")
    return dim.join(real, ["page_title", "page_language"], "left").select(
        *[
            F.when(closing, ntz(now)).otherwise(F.col(c)).alias(c)
            if c == "valid_to"
            else (F.col(c) & ~closing).alias(c)
            if c == "is_current"
            else F.col(c)
            for c in dim.columns
        ]
    )


def new_revisions(
    revision: DataFrame, pages: DataFrame, dim: DataFrame, now: dt.datetime
) -> DataFrame:
    """Revision rows to append: known (page, revision) pairs are left alone.

    `dim` is the dimension *after* the batch, read back from where it was
    written, so that the surrogates are settled.
    """
    current = dim.filter("is_current").select("page_id", *PAGE_KEY)
    batch = pages.join(current, list(PAGE_KEY)).select(
        "page_id",
        "revision_id",
        "revision_timestamp",
        "content_len",
        ntz(now).alias("fetched_at"),
        raw_ref("wikipedia_pages", F.col("requested_title")).alias("raw_ref"),
        ntz(now).alias("created_at"),
        "raw_id",
    )
    return rows_to_insert(revision, batch, REVISION_KEY, first_by=["raw_id"]).drop("raw_id")
