"""The whole warehouse run: seeds, landing, transforms, quality gate, marts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.functions.times import ntz
from strataflow.operators.keys import placeholder_ids, surrogate_ids
from strataflow.operators.merge import dim_merge_rows, dim_upsert, insert_if_absent, not_in, one_per_key
from strataflow.operators.pick import first_n_per_key
from strataflow.operators.shape import conform
from strataflow.plans import marts, pages, quality, refresh, weather
from strataflow.schemas import LOCATION, LOCATION_KEY, PAGE, PAGE_KEY, REJECT_KEY, REVISION, TABLES, WEATHER_KEY
from strataflow.session import stage, staging
from strataflow.sources.landing import numbered_from, page_envelope, weather_envelope
from strataflow.sources.seeds import location_defaults, page_defaults
from strataflow.sources.tables import Warehouse, months_in, read_version, versions

SEED_KEY = ("name", "latitude", "longitude")
SEEDED = {
    "update_cols": ("country", "region", "city"),
    "id_col": "location_id",
    "created_cols": ("created_at",),
    "touch_cols": ("updated_at",),
}
TITLE_KEY = ("page_title", "page_language")
PAGE_STAMPS = ("first_seen_at", "last_updated_at", "valid_from")
MARTS = ("mart.daily_weather_aggregates", "mart.daily_wikipedia_page_stats")
RAW = ("raw.weather_observations", "raw.wikipedia_pages")
# Under this name runs note how far they have come in the raw tables.
READER = "daily"
REVISION_CHECKPOINT = "wikipedia_revision_checkpoint"


def land_weather(wh: Warehouse, landing: DataFrame, now: dt.datetime) -> None:
    name = "raw.weather_observations"
    wh.append(name, numbered_from(weather_envelope(landing, now), wh.batches(name).highest_id()))


def land_pages(wh: Warehouse, landing: DataFrame, now: dt.datetime) -> None:
    name = "raw.wikipedia_pages"
    wh.append(name, numbered_from(page_envelope(landing, now), wh.batches(name).highest_id()))


def seeded_locations(dim: DataFrame, seeds: DataFrame, now: dt.datetime) -> DataFrame:
    """Location dimension after the seeds: attributes updated, updated_at touched, new ones numbered.

    Seeds are applied in their order, so of several with one key the last counts.
    """
    return dim_upsert(dim, _listed(seeds), LOCATION_KEY, **SEEDED, now=now)


def _listed(seeds: DataFrame) -> DataFrame:
    return location_defaults(one_per_key(seeds, SEED_KEY, ["position"]))


def upsert_location(dim: DataFrame, found: DataFrame, now: dt.datetime) -> DataFrame:
    """Location dimension after a lookup: as for seeds, but updated_at of existing rows stays."""
    return dim_upsert(
        dim,
        found,
        LOCATION_KEY,
        ("country", "region", "city"),
        id_col="location_id",
        now=now,
        created_cols=("created_at", "updated_at"),
    )


def seeded_pages(dim: DataFrame, seeds: DataFrame, now: dt.datetime) -> DataFrame:
    """Page dimension with a placeholder row (negative id) for each seeded title without a current page.

    A title that is listed twice gets one. Ids go on from the lowest ever given, also to versions closed since.
    """
    wanted = first_n_per_key(page_defaults(seeds), TITLE_KEY, [F.col("position").asc()])
    current = dim.filter("is_current")
    fresh = placeholder_ids(wanted, current, "wikipedia_page_id", TITLE_KEY, "position", used=dim)
    fresh = surrogate_ids(fresh, dim, "page_id", ["wikipedia_page_id", "page_language"])
    stamps = {c: ntz(now) for c in PAGE_STAMPS}
    return dim.unionByName(conform(fresh.withColumns({**stamps, "is_current": F.lit(True)}), PAGE))


def apply_seeds(
    location: DataFrame, page: DataFrame, seeds: tuple[DataFrame, DataFrame], now: dt.datetime
) -> tuple[DataFrame, DataFrame]:
    """(location dimension, page dimension) after the seeds."""
    return seeded_locations(location, seeds[0], now), seeded_pages(page, seeds[1], now)


def insert_seeds(
    location: DataFrame, page: DataFrame, seeds: tuple[DataFrame, DataFrame], now: dt.datetime
) -> tuple[DataFrame, DataFrame]:
    """Dimensions after a first load that leaves existing rows alone.

    Unlike `apply_seeds` nothing is updated, and a page's placeholder id is
    -(position + 1), so loading the same seeds twice changes nothing.
    """
    listed = first_n_per_key(seeds[0], SEED_KEY, [F.col("position").asc()])
    places = insert_if_absent(location, location_defaults(listed), LOCATION_KEY)
    places = surrogate_ids(places, location, "location_id", LOCATION_KEY)
    stamped = places.withColumns({c: ntz(now) for c in ("created_at", "updated_at")})
    wanted = page_defaults(seeds[1]).withColumn("wikipedia_page_id", -(F.col("position") + 1).cast("bigint"))
    fresh = insert_if_absent(page, wanted, PAGE_KEY)
    fresh = surrogate_ids(fresh, page, "page_id", PAGE_KEY)
    versions = fresh.withColumns({c: ntz(now) for c in PAGE_STAMPS}).withColumn("is_current", F.lit(True))
    return location.unionByName(conform(stamped, LOCATION)), page.unionByName(conform(versions, PAGE))


def refresh_mart(wh: Warehouse, name: str, build) -> dict:
    """Recompute a whole mart. A failure is reported and leaves the old one readable."""
    try:
        version = wh.replace(name, build())
        rows = wh.read(name).count()
        return {"view_name": name, "status": "success", "version": version, "rows": rows}
    except Exception as error:  # noqa: BLE001 - the run goes on and reports the failure
        return {"view_name": name, "status": "failed", "error": str(error)}


def core_models(wh: Warehouse) -> dict[str, DataFrame]:
    """The core tables as downstream models see them: only current versions of pages."""
    names = ("weather", "location", "revision", "wikipedia_page")
    models = {name: wh.read(f"core.{name}") for name in names}
    return {**models, "wikipedia_page": models["wikipedia_page"].filter("is_current")}


def rebuild_marts(wh: Warehouse) -> list[dict]:
    """Both marts from the whole facts, without the stored days."""
    builders = {
        MARTS[0]: lambda: marts.daily_weather_aggregates(wh.read("core.weather"), wh.read("core.location")),
        MARTS[1]: lambda: marts.daily_page_stats(wh.read("core.revision"), wh.read("core.wikipedia_page")),
    }
    return [refresh_mart(wh, name, build) for name, build in builders.items()]


def refresh_marts(wh: Warehouse, months: Iterable[dt.date] | None = None, *, renames: bool = True) -> list[dict]:
    """Refresh both marts by what has changed since their last refresh; `months` are rebuilt in any case.

    The result is that of `rebuild_marts`; other months keep their files. Without `renames`, rows of other months
    keep the names they were built with.
    """
    refresh.refresh_weather_days(wh, months or ())
    refresh.refresh_page_days(wh)
    forced = {MARTS[0]: months or (), MARTS[1]: ()}
    return [refresh.refresh_mart(wh, name, forced[name], renames=renames) for name in MARTS]


def reject(wh: Warehouse, rows: DataFrame) -> None:
    """Record rejects; those that an earlier run has recorded are left alone."""
    wh.append("raw.rejects", not_in(rows, wh.read("raw.rejects"), REJECT_KEY))


def unapplied(wh: Warehouse, name: str, retry: DataFrame | None = None) -> DataFrame:
    """Raw rows of the batches that no run has got through with, if they are the newest of their key.

    What has been landed since is in folders of its own, so the scan reads nothing else. `retry` (id, b) are older rows
    to be tried again; only their batches are read besides.
    """
    raw = wh.batches(name)
    since = raw.applied(READER)
    newest = raw.newest()
    wanted, also = newest.filter(F.col("b") > since), []
    if retry is not None:
        again = newest.filter(F.col("b") <= since).join(retry.select("id", "b").distinct(), ["id", "b"], "left_semi")
        also = [r.b for r in again.select("b").distinct().collect()]
        wanted = wanted.unionByName(again) if also else wanted
    return raw.read(since, also).join(wanted.select("id", "b"), ["id", "b"], "left_semi").select(*TABLES[name][0].names)


def known_by_now(wh: Warehouse) -> DataFrame:
    """(id, b) of newest weather payloads that were rejected for a location which the dimension has got since then."""
    path, there = wh.path("core.location"), versions(wh.spark, wh.path("core.location"))
    place = wh.read("core.location").select(*LOCATION_KEY)
    seen = wh.noted("finished").get("location")
    if seen in there:
        place = place.join(read_version(wh.spark, path, LOCATION, seen), list(LOCATION_KEY), "left_anti")
    rejected = wh.read("raw.rejects").filter(
        (F.col("source_table") == "weather_observations") & (F.col("reason") == "unknown_location")
    )
    newest = wh.batches("raw.weather_observations").newest().join(place, list(LOCATION_KEY), "left_semi")
    return newest.join(rejected.select(F.col("raw_id").alias("id")).distinct(), "id", "left_semi").select("id", "b")


def transform_weather(
    wh: Warehouse,
    now: dt.datetime,
    on_error: str = "entity",
    raw_since: dt.datetime | None = None,
    *,
    full: bool = False,
) -> dict:
    """Newest payload per location into the hourly fact; only the months it touches are read and written.

    Only batches that were landed since the last finished run are read, and payloads that waited for their location.
    The others have been applied, so the fact is that of a `full` transform, which reads all of raw. `raw_since`
    leaves out raw rows that were loaded earlier.
    """
    name = "raw.weather_observations"
    raw, location = wh.read(name) if full else unapplied(wh, name, known_by_now(wh)), wh.read("core.location")
    if raw_since is not None:
        raw = raw.filter(F.col("ingested_at") >= ntz(raw_since))
    parsed = weather.parse_once(weather.latest_payloads(raw), location)
    reject(wh, weather.rejected(parsed, on_error))
    hours = weather.good_hours(parsed, on_error)
    months = months_in(hours, "obs_month")
    if months:
        merged = weather.upsert_weather(wh.read("core.weather", months), hours, now)
        wh.replace_months("core.weather", merged, months, WEATHER_KEY)
    return {"months": months, **weather.run_metrics(parsed).first().asDict()}


def transform_pages(wh: Warehouse, now: dt.datetime, reconcile_placeholders: bool = True, *, full: bool = False) -> dict:
    """Newest payload per page into the type-2 dimension, then its revision into the fact.

    As with the weather only batches landed since the last finished run are read, unless `full`.
    """
    name = "raw.wikipedia_pages"
    latest = stage(pages.latest_pages(wh.read(name) if full else unapplied(wh, name)), "latest-pages")
    batch = stage(pages.parse_pages(latest, now), "parsed-pages")
    reject(wh, pages.rejected_pages(latest))
    if batch.isEmpty():
        return {"pages_processed": 0, "revisions_inserted": 0}
    merged = pages.merged_pages(wh.read("core.wikipedia_page"), batch, now, reconcile_placeholders=reconcile_placeholders)
    wh.merge_dimension("core.wikipedia_page", merged, "page_id", PAGE_KEY)
    # The surrogates are settled by the write above; facts use what was written.
    added = stage(
        pages.new_revisions(wh.read("core.revision"), batch, wh.read("core.wikipedia_page"), now), "new-revisions"
    )
    inserted = added.count()
    if inserted:
        wh.append("core.revision", added)
    return {"pages_processed": batch.count(), "revisions_inserted": inserted}


def revision_lines(wh: Warehouse) -> DataFrame:
    """The revision suite over the whole fact, of which only the batches are read that came since the last look.

    What earlier batches gave is noted as counts. A key of a new row is looked up among the keys of older rows, and
    its page in the dimension; nothing else of older rows is read.
    """
    table = wh.batches("core.revision")
    seen, last = wh.noted("revision_checks"), table.last_batch()
    totals = {name: list(n) for name, n in seen.get("counts", {}).items()}
    if last > seen.get("batch", 0) or not totals:
        rows = table.read()
        old, new = rows.filter(F.col("b") <= seen.get("batch", 0)), table.read(seen.get("batch", 0))
        suite = quality.revision_suite(wh.read("core.wikipedia_page"))
        counted = quality.rule_counts(new, suite.rules).select("name", "evaluated", "unexpected")
        counted = counted.unionByName(
            quality.reference_line(new, *suite.references).select("name", "evaluated", "unexpected")
        ).unionByName(quality.added_unique_line(old, new, suite.unique).select("name", "evaluated", "unexpected"))
        for line in counted.collect():  # one line per expectation
            was = totals.get(line.name, [0, 0])
            totals[line.name] = [was[0] + line.evaluated, was[1] + line.unexpected]
        wh.note("revision_checks", {"batch": last, "counts": totals})
    return quality.checkpoint_of(
        wh.spark, quality.revision_suite(wh.read("core.wikipedia_page")), totals, REVISION.names, REVISION_CHECKPOINT
    )


def quality_results(
    wh: Warehouse, months: Iterable[dt.date] | None = None, *, all_locations: bool = True, full: bool = False
) -> DataFrame:
    """Both suites, one row per expectation.

    `months` restricts the weather suite to the partitions a run has changed;
    keys cannot repeat across months, so uniqueness stays complete. The minimum of rows
    per location is a rule on the whole fact, counted from its stored days: a location whose fetch fails as a month
    begins still has its earlier rows. The revision suite is on the whole fact as well, added up batch by batch;
    with `full` it reads all of it.
    """
    dim = wh.read("core.location") if all_locations else None
    weather_lines = quality.checkpoint(
        wh.read("core.weather", months),
        quality.weather_suite(dim),
        "weather_fact_checkpoint",
        counted=wh.read("state.weather_days").groupBy("location_id").agg(F.sum("n").alias("n")),
    )
    if not full:
        return weather_lines.unionByName(revision_lines(wh))
    whole = quality.checkpoint(
        wh.read("core.revision"), quality.revision_suite(wh.read("core.wikipedia_page")), REVISION_CHECKPOINT
    )
    return weather_lines.unionByName(whole)


def run_daily(
    spark: SparkSession,
    root: str,
    now: dt.datetime,
    *,
    weather_landing: DataFrame | None = None,
    page_landing: DataFrame | None = None,
    seeds: tuple[DataFrame, DataFrame] | None = None,
    on_error: str = "entity",
    raw_since: dt.datetime | None = None,
    all_locations: bool = True,
    touched_days_only: bool = False,
    full: bool = False,
) -> DataFrame:
    """Run all layers for one batch and return a one-row summary.

    A run first completes what one that died has left unfinished. It reads the raw batches landed since the last run
    that came through, rebuilds the months of the marts that have changed, and checks what is new; with `full` it reads
    all of raw and all facts, to the same result. Raises DataQualityError when the gate fails; the marts then keep their
    previous state, and the next run takes the same batches again and checks the same months. With `all_locations` the
    gate also wants rows for every location. With `touched_days_only` rows of other months keep the names they were
    built with when a dimension row is renamed. Running the same batch again changes no fact row.
    """
    wh = Warehouse(spark, root)
    wh.recover()
    with staging(spark):
        row = _run_layers(
            wh, now, weather_landing, page_landing, seeds, on_error, raw_since, all_locations, touched_days_only, full
        )
    return spark.createDataFrame(
        [tuple(row.values())],
        "locations bigint, weather_payloads bigint, weather_rows_applied bigint, weather_rejected bigint,"
        " pages_processed bigint, revisions_inserted bigint, quality_passed boolean, views_refreshed int,"
        " run_status string",
    )


def _run_layers(
    wh: Warehouse,
    now: dt.datetime,
    weather_landing: DataFrame | None,
    page_landing: DataFrame | None,
    seeds: tuple[DataFrame, DataFrame] | None,
    on_error: str,
    raw_since: dt.datetime | None,
    all_locations: bool,
    touched_days_only: bool,
    full: bool,
) -> dict:
    if seeds is not None:
        places = dim_merge_rows(wh.read("core.location"), _listed(seeds[0]), LOCATION_KEY, **SEEDED, now=now)
        wh.merge_dimension("core.location", places, "location_id", LOCATION_KEY)
        wh.replace("core.wikipedia_page", seeded_pages(wh.read("core.wikipedia_page"), seeds[1], now))
    if weather_landing is not None:
        land_weather(wh, weather_landing, now)
    if page_landing is not None:
        land_pages(wh, page_landing, now)
    landed = {name: wh.batches(name).last_batch() for name in RAW}
    places = max(versions(wh.spark, wh.path("core.location")), default=0)
    weather_run = transform_weather(wh, now, on_error, raw_since, full=full)
    page_run = transform_pages(wh, now, full=full)
    wh.index_titles()
    refresh.refresh_weather_days(wh)
    fact = wh.months("core.weather").state()
    unchecked = refresh.changed_months(fact, wh.noted("weather_gate").get("months", {}))
    months = None if full else [m for m in unchecked if m in fact.months]
    quality.enforce(quality_results(wh, months, all_locations=all_locations, full=full))
    wh.note("weather_gate", {"months": refresh.as_note(fact)})
    refreshed = rebuild_marts(wh) if full else refresh_marts(wh, renames=not touched_days_only)
    if all(r["status"] == "success" for r in refreshed):
        for name, batch in landed.items():
            wh.batches(name).set_applied(READER, batch)
        wh.note("finished", {"location": places})
    wh.expire()
    return {
        "locations": wh.read("core.location").count(),
        "weather_payloads": weather_run["payloads"],
        "weather_rows_applied": weather_run["rows_applied"],
        "weather_rejected": weather_run["rejected"],
        "pages_processed": page_run["pages_processed"],
        "revisions_inserted": page_run["revisions_inserted"],
        "quality_passed": True,
        "views_refreshed": sum(r["status"] == "success" for r in refreshed),
        "run_status": "success" if all(r["status"] == "success" for r in refreshed) else "marts_stale",
    }
