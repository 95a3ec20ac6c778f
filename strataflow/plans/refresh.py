"""Marts kept up by what has changed since their last refresh.

Between the facts and the marts are tables of partial aggregates, a row per key and day, in month folders. Every marker
notes what it was made from: the days of the weather fact's months the versions of these months, those of the revisions
the last batch added, a mart the versions of its days and of its dimension. A refresh compares the notes with what is
there now and rebuilds the months that differ, whatever has changed them: a run, a backfill, a delete, an archive.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.functions.times import month_of
from strataflow.plans import marts
from strataflow.schemas import TABLES
from strataflow.sources.months import State
from strataflow.sources.tables import MONTH, Warehouse, months_in, read_version, versions

# Mart -> (days, dimension, its key, the columns that a mart shows of it, how the mart is made).
MADE_OF: dict[str, tuple[str, str, str, Sequence[str], Callable[[DataFrame, DataFrame], DataFrame]]] = {
    "mart.daily_weather_aggregates": (
        "state.weather_days",
        "core.location",
        "location_id",
        ("location_name", "city", "country"),
        marts.weather_mart_of,
    ),
    "mart.daily_wikipedia_page_stats": (
        "state.page_days",
        "core.wikipedia_page",
        "page_id",
        ("page_title", "page_language"),
        marts.page_mart_of,
    ),
}


def as_note(state: State) -> dict[str, str]:
    return {m.isoformat(): v for m, v in state.months.items()}


def changed_months(state: State, noted: dict[str, str]) -> list[dt.date]:
    """Months that have another version than the one noted, new ones and vanished ones included."""
    now = as_note(state)
    return sorted(dt.date.fromisoformat(m) for m in {*now, *noted} if now.get(m) != noted.get(m))


def refresh_weather_days(wh: Warehouse, also: Iterable[dt.date] = ()) -> list[dt.date]:
    """Sum up the months of the weather fact that have changed; returns them."""
    fact, days = wh.months("core.weather"), wh.months("state.weather_days")
    now = fact.state()
    stale = sorted({*changed_months(now, days.state().notes.get("fact", {})), *also})
    if stale:
        fresh = marts.weather_days(fact.read([m for m in stale if m in now.months], now))
        wh.replace_months("state.weather_days", fresh, stale, notes={"fact": as_note(now)})
    return stale


def refresh_page_days(wh: Warehouse) -> list[dt.date]:
    """Add the batches of revisions that have come since; returns the months they touch."""
    revisions, days = wh.batches("core.revision"), wh.months("state.page_days")
    seen, last = days.state().notes.get("batch", 0), revisions.last_batch()
    if last == seen:
        return []
    added = revisions.read(seen).filter(F.col("b") <= last)
    fresh = marts.page_days(added)
    touched = months_in(fresh.select(month_of(F.col("revision_date")).alias(MONTH)), MONTH)
    merged = marts.merged_page_days(wh.read("state.page_days", touched).unionByName(fresh))
    wh.replace_months("state.page_days", merged, touched, notes={"batch": last})
    return touched


def renamed_months(wh: Warehouse, mart: str, noted: int) -> list[dt.date]:
    """Months of days whose dimension row shows other names now than in the version noted."""
    days, dim, key, shown, _ = MADE_OF[mart]
    there = versions(wh.spark, wh.path(dim))
    if not there or there[-1] == noted:
        return []
    if noted not in there:  # expired: all months may be concerned
        return wh.stored_months(days)
    old, new = (read_version(wh.spark, wh.path(dim), TABLES[dim][0], v).select(key, *shown) for v in (noted, there[-1]))
    other = new.exceptAll(old).unionByName(old.exceptAll(new)).select(key).distinct()
    stored = wh.months(days).read()
    return months_in(stored.join(other, key, "left_semi").select(MONTH), MONTH)


def refresh_mart(wh: Warehouse, mart: str, also: Iterable[dt.date] = (), *, renames: bool = True) -> dict:
    """Rebuild the months of a mart whose days or names have changed. A failure leaves the mart as it was.

    Without `renames`, rows of other months keep the names they were built with.
    """
    try:
        days, dim, _, _, build = MADE_OF[mart]
        now, noted = wh.months(days).state(), wh.months(mart).state().notes
        there = versions(wh.spark, wh.path(dim))
        stale = {*changed_months(now, noted.get("days", {})), *also}
        if renames:
            stale |= set(renamed_months(wh, mart, noted.get("dim", 0)))
        shown = there[-1] if there and (renames or "dim" not in noted) else noted.get("dim", 0)
        if stale:
            fresh = build(wh.months(days).read([m for m in stale if m in now.months], now), wh.read(dim))
            wh.replace_months(mart, fresh, stale, notes={"days": as_note(now), "dim": shown})
        rows = wh.read(mart).count()
        version = wh.months(mart).state().number
        return {"view_name": mart, "status": "success", "version": version, "rows": rows, "months": sorted(stale)}
    except Exception as error:  # noqa: BLE001 - the run goes on and reports the failure
        return {"view_name": mart, "status": "failed", "error": str(error)}
