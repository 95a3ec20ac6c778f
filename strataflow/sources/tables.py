"""The warehouse on a shared file system: `<root>/<layer>/<table>`, Parquet throughout.

Four layouts, by how a table changes:

* batches: raw tables and revisions (`ingest`). Each batch is a folder of its own and has an entry in a log.
* versions: dimensions. A refresh writes `v=<n>` next to the old version. Readers take the newest version that has
  its `_SUCCESS` file, which Spark writes last, so they never see a half-written table and a failed refresh leaves
  the old one in place.
* months: the hourly fact, the daily partial aggregates and the marts (`months`). A change writes new versions of the
  month folders it touches, and switches to all of them by one marker.
* append: rejects.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import json
import re
import uuid
from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, StructType

from strataflow.functions.times import month_of, months_touched
from strataflow.operators import merge
from strataflow.operators.keys import dense_ids
from strataflow.operators.shape import conform
from strataflow.schemas import BATCHED, DAY_OF, KEYS, TABLES
from strataflow.session import file_system
from strataflow.sources.files import child_names, lease, leased, move, path_exists, read_text, remove, write_text
from strataflow.sources.ingest import RawTable
from strataflow.sources.lookup import TitleLookup
from strataflow.sources.months import MonthTable, archive_months, by_month, with_month

VERSION = re.compile(r"^v=(\d+)$")
MONTH = "obs_month"
# Folders of merges that are not published yet begin with this; readers do not see them.
MERGING = "_merge-"


def versions(spark: SparkSession, path: str, *, complete: bool = True) -> list[int]:
    """Version numbers below a table path, ascending."""
    found = [int(m.group(1)) for m in map(VERSION.match, child_names(spark, path)) if m]
    return sorted(v for v in found if not complete or path_exists(spark, f"{path}/v={v}/_SUCCESS"))


def read_version(spark: SparkSession, path: str, schema: StructType, version: int | None = None) -> DataFrame:
    """The newest complete version (or a given one); an empty table before the first write."""
    if version is None:
        done = versions(spark, path)
        if not done:
            return spark.createDataFrame([], schema)
        version = done[-1]
    # A version that was merged is in two folders, whose name is no column of the table.
    return spark.read.schema(schema).parquet(f"{path}/v={version}").select(*schema.names)


def write_version(df: DataFrame, path: str) -> int:
    """Write the next version and return its number. The new version may be computed from the old one."""
    number = max(versions(df.sparkSession, path, complete=False), default=0) + 1
    df.write.mode("errorifexists").parquet(f"{path}/v={number}")
    return number


def expire_versions(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Delete all but the newest `keep` complete versions and those on lease; returns the numbers deleted."""
    held = leased(spark, path)
    old = [v for v in versions(spark, path)[: -max(keep, 1)] if v not in held]
    for number in old:
        fs, hadoop_path = file_system(spark, f"{path}/v={number}")
        fs.delete(hadoop_path, True)
    return old



def write_months(df: DataFrame, path: str, month_col: str, sort_by: Iterable[str] = ()) -> None:
    """Overwrite the months that occur in `df`, and no other month; each file is sorted for row-group skipping.

    For plain folders without markers, `<path>/<month_col>=<month>`; the warehouse's own tables use `MonthTable`.
    """
    df.sortWithinPartitions(month_col, *sort_by).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(month_col).parquet(path)


def months_in(df: DataFrame, month_col: str) -> list[dt.date]:
    """The distinct months of a batch: one value per calendar month, whatever the batch size."""
    return sorted(r[0] for r in df.select(month_col).distinct().collect() if r[0] is not None)


class Warehouse:
    """Tables below one root folder, by their `layer.table` names."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        layer, table = name.split(".")
        return f"{self.root}/{layer}/{table}"

    def _versioned(self, name: str) -> bool:
        return name in ("core.location", "core.wikipedia_page")

    def _monthly(self, name: str) -> bool:
        return name in DAY_OF

    def months(self, name: str) -> MonthTable:
        """A table in month folders. Its stored rows have the month as last column."""
        schema = TABLES[name][0]
        stored = schema if MONTH in schema.names else StructType([*schema.fields]).add(MONTH, DateType())
        return MonthTable(self.spark, self.path(name), stored, MONTH)

    def batches(self, name: str) -> RawTable:
        """A table of logged batches."""
        return RawTable(self.spark, self.path(name), TABLES[name][0], KEYS.get(name), BATCHED[name])

    def titles(self) -> TitleLookup:
        """Raw pages by their title, ignoring case."""
        return TitleLookup(self.spark, f"{self.root}/state/page_titles", TABLES["raw.wikipedia_pages"][0])

    def index_titles(self) -> int:
        """Bring the landed batches of pages that it lacks into the title lookup; returns how many."""
        raw, lookup = self.batches("raw.wikipedia_pages"), self.titles()
        lacking = sorted(set(raw.batches()) - set(lookup.batches()))
        if lacking:
            rows = raw.read(max(raw.batches()), lacking)
            lookup.add(rows, lacking)
        return len(lacking)

    def read(self, name: str, months: Iterable[dt.date] | None = None) -> DataFrame:
        """A table under its declared schema; `months` restricts a table in month folders to those."""
        schema = TABLES[name][0]
        path = self.path(name)
        if self._versioned(name):
            return read_version(self.spark, path, schema)
        if self._monthly(name):
            return self.months(name).read(months).select(*schema.names)
        if name in BATCHED:
            return self.batches(name).read().select(*schema.names)
        if not any(c != "_temporary" for c in child_names(self.spark, path)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path).select(*schema.names)

    @contextlib.contextmanager
    def snapshot(self, *names: str, hours: float = 24) -> Iterator[dict[str, DataFrame]]:
        """Dimensions and tables in month folders as they are now, for as long as the block runs, `hours` at most.

        Refreshes go on meanwhile; what the block reads is not expired.
        """
        with contextlib.ExitStack() as held:
            frames = {}
            for name in names:
                schema, path = TABLES[name][0], self.path(name)
                if self._monthly(name):
                    state = self.months(name).state()
                    number, df = state.number, self.months(name).read(state=state).select(*schema.names)
                else:
                    number = max(versions(self.spark, path), default=0)
                    df = read_version(self.spark, path, schema, number or None)
                if number:
                    held.enter_context(lease(self.spark, path, number, hours))
                frames[name] = df
            yield frames

    def append(self, name: str, df: DataFrame) -> None:
        """Add rows; to a table of batches as a batch, with all that is kept about it."""
        rows = conform(df, TABLES[name][0])
        if name in BATCHED:
            self.batches(name).land(rows)
        else:
            rows.write.mode("append").parquet(self.path(name))

    def replace(self, name: str, df: DataFrame) -> int:
        """Make the rows the whole content of a dimension or a table in month folders; returns its new number."""
        rows = conform(df, TABLES[name][0])
        if not self._monthly(name):
            return write_version(rows, self.path(name))
        table, dated = self.months(name), self._dated(name, rows)
        return table.replace(dated, {*table.months(), *months_in(dated, MONTH)}, notes={}).number

    def highest_id(self, name: str, id_col: str) -> int:
        """The highest surrogate of a dimension: as noted with its version, or else from the column."""
        noted, there = self.noted(f"highest-{name}"), versions(self.spark, self.path(name))
        if there and noted.get("version") == there[-1]:
            return noted["id"]
        return self.read(name).agg(F.coalesce(F.max(id_col), F.lit(0))).first()[0]

    def merge_dimension(self, name: str, rows: DataFrame, id_col: str, order: Sequence[str]) -> int:
        """Publish a dimension from its rows after a merge, of which those that are `is_new` get the next surrogates.

        All rows are written in one pass, the new ones into a folder of their own. These are read again, few as they
        are, numbered without gaps, and take that folder's place before the version appears.
        """
        schema, path = TABLES[name][0], self.path(name)
        highest = self.highest_id(name, id_col)
        number = max(versions(self.spark, path, complete=False), default=0) + 1
        aside = f"{path}/{MERGING}{number}-{uuid.uuid4().hex[:8]}"
        conform(rows, StructType([*schema.fields]).add("is_new", BooleanType())).write.partitionBy("is_new").parquet(aside)
        fresh, added = f"{aside}/is_new=true", 0
        if path_exists(self.spark, fresh):
            new = self.spark.read.schema(schema).parquet(fresh)
            added = new.count()
            taken = self.spark.createDataFrame([(highest,)], "n long")
            conform(dense_ids(new.drop(id_col), id_col, order, taken=taken), schema).write.parquet(f"{aside}/_numbered")
            remove(self.spark, fresh)
            move(self.spark, f"{aside}/_numbered", fresh)
        move(self.spark, aside, f"{path}/v={number}")
        self.note(f"highest-{name}", {"version": number, "id": highest + added})
        return number

    def _dated(self, name: str, df: DataFrame) -> DataFrame:
        return df if MONTH in df.columns else with_month(df, DAY_OF[name], MONTH)

    def replace_months(
        self,
        name: str,
        df: DataFrame,
        months: Iterable[dt.date],
        sort_by: Iterable[str] = (),
        *,
        notes: dict | None = None,
    ) -> DataFrame:
        """Make `df` the whole content of the given months, by one switch; returns the rows as stored.

        A month that ends up empty is detached, a row of another month fails the job. Until the switch readers have
        the old months, and `recover` completes a switch whose rows are all there.
        """
        months = list(months)
        state = self.months(name).replace(self._dated(name, df), months, sort_by, notes=notes)
        return self.months(name).read(months, state)

    def recover(self) -> dict[str, list[int]]:
        """Complete what a job that died has left unfinished, in all tables; returns the numbers completed.

        A dimension's merge that was not published is taken away; it will be made anew.
        """
        for name in filter(self._versioned, TABLES):
            for folder in child_names(self.spark, self.path(name)):
                if folder.startswith(MERGING):
                    remove(self.spark, f"{self.path(name)}/{folder}")
        tables = {n: self.months(n) for n in DAY_OF} | {n: self.batches(n) for n in BATCHED}
        return {n: done for n, table in tables.items() if (done := table.recover())}

    def stored_months(self, name: str) -> list[dt.date]:
        """The months that a table in month folders has, from its marker."""
        return self.months(name).months()

    def _met(self, name: str, start: dt.datetime, end: dt.datetime) -> list[dt.date]:
        touched = set(months_touched(start, end))
        return [m for m in self.stored_months(name) if m in touched]

    def delete_range(
        self, name: str, ts_col: str, start: dt.datetime, end: dt.datetime, sort_by: Iterable[str] = ()
    ) -> list[dt.date]:
        """Delete the rows of [start, end); returns the months rewritten. Other months keep their files."""
        months = self._met(name, start, end)
        if months:
            kept = merge.delete_range(self.read(name, months), ts_col, start, end)
            self.replace_months(name, kept, months, sort_by)
        return months

    def replace_range(
        self,
        name: str,
        batch: DataFrame,
        ts_col: str,
        start: dt.datetime,
        end: dt.datetime,
        sort_by: Iterable[str] = (),
    ) -> list[dt.date]:
        """Backfill: put the rows of the batch in the place of those of [start, end); returns the months rewritten."""
        schema, month_col = TABLES[name]
        months = months_touched(start, end)
        fresh = conform(with_month(batch, ts_col, month_col), schema)
        self.replace_months(name, merge.replace_range(self.read(name, months), fresh, ts_col, start, end), months, sort_by)
        return months

    def archive_before(self, name: str, cutoff: dt.date, folder: str, keys: Sequence[str] | None = None) -> list[dt.date]:
        """Move whole months before the cutoff to another folder of the same layout; returns them.

        `keys` are by default the table's own; see `archive_months`.
        """
        table = self.months(name)
        archive = MonthTable(self.spark, folder, table.schema, table.month_col)
        return archive_months(table, archive, cutoff, keys or KEYS[name])

    def delete_loaded_before(self, name: str, cutoff: dt.datetime) -> None:
        """Retention of a table of batches: drop the rows loaded before the cutoff; those without a time stay."""
        self.batches(name).drop_before(cutoff)

    def expire(self, keep: int = 2) -> dict[str, list[int]]:
        """Delete all but the newest versions and states of every table that has such; those on lease stay."""
        dims = {n: expire_versions(self.spark, self.path(n), keep) for n in TABLES if self._versioned(n)}
        return dims | {n: self.months(n).expire(keep) for n in DAY_OF}

    def note(self, name: str, value: dict) -> None:
        """Keep a small fact about the warehouse, such as what the gate has seen."""
        folder = f"{self.root}/state/_notes/{name}"
        there = sorted(child_names(self.spark, folder))
        write_text(self.spark, f"{folder}/{int(there[-1] if there else 0) + 1:08d}", json.dumps(value))
        for old in there[:-1]:  # the last one stays, for whoever is reading it
            remove(self.spark, f"{folder}/{old}")

    def noted(self, name: str) -> dict:
        """The last note of this name, or an empty one."""
        folder = f"{self.root}/state/_notes/{name}"
        last = max(child_names(self.spark, folder), default=None)
        return json.loads(read_text(self.spark, f"{folder}/{last}")) if last else {}

    def register(self, database_prefix: str = "") -> list[str]:
        """Make the tables queryable as `raw.x`, `core.x`, `mart.x` in Spark SQL, as they are now."""
        names = []
        for name, (schema, _) in TABLES.items():
            layer, table = name.split(".")
            if layer == "state":
                continue
            database = f"{database_prefix}{layer}"
            path, columns = self.path(name), ", ".join(f"`{c}`" for c in schema.names)
            if self._versioned(name):
                done = versions(self.spark, path)
                sources = [f"{path}/v={done[-1]}"] if done else []
            elif self._monthly(name):
                state = self.months(name).state()
                sources = [f"{path}/{MONTH}={m.isoformat()}/v={v}" for m, v in sorted(state.months.items())]
                columns = columns.replace(f"`{MONTH}`", "DATE'{month}' AS `" + MONTH + "`")
            else:
                sources = [path] if path_exists(self.spark, path) else []
            if not sources:
                continue
            # A month is a constant of its folder's rows, so a filter on it drops the other folders.
            selects = [
                f"SELECT {columns.replace('{month}', s.rpartition('/')[0].rpartition('=')[2])} FROM parquet.`{s}`"
                for s in sources
            ]
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
            self.spark.sql(f"CREATE OR REPLACE VIEW {database}.{table} AS {' UNION ALL '.join(selects)}")
            names.append(f"{database}.{table}")
        return names
