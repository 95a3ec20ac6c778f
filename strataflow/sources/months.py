"""Tables in month folders, each with versions, switched by one marker.

    <table>/obs_month=2024-11-01/v=00000003-5f0c12ab/part-...      rows
    <table>/_state/00000003                                       which version of each month counts

A change writes new versions of the months it touches to their final place, and then a marker that names the version of
every month. A reader takes the newest marker, so it sees all of a change or nothing of it, however many months it has.
Rows are written once, and nothing that counts is overwritten: a job that dies leaves folders that no marker names.
Where it dies after all rows are there, `recover` completes the switch.

One writer at a time per table; a second one that is slower fails at its marker and changes nothing.
"""

from __future__ import annotations

import datetime as dt
import functools
import json
import operator
import re
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from strataflow.functions.times import month_of
from strataflow.operators.shape import conform
from strataflow.sources.files import child_names, leased, move, path_exists, read_text, remove, write_text

MARKER = re.compile(r"^(\d{8})$")
READY = ".ready"
# A step that brings rows of an older schema version to the next one.
Migration = Callable[[DataFrame], DataFrame]


def by_month(df: DataFrame, month_col: str) -> DataFrame:
    """Shuffle for a partitioned write: AQE merges small months and splits a huge one over many tasks."""
    return df.hint("rebalance", F.col(month_col))


def with_month(df: DataFrame, ts: str, month_col: str = "obs_month") -> DataFrame:
    return df.withColumn(month_col, month_of(F.col(ts)))


@dataclass(frozen=True)
class State:
    """What a marker says: the version folder and schema version of each month, and what the writer noted."""

    number: int = 0
    months: dict[dt.date, str] = field(default_factory=dict)
    schemas: dict[str, int] = field(default_factory=dict)
    notes: dict = field(default_factory=dict)

    def text(self) -> str:
        months = {m.isoformat(): v for m, v in sorted(self.months.items())}
        return json.dumps({"months": months, "schemas": self.schemas, "notes": self.notes})

    @staticmethod
    def of(number: int, text: str) -> State:
        said = json.loads(text)
        months = {dt.date.fromisoformat(m): v for m, v in said["months"].items()}
        return State(number, months, said.get("schemas", {}), said.get("notes", {}))


class MonthTable:
    """One table of this layout. `migrations` lead from one schema version to the next; `schema` is that of the last."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: StructType,
        month_col: str = "obs_month",
        *,
        migrations: Sequence[tuple[StructType, Migration]] = (),
    ):
        self.spark, self.path, self.schema, self.month_col = spark, path.rstrip("/"), schema, month_col
        self.migrations = list(migrations)

    @property
    def schema_version(self) -> int:
        return len(self.migrations)

    # Markers

    def _marks(self) -> list[int]:
        return sorted(int(m.group(1)) for m in map(MARKER.match, child_names(self.spark, f"{self.path}/_state")) if m)

    def state(self, number: int | None = None) -> State:
        """What the newest marker (or a given one) says; a table that was never written has no months."""
        if number is None:
            marks = self._marks()
            if not marks:
                return State()
            number = marks[-1]
        return State.of(number, read_text(self.spark, f"{self.path}/_state/{number:08d}"))

    def _switch(self, state: State) -> State:
        """Publish a state. Its rows are in place, so from the ready file on the change can be completed by `recover`."""
        marker = f"{self.path}/_state/{state.number:08d}"
        if path_exists(self.spark, marker):
            raise FileExistsError(f"{marker}: another writer was faster")
        ready = f"{marker}-{uuid.uuid4().hex[:8]}{READY}"
        write_text(self.spark, ready, state.text())
        move(self.spark, ready, marker)
        return state

    def recover(self) -> list[int]:
        """Complete switches whose rows are all there, and forget those that came too late; returns the completed ones."""
        done = []
        for name in sorted(child_names(self.spark, f"{self.path}/_state")):
            if name.endswith(READY):
                number = int(name[:8])
                if number == (self._marks() or [0])[-1] + 1:
                    move(self.spark, f"{self.path}/_state/{name}", f"{self.path}/_state/{number:08d}")
                    done.append(number)
                else:
                    remove(self.spark, f"{self.path}/_state/{name}")
        return done

    # Reading

    def months(self) -> list[dt.date]:
        return sorted(self.state().months)

    def read(self, months: Iterable[dt.date] | None = None, state: State | None = None) -> DataFrame:
        """The rows of all months or of some, under the newest schema.

        Folders of older schema versions are read under their own schema and brought up by the migrations, in the read.
        """
        state = state or self.state()
        wanted = set(state.months if months is None else months)
        parts = []
        for version in range(self.schema_version + 1):
            kept = [m for m in sorted(state.months) if m in wanted and state.schemas.get(state.months[m], 0) == version]
            if kept:
                parts.append(self._brought_up(self._folders(state, kept, version), version))
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        return whole

    def _folders(self, state: State, months: list[dt.date], version: int) -> DataFrame:
        schema = self.schema if version == self.schema_version else self.migrations[version][0]
        folders = [f"{self.path}/{self.month_col}={m.isoformat()}/v={state.months[m]}" for m in months]
        stored = StructType([*schema.fields]).add("v", StringType())
        return self.spark.read.schema(stored).option("basePath", self.path).parquet(*folders).select(*schema.names)

    def _brought_up(self, df: DataFrame, version: int) -> DataFrame:
        for _, step in self.migrations[version:]:
            df = step(df)
        return conform(df, self.schema) if version < self.schema_version else df

    # Writing

    def replace(
        self, df: DataFrame, months: Iterable[dt.date], sort_by: Iterable[str] = (), *, notes: dict | None = None
    ) -> State:
        """Make `df` the whole content of the given months; a month without rows is detached. Other months stay as they are.

        A row of another month fails the job. `df` may be computed from the table itself. `notes` are kept in the marker.
        """
        months = sorted(set(months))
        base = self.state()
        number = base.number + 1
        version = f"{number:08d}-{uuid.uuid4().hex[:8]}"
        written: dict[dt.date, str] = {}
        if months:
            month = F.col(self.month_col)
            told = F.concat(F.lit("a row outside the months to replace: "), F.coalesce(month.cast("string"), F.lit("none")))
            inside = F.when(month.isin(months), month).otherwise(F.raise_error(told).cast("date"))
            rows = conform(df, self.schema).withColumn(self.month_col, inside)
            self._write(rows, version, sort_by)
            written = {m: version for m in months if path_exists(self.spark, self._folder(m, version))}
        kept = {m: v for m, v in base.months.items() if m not in set(months)}
        schemas = {v: base.schemas.get(v, 0) for v in kept.values()} | {v: self.schema_version for v in written.values()}
        noted = base.notes if notes is None else notes
        return self._switch(State(number, kept | written, schemas, noted))

    def _folder(self, month: dt.date, version: str) -> str:
        return f"{self.path}/{self.month_col}={month.isoformat()}/v={version}"

    def _write(self, rows: DataFrame, version: str, sort_by: Iterable[str]) -> None:
        parts = (self.month_col, "v")
        ordered = by_month(rows, self.month_col).withColumn("v", F.lit(version)).sortWithinPartitions(*parts, *sort_by)
        ordered.write.mode("append").partitionBy(*parts).parquet(self.path)

    # Expiry

    def expire(self, keep: int = 2) -> list[int]:
        """Delete all but the newest `keep` states and those on lease, with the folders that no kept state names."""
        marks, held = self._marks(), leased(self.spark, self.path)
        stay = [n for n in marks if n in held or n in marks[-max(keep, 1) :]]
        named = {self._folder(m, v) for n in stay for m, v in self.state(n).months.items()}
        gone = [n for n in marks if n not in stay]
        for number in gone:  # first the markers, so that no reader takes one whose folders go
            remove(self.spark, f"{self.path}/_state/{number:08d}")
        newest = f"v={marks[-1] + 1:08d}" if marks else ""
        for month in child_names(self.spark, self.path):
            if month.startswith(f"{self.month_col}="):
                for version in child_names(self.spark, f"{self.path}/{month}"):
                    # A folder of a later number may belong to a writer that has not switched yet.
                    if f"{self.path}/{month}/{version}" not in named and version < newest:
                        remove(self.spark, f"{self.path}/{month}/{version}")
        return gone


def archive_months(table: MonthTable, archive: MonthTable, cutoff: dt.date, keys: Sequence[str]) -> list[dt.date]:
    """Move the months before the cutoff's month from one table to another; returns them.

    What the archive has of such a month is merged with the table's rows by `keys`: the table's row counts where both
    have one, every other row of the archive stays. A month is detached only after the archive has switched, so a job
    that dies in between can be repeated, and a month that gets late rows can be archived again.
    """
    archive.recover()
    table.recover()
    old = [m for m in table.months() if m < cutoff.replace(day=1)]
    if old:
        fresh = table.read(old)
        on = [*keys, table.month_col]
        same = functools.reduce(operator.and_, [F.col(f"a.{k}").eqNullSafe(F.col(f"f.{k}")) for k in on])
        held = archive.read(old).alias("a").join(fresh.select(*on).alias("f"), same, "left_anti")
        archive.replace(held.unionByName(fresh), old, keys)
        table.replace(fresh.limit(0), old)
        archive.expire(keep=1)
    return old
