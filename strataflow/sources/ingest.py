"""Raw tables: batches that are landed once, a log of them, and the newest row of each key.

    <table>/b=00000007/part-...        rows of the batch
    <table>/_log/00000007              written when the batch is in place: rows, first and last time, highest id
    <table>/_newest/v=7/...            per key its newest row landed so far: time, id and batch
    <table>/_applied/<reader>/00000007 how far a reader has come

A batch is first written aside. The newest rows are settled before any of it can be seen, so a reader that meets a row
knows whether a newer one has landed, without a look at other raw rows. Then the folder is moved into place by one
rename, and the log is written. A job that dies in between is completed by `recover`, as the rows are still there.
"""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from strataflow.functions.times import ntz
from strataflow.sources.files import child_names, move, path_exists, read_text, remove, write_text

BATCH = "b"
NUMBER = re.compile(r"^(?:b=)?(\d{8,})$")


class RawTable:
    """`keys`: name -> SQL expression of the columns whose newest row counts; none for a table without such a rule."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: StructType,
        keys: dict[str, str] | None = None,
        loaded_at: str = "ingested_at",
    ):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.loaded_at = keys or {}, loaded_at

    def _numbered(self, folder: str) -> dict[int, str]:
        """The numbers below a folder, with their names."""
        found = map(NUMBER.match, child_names(self.spark, f"{self.path}/{folder}".rstrip("/")))
        return {int(m.group(1)): m.group(0) for m in found if m}

    def stored_schema(self) -> StructType:
        """The table's columns and the batch, as files are read."""
        return StructType([*self.schema.fields]).add(BATCH, LongType())

    # The log

    def batches(self) -> list[int]:
        return sorted(self._numbered("_log"))

    def entry(self, batch: int) -> dict:
        """What the log says of a batch: `rows`, `untimed` of them, the `first` and `last` time, the highest id so far."""
        return json.loads(read_text(self.spark, f"{self.path}/_log/{batch:08d}"))

    def last_batch(self) -> int:
        return max(self.batches(), default=0)

    def highest_id(self) -> int:
        """The highest id landed so far, from the log."""
        last = self.last_batch()
        return self.entry(last)["highest_id"] if last else 0

    def applied(self, reader: str) -> int:
        """The last batch that a reader has said it is through with."""
        return max(self._numbered(f"_applied/{reader}"), default=0)

    def set_applied(self, reader: str, batch: int) -> None:
        if batch > self.applied(reader):
            write_text(self.spark, f"{self.path}/_applied/{reader}/{batch:08d}", "")

    # Reading

    def read(self, since: int | None = None, also: Iterable[int] = ()) -> DataFrame:
        """All rows, or those of the batches after `since` and of the batches in `also`; with the batch as column `b`.

        Batches are folders, so the scan lists and reads no others.
        """
        if not self._numbered(""):
            return self.spark.createDataFrame([], self.stored_schema())
        df = self.spark.read.schema(self.stored_schema()).parquet(self.path)
        if since is None:
            return df
        also = sorted(set(also))
        later = F.col(BATCH) > F.lit(since).cast("long")
        return df.filter(later | F.col(BATCH).isin(also) if also else later)

    def newest(self) -> DataFrame:
        """(keys, ingested_at, id, b): the newest row of each key among all that has landed."""
        done = self._versions()
        return self._read_newest(done[-1]) if done else self.spark.createDataFrame([], self._newest_schema())

    # Landing

    def land(self, df: DataFrame) -> int:
        """Add a batch; returns its number. A batch that an earlier call left unfinished is completed first."""
        self.recover()
        number = max([self.last_batch(), *self._numbered("_landing")], default=0) + 1
        df.select(*self.schema.names).write.parquet(f"{self.path}/_landing/b={number:08d}")
        self._finish(number)
        return number

    def _facts(self, rows: DataFrame) -> dict:
        time = F.col(self.loaded_at)
        top = F.max("id") if "id" in self.schema.names else F.lit(None)
        told = rows.agg(
            F.count(F.lit(1)).alias("rows"),
            (F.count(F.lit(1)) - F.count(time)).alias("untimed"),
            F.min(time).cast("string").alias("first"),
            F.max(time).cast("string").alias("last"),
            top.alias("highest_id"),
        ).first()
        return told.asDict() | {"highest_id": max(self.highest_id(), told["highest_id"] or 0)}

    def _finish(self, number: int) -> None:
        """Settle the newest rows, move the batch into place, write the log. Each step may run again."""
        aside, place = f"{self.path}/_landing/b={number:08d}", f"{self.path}/b={number:08d}"
        if path_exists(self.spark, aside):
            if self.keys:
                self._settle(self.spark.read.schema(self.schema).parquet(aside), number)
            move(self.spark, aside, place)
        facts = self._facts(self.spark.read.schema(self.schema).parquet(place))
        write_text(self.spark, f"{self.path}/_log/{number:08d}", json.dumps(facts))

    def recover(self) -> list[int]:
        """Complete what a job that died has left: landed batches, and batches that retention was about to replace."""
        for number, name in self._numbered("_landing").items():
            if not path_exists(self.spark, f"{self.path}/_landing/{name}/_SUCCESS"):
                # Its writer failed before the batch was complete, and said so.
                remove(self.spark, f"{self.path}/_landing/{name}")
        unlogged = sorted({*self._numbered("_landing"), *self._numbered("")} - set(self.batches()))
        for number in unlogged:
            self._finish(number)
        if path_exists(self.spark, f"{self.path}/_kept/plan"):  # without a plan nothing has been touched yet
            self._replace_kept()
        return unlogged

    # Newest rows

    def _newest_schema(self) -> StructType:
        empty = self.spark.createDataFrame([], self.stored_schema())
        return self._reduced(empty).schema

    def _versions(self) -> list[int]:
        names = child_names(self.spark, f"{self.path}/_newest")
        found = sorted(int(n[2:]) for n in names if n.startswith("v="))
        return [v for v in found if path_exists(self.spark, f"{self.path}/_newest/v={v}/_SUCCESS")]

    def _read_newest(self, version: int) -> DataFrame:
        return self.spark.read.schema(self._newest_schema()).parquet(f"{self.path}/_newest/v={version}")

    def _order(self) -> Column:
        """A row without a time counts as the newest, as everywhere."""
        return F.struct(F.col("ingested_at").isNull(), F.col("ingested_at"), F.col("id"), F.col(BATCH))

    def _reduced(self, df: DataFrame) -> DataFrame:
        keyed = df.select(*[F.expr(e).alias(k) for k, e in self.keys.items()], "ingested_at", "id", BATCH)
        return self._merged(keyed)

    def _merged(self, keyed: DataFrame) -> DataFrame:
        best = F.max_by(F.struct("ingested_at", "id", BATCH), self._order()).alias("best")
        return keyed.groupBy(*self.keys).agg(best).select(*self.keys, "best.*")

    def _settle(self, rows: DataFrame, number: int) -> None:
        """Merge a batch into the newest rows; only keys, times and ids are read, and merging twice changes nothing."""
        done = self._versions()
        if number in done:
            return
        fresh = self._reduced(rows.withColumn(BATCH, F.lit(number).cast("long")))
        merged = self._merged(self._read_newest(done[-1]).unionByName(fresh)) if done else fresh
        merged.write.mode("overwrite").parquet(f"{self.path}/_newest/v={number}")
        for old in done[:-1]:
            remove(self.spark, f"{self.path}/_newest/v={old}")

    # Retention

    def drop_before(self, cutoff: dt.datetime) -> list[int]:
        """Drop the rows loaded before the cutoff; returns the batches dropped whole. Rows without a time stay.

        By the log, old batches go without being read and new ones are left alone. Of a batch that has both the rows
        to keep are written aside, and only then take its place; a job that dies in between is completed by `recover`.
        """
        self.recover()
        there = self._numbered("")
        times = {n: self.entry(n) for n in there}
        border = cutoff.isoformat(sep=" ")
        old = [n for n, e in times.items() if not e["untimed"] and e["rows"] and e["last"] < border]
        mixed = [n for n, e in times.items() if n not in old and e["rows"] > e["untimed"] and e["first"] < border]
        if mixed:
            time = F.col(self.loaded_at)
            rows = self.read().filter(F.col(BATCH).isin(mixed) & (time.isNull() | (time >= ntz(cutoff))))
            rows.write.mode("overwrite").partitionBy(BATCH).parquet(f"{self.path}/_kept")
            write_text(self.spark, f"{self.path}/_kept/plan", json.dumps([there[n] for n in sorted(mixed)]))
            self._replace_kept()
        for number in old:
            remove(self.spark, f"{self.path}/{there[number]}")
        return sorted(old)

    def _replace_kept(self) -> None:
        """Move the kept rows into place, then take the old folders away; each step may run again."""
        kept = f"{self.path}/_kept"
        replaced = json.loads(read_text(self.spark, f"{kept}/plan"))
        # One digit more than any old folder: another name for the same batch.
        width = max(map(len, replaced)) - len(f"{BATCH}=") + 1
        for folder in child_names(self.spark, kept):
            if folder.startswith(f"{BATCH}="):
                move(self.spark, f"{kept}/{folder}", f"{self.path}/{BATCH}={int(folder.partition('=')[2]):0{width}d}")
        for folder in replaced:
            remove(self.spark, f"{self.path}/{folder}")
        remove(self.spark, kept)
