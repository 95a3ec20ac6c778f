"""Shards of a corpus in random order, by a two-pass external shuffle.

The first pass scatters the records over memory-sized buckets by a seeded hash, each as likely as any other. The second
takes one bucket into memory, brings its records into an order that the data alone decide, shuffles them by Fisher and
Yates under a seed of the bucket, and writes them out. Bucket after bucket, that is a uniform order of the whole corpus.

The order is cut into shards of equal numbers of records. A record's place needs the number of records in the buckets
before its own: one row per bucket with that number goes through the same shuffle as the records, so nothing is joined
or broadcast. A task fails if it meets another number of records than was counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from strataflow.session import run_dir

SEED = 20240229
# Bytes of records that one bucket is to hold, and the least number of buckets, for small inputs.
BUCKET_BYTES, LEAST_BUCKETS = 16 << 20, 64
# Bytes that a record takes besides its counted content.
OVERHEAD = 64


def text_bytes(text: str) -> Column:
    """UTF-8 bytes of a text column; null has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


@F.pandas_udf(LongType())
def _occurrence(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """How often the task has met a row like this one before: tells rows apart that are equal in every column."""
    met: dict[int, int] = {}
    for part in parts:
        out = np.zeros(len(part), np.int64)
        for i, h in enumerate(part.to_numpy().tolist()):
            out[i] = n = met.get(h, 0)
            met[h] = n + 1
        yield pd.Series(out)


occurrence = _occurrence.asNondeterministic()


def scattered(df: DataFrame, buckets: int, seed: int) -> DataFrame:
    """(bucket, key, row): every record with its seeded hash and the bucket that it falls into.

    The hash is over the whole record, the task and the number of equal records that the task has met before, so
    repeated records are spread like all others, and a task that runs again gives the same.
    """
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    hashed = rows.withColumn("h", F.xxhash64(F.col("row")))
    numbered = hashed.withColumn("copy", occurrence("h")).withColumn("task", F.spark_partition_id())
    keyed = numbered.withColumn("key", F.xxhash64(F.lit(seed), "h", "task", "copy"))
    bucket = F.pmod(F.xxhash64(F.lit(seed + 1), "key"), F.lit(buckets)).cast("int")
    return keyed.select(bucket.alias("bucket"), "key", "row")


def buckets_for(df: DataFrame, size: Column, bucket_bytes: int, least: int) -> int:
    """As many buckets as records of `size` bytes each need, `least` at least."""
    total = df.agg(F.coalesce(F.sum(size + F.lit(OVERHEAD)), F.lit(0))).first()[0]
    return max(least, -(-int(total) // bucket_bytes))


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A permutation of 0 to n - 1, each as likely, decided by the seed and the bucket."""
    return np.random.default_rng([seed, bucket]).permutation(n)


def external_shuffle(df: DataFrame, size: Column, *, seed: int, bucket_bytes: int, least: int) -> DataFrame:
    """(position, total, row): the records in random order, numbered from 0, each bucket a partition."""
    buckets = buckets_for(df, size, bucket_bytes, least)
    rows = scattered(df, buckets, seed)
    counts = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    marks = counts.select(
        "bucket",
        F.lit(None).cast("long").alias("key"),
        F.lit(None).cast(rows.schema["row"].dataType).alias("row"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"),
        F.sum("n").over(whole).alias("total"),
        "n",
    )
    blank = [F.lit(None).cast("long").alias(c) for c in ("first", "total", "n")]
    dealt = rows.select("bucket", "key", "row", *blank).unionByName(marks).repartitionById(buckets, "bucket")

    def shuffle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        del held
        marked = table.column("total").is_valid()
        mark = table.filter(marked).to_pylist()
        table = table.filter(pc.invert(marked))
        if len(mark) != 1 or mark[0]["n"] != table.num_rows:
            raise ValueError(f"a bucket holds {table.num_rows} records, counted were {[m['n'] for m in mark]}")
        # Fetched in any order; the keys restore one. Records of one key are alike.
        table = table.take(pc.sort_indices(table, [("key", "ascending")]))
        table = table.take(pa.array(fisher_yates(table.num_rows, seed, mark[0]["bucket"])))
        places = pa.array(mark[0]["first"] + np.arange(table.num_rows), pa.int64())
        totals = pa.array(np.full(table.num_rows, mark[0]["total"]), pa.int64())
        shuffled = pa.table([places, totals, table.column("row")], names=["position", "total", "row"])
        yield from shuffled.to_batches(max_chunksize=1024)

    kind = StructType().add("position", LongType()).add("total", LongType()).add(rows.schema["row"])
    return dealt.mapInArrow(shuffle, kind)


def write_shards(
    df: DataFrame,
    shards: int,
    size: Column,
    *,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
    least_buckets: int = LEAST_BUCKETS,
    names: tuple[str, str] = ("shard", "slot"),
    path: str | None = None,
) -> DataFrame:
    """Write the records in random order as `shards` folders, and read them back with shard and slot.

    Every record comes out once. The numbers of records of two shards differ by one at most; slots count from 0
    without a gap. The order depends on the seed, the records, and the split of the input into tasks; a lost task
    gives the same again. `size` is what a record counts towards a bucket of `bucket_bytes`; a bucket is what a task
    holds at a time, and a longer record is held whole.

    Nulls in any column, empty and very long texts are content like other. Repeated records are dealt one by one. An
    empty table gives no rows. An input column that has one of `names` gives way to the new one. Columns have to be
    hashable, so not of a map type.
    """
    kept = [c for c in df.columns if c not in names]
    folder = path or run_dir(df.sparkSession, "shards")
    shuffled = external_shuffle(df.select(*kept), size, seed=seed, bucket_bytes=bucket_bytes, least=least_buckets)
    cut = F.expr(f"(position * {shards}L) div total")
    first = F.expr(f"(shard * total + {shards - 1}L) div {shards}L")
    placed = shuffled.withColumn("shard", cut).withColumn("slot", F.col("position") - first)
    # A bucket lies in one shard, or in a few that follow each other; each of its files is in slot order.
    ordered = placed.select("shard", "slot", "row").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(folder)
    kind = StructType().add("slot", LongType()).add(shuffled.schema["row"]).add("shard", IntegerType())
    told = df.sparkSession.read.schema(kind).parquet(folder)
    return told.select("row.*", F.col("shard").alias(names[0]), F.col("slot").alias(names[1]))
