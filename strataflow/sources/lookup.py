"""Raw pages dealt by title, so that one page reads few files.

    <table>/bucket=17/b=7/part-...     rows of batch 7 whose title, in lower case, falls into bucket 17, sorted by it
    <table>/_log/00000007              written when all of the batch is there

The bucket of a title that is looked up is a constant, so the scan lists one bucket; within its files the title's
statistics and bloom filter skip row groups. Batches are added as they are landed; nothing is rewritten.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructType

from strataflow.sources.files import child_names, path_exists, remove, write_text

BUCKETS = 64


def bucket_of(title: Column) -> Column:
    return F.pmod(F.xxhash64(F.lower(title)), F.lit(BUCKETS)).cast("int")


class TitleLookup:
    def __init__(self, spark: SparkSession, path: str, schema: StructType, title: str = "page_title"):
        self.spark, self.path, self.schema, self.title = spark, path.rstrip("/"), schema, title

    def batches(self) -> list[int]:
        return sorted(int(c) for c in child_names(self.spark, f"{self.path}/_log"))

    def add(self, rows: DataFrame, batches: Sequence[int]) -> None:
        """Add the rows (with their batch as column `b`) of some batches. Rows without a title cannot be looked up."""
        for number in batches:  # what a job that died has left of them
            for bucket in child_names(self.spark, self.path):
                if bucket.startswith("bucket=") and path_exists(self.spark, f"{self.path}/{bucket}/b={number}"):
                    remove(self.spark, f"{self.path}/{bucket}/b={number}")
        titled = rows.filter(F.col(self.title).isNotNull()).select(
            *self.schema.names, F.lower(self.title).alias("title_key"), bucket_of(F.col(self.title)).alias("bucket"), "b"
        )
        dealt = titled.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", "b", "title_key")
        bloom = "parquet.bloom.filter.enabled#title_key"
        dealt.write.mode("append").option(bloom, "true").partitionBy("bucket", "b").parquet(self.path)
        for number in batches:
            write_text(self.spark, f"{self.path}/_log/{number:08d}", "")

    def find(self, title: str) -> DataFrame:
        """The raw rows with this title, ignoring case."""
        if not self.batches():
            return self.spark.createDataFrame([], self.schema)
        stored = StructType([*self.schema.fields]).add("title_key", StringType()).add("bucket", IntegerType()).add("b", LongType())
        wanted = F.lit(title)
        rows = self.spark.read.schema(stored).parquet(self.path).filter(F.col("bucket") == bucket_of(wanted))
        return rows.filter(F.col("title_key") == F.lower(wanted)).select(*self.schema.names)
