"""Dense key allocation without a one-task row_number over all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Hash buckets for surrogate keys. Only the bucket sizes, one row each, meet in one task.
BUCKETS = 1024
# Rows per range bucket where the numbering must follow a position column.
POSITIONS_PER_BUCKET = 1_000_000


def dense_ids(
    new: DataFrame,
    id_col: str,
    order: Sequence[str],
    *,
    taken: DataFrame | None = None,
    bucket: Column | None = None,
    step: int = 1,
) -> DataFrame:
    """Number the rows of `new` without gaps, going on from `taken` (one row, column `n`).

    The rows are cut into buckets, numbered inside each bucket, and shifted by
    the running total of the bucket sizes. `order` must be unique; the bucket
    is a function of the row alone, so a recomputed task gives the same ids.
    With `step=-1` the ids go down from -(n + 1).
    """
    bucket = F.pmod(F.xxhash64(*order), F.lit(BUCKETS)) if bucket is None else bucket
    rows = new.withColumn("__bucket", bucket.cast("bigint"))
    sizes = rows.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n"))
    if taken is not None:
        sizes = sizes.unionByName(
            taken.select(F.lit(-1).cast("bigint").alias("__bucket"), F.col("n").cast("bigint").alias("__n"))
        )
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy("__bucket").orderBy(*order)
    return (
        rows.withColumn("__rank", F.row_number().over(inside))
        .join(offsets, "__bucket")
        .withColumn(id_col, step * (F.col("__offset") + F.col("__rank")))
        .drop("__bucket", "__rank", "__offset")
    )


def surrogate_ids(new: DataFrame, existing: DataFrame, id_col: str, order: Sequence[str]) -> DataFrame:
    """Give each new row max(existing id) + 1, + 2, ..."""
    taken = existing.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("n"))
    return dense_ids(new, id_col, order, taken=taken)


def placeholder_ids(
    wanted: DataFrame,
    existing: DataFrame,
    id_col: str,
    match: Sequence[str],
    position: str,
    *,
    used: DataFrame | None = None,
) -> DataFrame:
    """Negative ids for the wanted rows that no existing row matches, in order of `position`.

    The first id is one below the smallest negative id in `used` (all rows that ever had
    one; by default the existing ones); with none it is -2.
    """
    absent = wanted.join(existing.select(*match), list(match), "left_anti")
    taken = (existing if used is None else used).filter(F.col(id_col) < 0).agg(F.coalesce(-F.min(id_col), F.lit(1)).alias("n"))
    bucket = F.floor(F.col(position) / POSITIONS_PER_BUCKET)
    return dense_ids(absent, id_col, [position], taken=taken, bucket=bucket, step=-1)
