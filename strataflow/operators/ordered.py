"""Neighbouring rows in time order, without sorting a whole key in one task.

A plain window over (key, time) sends every row of a key to one task. Here the
key is cut into time slices. Windows run inside (key, slice); what crosses a
slice border comes from a summary with one row per key and slice, which is
joined back. Rows and summary share one shuffle by (key, slice).

Keys and times must not be NULL; a row with a NULL there fails the job when it is reached, so none is lost in silence.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.functions.times import hour_of

SLICE = "__slice"


class Slices:
    """Windows over a frame that is cut into (key, slice) pieces: by hour unless told otherwise.

    The width changes the plan, not the rows. A caller who knows a key with very many
    rows an hour passes a narrower one, such as `F.date_trunc("second", ts)`.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[str], slice_by: Column | None = None):
        self.keys = list(keys)
        self.slice_by = hour_of(F.col(order[0])) if slice_by is None else slice_by
        piece = Window.partitionBy(*keys, SLICE)
        self.up = piece.orderBy(*[F.col(o).asc() for o in order])
        self.down = piece.orderBy(*[F.col(o).desc() for o in order])
        whole = Window.partitionBy(*keys)
        self.slices_up = whole.orderBy(F.col(SLICE).asc())
        self.slices_down = whole.orderBy(F.col(SLICE).desc())

    def cut(self, df: DataFrame) -> DataFrame:
        cut = df.withColumn(SLICE, self.slice_by)
        missing = functools.reduce(operator.or_, [F.col(name).isNull() for name in (*self.keys, SLICE)])
        told = F.raise_error(F.lit(f"NULL in one of {[*self.keys, 'time']}")).cast("boolean")
        return cut.filter(F.when(missing, told).otherwise(F.lit(True)))

    def join(self, rows: DataFrame, summary: DataFrame) -> DataFrame:
        return rows.join(summary, [*self.keys, SLICE], "left")


def last_value(column: Column, window, *, through: int = Window.currentRow) -> Column:
    """Last non-null value from the start of the window up to `through`; linear, as the start is unbounded."""
    return F.last(column, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, through))


def with_closest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    *,
    before: str,
    after: str,
    slice_by: Column | None = None,
) -> DataFrame:
    """Add the last non-null `value` up to the row and the first one after it, in `order` within the key.

    `order` must be unique within a key; its first column is the time that is cut.
    """
    cut = Slices(df, keys, order, slice_by)
    whole = cut.up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = (
        cut.cut(df)
        .withColumn("__first", F.first(value, ignorenulls=True).over(whole))
        .withColumn("__last", F.last(value, ignorenulls=True).over(whole))
        .withColumn("__head", F.lag(F.lit(1)).over(cut.up).isNull())
        .withColumn("__b", last_value(F.col(value), cut.up))
        .withColumn("__a", last_value(F.col(value), cut.down))
    )
    summary = rows.filter("__head").select(
        *keys,
        SLICE,
        last_value(F.col("__last"), cut.slices_up, through=-1).alias("__fb"),
        last_value(F.col("__first"), cut.slices_down, through=-1).alias("__fa"),
    )
    return cut.join(rows, summary).select(
        *df.columns,
        F.coalesce("__b", "__fb").alias(before),
        F.coalesce("__a", "__fa").alias(after),
    )


def change_points(
    df: DataFrame, keys: Sequence[str], value: str, ts: str, *, until: str, slice_by: Column | None = None
) -> DataFrame:
    """The rows (keys, value, ts) whose value differs from the previous row's, and when the next such row comes.

    (keys, ts) must be unique. The first row of a key is a change; `until` is NULL for the last one.
    """
    cut = Slices(df, keys, [ts], slice_by)
    whole = cut.up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    held = F.struct(F.col(value).alias("v"))  # a struct, so that a NULL value differs from no row at all
    rows = (
        cut.cut(df.select(*keys, value, ts))
        .withColumn("__before", F.lag(held).over(cut.up))
        .withColumn("__last", F.last(held).over(whole))
        .withColumn("__head", F.col("__before").isNull())
        .withColumn("__change", ~F.col("__head") & ~F.col(value).eqNullSafe(F.col("__before.v")))
        .withColumn("__next", last_value(F.when(F.col("__change"), F.col(ts)), cut.down, through=-1))
    )
    heads = rows.filter("__head").select(
        *keys, SLICE, value, ts, "__next", F.lag("__last").over(cut.slices_up).alias("__carried")
    )
    opens = F.col("__carried").isNull() | ~F.col(value).eqNullSafe(F.col("__carried.v"))
    summary = (
        heads.withColumn("__opens", opens)
        .withColumn("__first_change", F.when(F.col("__opens"), F.col(ts)).otherwise(F.col("__next")))
        .select(
            *keys,
            SLICE,
            "__opens",
            last_value(F.col("__first_change"), cut.slices_down, through=-1).alias("__later"),
        )
    )
    return (
        cut.join(rows, summary)
        .filter(F.col("__change") | (F.col("__head") & F.col("__opens")))
        .select(*keys, value, ts, F.coalesce("__next", "__later").alias(until))
    )
