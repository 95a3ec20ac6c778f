"""Nearest-in-time match of two series and reconciliation within tolerances."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions.times import micros, seconds_between
from strataflow.operators.ordered import with_closest


def nearest_match(
    left: DataFrame,
    right: DataFrame,
    entity: Sequence[str],
    t: str,
    values: Sequence[str],
    *,
    right_tie: Sequence[str] = (),
    tolerance_seconds: float | None = None,
    prefix: str = "matched_",
    slice_by: Column | None = None,
) -> DataFrame:
    """Join each left row to the right row of the same entity with the smallest |time difference|.

    On equal distance the earlier right row wins; of several right rows at one
    instant the first by `right_tie`. Left rows without a match keep NULLs.

    No pairs are formed: the distinct instants of both sides are merged into
    one time line per entity, each left instant sees the right instant before
    and after it, and the nearer one is joined back on (entity, t).
    """
    payload = F.struct(F.col(t).alias("t"), *[F.col(v) for v in values])
    first = F.struct(*[F.col(c) for c in right_tie]) if right_tie else F.struct(*[F.col(v) for v in values])
    right_points = (
        right.filter(F.col(t).isNotNull())
        .groupBy(*entity, t)
        .agg(F.min_by(payload, first).alias("__right"))
        .withColumn("__side", F.lit(0))
    )
    left_points = (
        left.filter(F.col(t).isNotNull()).select(*entity, t).distinct().withColumn("__side", F.lit(1))
    )
    line = right_points.unionByName(left_points, allowMissingColumns=True)
    for name in entity:  # rows without an entity match nothing
        line = line.filter(F.col(name).isNotNull())
    # A right instant equal to a left one sorts first (side 0) and so counts as "before".
    seen = with_closest(
        line, entity, [t, "__side"], "__right", before="__before", after="__after", slice_by=slice_by
    ).filter(F.col("__side") == 1)

    now, before, after = micros(F.col(t)), micros(F.col("__before.t")), micros(F.col("__after.t"))
    pick_before = F.col("__after").isNull() | (now - before <= after - now)
    best = F.when(F.col("__before").isNotNull() & pick_before, F.col("__before")).otherwise(
        F.coalesce("__after", "__before")
    )
    nearest = seen.select(*entity, t, best.alias("__best"))
    if tolerance_seconds is not None:
        close = seconds_between(F.col(t), F.col("__best.t")) <= tolerance_seconds
        nearest = nearest.withColumn("__best", F.when(close, F.col("__best")))
    return left.join(nearest, [*entity, t], "left").select(
        *left.columns,
        F.col("__best.t").alias(f"{prefix}{t}"),
        *[F.col(f"__best.{v}").alias(f"{prefix}{v}") for v in values],
    )


def within_tolerance(a: Column, b: Column, tolerance: float) -> Column:
    """|a - b| < tolerance; NULL where a side is missing."""
    return F.abs(a - b) < tolerance


def reconcile(
    stored: DataFrame,
    source: DataFrame,
    entity: Sequence[str],
    t: str,
    tolerances: dict[str, float],
    *,
    source_tie: Sequence[str] = (),
    tolerance_seconds: float | None = None,
) -> DataFrame:
    """Compare each stored row with the source row nearest in time.

    Adds, per measure, the source value, the absolute difference and an
    `<measure>_ok` flag, and `time_diff_seconds`.
    """
    matched = nearest_match(
        stored,
        source,
        entity,
        t,
        list(tolerances),
        right_tie=source_tie,
        tolerance_seconds=tolerance_seconds,
        prefix="source_",
    )
    extra: list[Column] = [seconds_between(F.col(t), F.col(f"source_{t}")).alias("time_diff_seconds")]
    for measure, tolerance in tolerances.items():
        a, b = F.col(measure), F.col(f"source_{measure}")
        extra += [F.abs(a - b).alias(f"{measure}_diff"), within_tolerance(a, b, tolerance).alias(f"{measure}_ok")]
    return matched.select("*", *extra)
