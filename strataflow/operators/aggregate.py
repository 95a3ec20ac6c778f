"""Grouped aggregates that stay small per task: mode, spans, filtered and duplicate counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mode_of(counted: DataFrame, keys: Sequence[str], value: str, n: str, aggs: Sequence[Column] = ()) -> DataFrame:
    """Most frequent non-null value per key from a (keys, value, n) table; the smallest on ties.

    `aggs` are further aggregates over the same groups.
    """
    # min over (-n, value) = highest count, then smallest value; NULL values do not take part.
    best = F.min(F.when(F.col(value).isNotNull(), F.struct((-F.col(n)).alias("rank"), F.col(value).alias("value"))))
    return counted.groupBy(*keys).agg(*aggs, best["value"].alias(value))


def mode_per_group(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """MODE() WITHIN GROUP (ORDER BY value) per key.

    Counted per (key, value) first. Spark's own `mode` keeps a map of all
    values of a key in one buffer and leaves the hash aggregate after 128 keys.
    """
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    return mode_of(counted, keys, value, "__n")


def span(df: DataFrame, keys: Sequence[str], ts: str, *, n: str, first: str, last: str) -> DataFrame:
    """Row count and first and last timestamp per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n), F.min(ts).alias(first), F.max(ts).alias(last))


def duplicate_keys(df: DataFrame, keys: Sequence[str], name: str = "duplicate_count") -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) > 1)


def count_if(condition: Column) -> Column:
    """COUNT(*) FILTER (WHERE condition)."""
    return F.count(F.when(condition, F.lit(1)))
