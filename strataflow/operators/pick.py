"""Pick rows per key: latest, latest n, rows at the maximum, prioritized fallback."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_first(order: str, tie: Sequence[str] = ()) -> list[Column]:
    """Descending with NULLs first, then the tie-break columns descending."""
    return [F.col(order).desc_nulls_first(), *[F.col(t).desc() for t in tie]]


def first_n_per_key(df: DataFrame, keys: Sequence[str], ordering: Sequence[Column], n: int = 1) -> DataFrame:
    """The first n rows of each key in the given order; NULL keys form one group.

    Spark applies the row_number limit before the shuffle as well
    (WindowGroupLimit), so at most n rows per key leave each input task and a
    hot key is no larger than n rows times the number of tasks.
    """
    window = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn("__rank", F.row_number().over(window)).filter(F.col("__rank") <= n).drop("__rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: str, tie: Sequence[str] = ()) -> DataFrame:
    """One row per key: the newest by `order`, ties broken by `tie` descending."""
    return first_n_per_key(df, keys, newest_first(order, tie), 1)


def latest_n_per_key(df: DataFrame, keys: Sequence[str], order: str, n: int, tie: Sequence[str] = ()) -> DataFrame:
    return first_n_per_key(df, keys, newest_first(order, tie), n)


def rows_at_max(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """All rows whose `order` equals the maximum of their key, ties included.

    The maximum is a pre-aggregated table of one row per key. It is joined on
    the keys *and* the maximum, so rows of a hot key spread by their order
    value instead of meeting in one task.
    """
    top = df.groupBy(*keys).agg(F.max(order).alias(order))
    return df.join(top, [*keys, order], "left_semi")


def top_rows(df: DataFrame, ordering: Sequence[Column], n: int) -> DataFrame:
    """ORDER BY ... LIMIT n; give a unique tie-break last."""
    return df.orderBy(*ordering).limit(n)


def first_match(
    entities: DataFrame,
    candidates: Sequence[Column],
    lookup: DataFrame,
    lookup_key: str,
    entity_key: Sequence[str],
) -> DataFrame:
    """Try the candidate texts in order for each entity; keep the first that the lookup has.

    NULL candidates are skipped. Entities without any hit are dropped. The
    lookup must have one row per `lookup_key`. Returns the entity key, the
    position (from 0) and text of the winning candidate, and the lookup columns.
    """
    tried = entities.select(
        *entity_key, F.posexplode(F.array(*candidates)).alias("candidate_position", "candidate")
    ).filter(F.col("candidate").isNotNull())
    hits = tried.join(lookup.withColumnRenamed(lookup_key, "candidate"), "candidate")
    return first_n_per_key(hits, entity_key, [F.col("candidate_position").asc()], 1)


def candidate_titles(city: Column, region: Column, country: Column, alternative: Column) -> list[Column]:
    """Page titles to try, most specific first; the alternative name only where it differs from the city."""

    def variants(name: Column) -> list[Column]:
        region_set, country_set = F.nullif(region, F.lit("")), F.nullif(country, F.lit(""))
        comma = F.lit(", ")
        return [
            F.concat(name, comma, region_set, comma, country_set),
            F.concat(name, comma, region_set),
            F.concat(name, comma, country_set),
            name,
        ]

    name = F.coalesce(F.nullif(city, F.lit("")), alternative)
    other = F.when(~name.eqNullSafe(alternative), F.nullif(alternative, F.lit("")))
    return variants(name) + variants(other)
