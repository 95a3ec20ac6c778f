"""Type-2 slowly changing dimensions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions.times import ntz
from strataflow.operators.keys import surrogate_ids
from strataflow.operators.ordered import change_points


def scd2_apply(
    dim: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    tracked: str,
    now: dt.datetime,
    *,
    id_col: str,
    created_cols: Sequence[str] = (),
) -> DataFrame:
    """Close the current row of each key whose tracked value changed and open a new one; open new keys.

    `batch` has one row per key. Unchanged keys and all history rows come out
    as they went in. Other attributes are set when a version opens and never open one.
    """
    stamp = ntz(now)
    incoming = batch.select(
        *keys, F.col(tracked).alias("__new_value"), F.lit(True).alias("__hit")
    )
    current = dim.filter("is_current")
    changed = F.col("__hit").isNotNull() & ~F.col("__new_value").eqNullSafe(F.col(tracked))

    def after(name: str) -> Column:
        if name == "valid_to":
            return F.when(changed, stamp).otherwise(F.col(name)).alias(name)
        if name == "is_current":
            return (~changed).alias(name)
        return F.col(name)

    kept = current.join(incoming, list(keys), "left").select(*[after(c) for c in dim.columns])
    history = dim.filter(~F.coalesce(F.col("is_current"), F.lit(False)))

    same = current.select(
        *[F.col(k).alias(f"__c_{k}") for k in keys], F.col(tracked).alias("__c_value")
    )
    on = [F.col(k) == F.col(f"__c_{k}") for k in keys]
    to_open = batch.join(same, [*on, F.col(tracked).eqNullSafe(F.col("__c_value"))], "left_anti")
    numbered = surrogate_ids(to_open, dim, id_col, keys)
    fixed = {
        "valid_from": stamp,
        "valid_to": F.lit(None),
        "is_current": F.lit(True),
        **{c: stamp for c in created_cols},
    }

    def opened(field) -> Column:
        value = fixed.get(field.name)
        if value is None:
            value = F.col(field.name) if field.name in numbered.columns else F.lit(None)
        return value.cast(field.dataType).alias(field.name)

    return history.unionByName(kept).unionByName(numbered.select(*[opened(f) for f in dim.schema.fields]))


def scd2_merge_rows(
    dim: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    tracked: str,
    now: dt.datetime,
    *,
    id_col: str,
    created_cols: Sequence[str] = (),
) -> DataFrame:
    """`scd2_apply` in one pass over the dimension: its rows after the batch, and `is_new`; new versions have no surrogate yet.

    A changed key gives two rows, the closed version and the new one. History rows meet nothing in the join, as only
    the current version of a key is looked for. `Warehouse.merge_dimension` numbers the new versions.
    """
    stamp = ntz(now)
    given = [c for c in batch.columns if c in dim.columns and c not in keys]
    incoming = batch.select(
        *keys, F.lit(True).alias("is_current"), *[F.col(c).alias(f"__s_{c}") for c in given if c != "is_current"], F.lit(True).alias("__hit")
    )
    known = dim.withColumnRenamed("is_current", "__was").withColumns(
        {"is_current": F.coalesce("__was", F.lit(False)), "__known": F.lit(True)}
    )
    both = known.join(incoming, [*keys, "is_current"], "full_outer")
    hit, there = F.col("__hit").isNotNull(), F.col("__known").isNotNull()
    changed = hit & there & ~F.col(f"__s_{tracked}").eqNullSafe(F.col(tracked))
    opened = {"valid_from": stamp, "valid_to": F.lit(None), "is_current": F.lit(True), id_col: F.lit(None)}
    opened |= {c: stamp for c in created_cols}

    def old(field) -> Column:
        name, value = field.name, F.col(field.name)
        if name == "valid_to":
            value = F.when(changed, stamp).otherwise(value)
        elif name == "is_current":
            value = F.when(changed, F.lit(False)).otherwise(F.col("__was"))
        return value.cast(field.dataType).alias(name)

    def new(field) -> Column:
        name = field.name
        value = F.col(name) if name in keys else opened.get(name, F.col(f"__s_{name}") if name in given else F.lit(None))
        return value.cast(field.dataType).alias(name)

    kept = F.struct(*[old(f) for f in dim.schema.fields], F.lit(False).alias("is_new"))
    fresh = F.struct(*[new(f) for f in dim.schema.fields], F.lit(True).alias("is_new"))
    rows = F.when(changed, F.array(kept, fresh)).when(there, F.array(kept)).otherwise(F.array(fresh))
    return both.select(F.inline(rows))


def scd2_history(
    changes: DataFrame,
    keys: Sequence[str],
    tracked: str,
    ts: str,
    *,
    last_by: Sequence[str] = (),
    slice_by: Column | None = None,
) -> DataFrame:
    """All versions that applying the changes one by one in time order would leave.

    Consecutive equal values make one version; intervals are half-open and the
    last one is current. (keys, ts) must be unique, or `last_by` says which of
    several changes at one instant counts. A change without a key or a time fails the job.
    """
    if last_by:
        newest = F.struct(*[F.col(c) for c in last_by])
        changes = changes.groupBy(*keys, ts).agg(F.max_by(tracked, newest).alias(tracked))
    versions = change_points(changes, keys, tracked, ts, until="valid_to", slice_by=slice_by)
    return versions.select(
        *keys,
        tracked,
        F.col(ts).alias("valid_from"),
        "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    )
