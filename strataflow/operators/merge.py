"""Keyed mutation as functions of (table, batch): upsert, insert-ignore, delete, replace, retention."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions.times import ntz, within
from strataflow.operators.keys import surrogate_ids
from strataflow.operators.pick import first_n_per_key, newest_first


def one_per_key(batch: DataFrame, keys: Sequence[str], last_by: Sequence[str]) -> DataFrame:
    """The last row of each key by `last_by`."""
    first, *rest = last_by
    return first_n_per_key(batch, keys, newest_first(first, rest))


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    *,
    last_by: Sequence[str] = (),
    insert_values: dict[str, Column] | None = None,
    touch: dict[str, Column] | None = None,
    guard: str | Sequence[str] = (),
) -> DataFrame:
    """Insert the source rows whose key is new, update `update_cols` of those whose key exists.

    A matched row takes the source value even where it is NULL; columns that
    are not in `update_cols` keep the target value, so created_at and
    surrogates survive. `touch` sets columns of matched rows, `insert_values`
    those of inserted rows. `last_by` reduces the source to one row per key
    first. With `guard`, a matched row is only updated if the source's values of these
    columns, compared in their order, are not older, which makes the order of the batches irrelevant.

    One shuffle per side on the key: the source reduction uses the same
    partitioning as the join, and both sides have one row per key, so no key is hot.
    """
    insert_values, touch = insert_values or {}, touch or {}
    if last_by:
        source = one_per_key(source, keys, last_by)
    given = [c for c in target.columns if c in source.columns and c not in keys]
    new = source.select(
        *keys, *[F.col(c).alias(f"__s_{c}") for c in given], F.lit(True).alias("__in_source")
    )
    old = target.withColumn("__in_target", F.lit(True))
    both = old.join(new, list(keys), "full_outer")
    matched = F.col("__in_target").isNotNull() & F.col("__in_source").isNotNull()
    guard = (guard,) if isinstance(guard, str) else guard
    if guard:
        ours, theirs = F.struct(*[F.col(g) for g in guard]), F.struct(*[F.col(f"__s_{g}") for g in guard])
        matched = matched & F.coalesce(theirs >= ours, F.lit(True))
    inserted = F.col("__in_target").isNull()

    def value(field) -> Column:
        name, kind = field.name, field.dataType
        if name in keys:
            return F.col(name)
        out = F.when(inserted, _insert_value(name, given, insert_values).cast(kind))
        if name in touch:
            out = out.when(matched, touch[name].cast(kind))
        elif name in update_cols:
            out = out.when(matched, F.col(f"__s_{name}").cast(kind))
        return out.otherwise(F.col(name)).alias(name)

    return both.select(*[value(f) for f in target.schema.fields])


def _insert_value(name: str, given: Sequence[str], insert_values: dict[str, Column]) -> Column:
    default = insert_values.get(name)
    if name in given:
        supplied = F.col(f"__s_{name}")
        return supplied if default is None else F.coalesce(supplied, default)
    return F.lit(None) if default is None else default


def dim_upsert(
    dim: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    *,
    id_col: str,
    now: dt.datetime,
    created_cols: Sequence[str] = (),
    touch_cols: Sequence[str] = (),
    last_by: Sequence[str] = (),
) -> DataFrame:
    """Type-1 upsert of a dimension: update in place, insert with a new surrogate.

    The batch is reduced to one row per key, the last by `last_by` (without it, by the
    updated columns), so that a key that is listed twice neither multiplies nor gets two
    surrogates. The dimension is joined from the left, so a batch small enough for Spark's
    size check is broadcast and the dimension is not shuffled.
    """
    order = list(last_by) or list(update_cols)
    batch = one_per_key(batch, keys, order) if order else batch.dropDuplicates(list(keys))
    stamp = ntz(now)
    new_side = batch.select(*keys, *[F.col(c).alias(f"__s_{c}") for c in update_cols], F.lit(True).alias("__hit"))
    hit = F.col("__hit").isNotNull()
    types = {f.name: f.dataType for f in dim.schema.fields}

    def kept(name: str) -> Column:
        if name in touch_cols:
            return F.when(hit, stamp).otherwise(F.col(name)).cast(types[name]).alias(name)
        if name in update_cols:
            return F.when(hit, F.col(f"__s_{name}")).otherwise(F.col(name)).cast(types[name]).alias(name)
        return F.col(name)

    updated = dim.join(new_side, list(keys), "left").select(*[kept(c) for c in dim.columns])
    absent = batch.join(dim.select(*keys), list(keys), "left_anti")
    numbered = surrogate_ids(absent, dim, id_col, keys)

    def fresh(name: str) -> Column:
        if name in numbered.columns:
            return F.col(name).cast(types[name])
        value = stamp if name in (*created_cols, *touch_cols) else F.lit(None)
        return value.cast(types[name]).alias(name)

    return updated.unionByName(numbered.select(*[fresh(c) for c in dim.columns]))


def dim_merge_rows(
    dim: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    *,
    id_col: str,
    now: dt.datetime,
    created_cols: Sequence[str] = (),
    touch_cols: Sequence[str] = (),
    last_by: Sequence[str] = (),
) -> DataFrame:
    """`dim_upsert` in one pass over the dimension: its rows after the batch, and `is_new`; new rows have no surrogate yet.

    For a table that is written as a whole, which numbers the new rows as they are there: `Warehouse.merge_dimension`.
    """
    order = list(last_by) or list(update_cols)
    batch = one_per_key(batch, keys, order) if order else batch.dropDuplicates(list(keys))
    stamp = ntz(now)
    given = [c for c in batch.columns if c in dim.columns and c not in keys]
    new_side = batch.select(*keys, *[F.col(c).alias(f"__s_{c}") for c in given], F.lit(True).alias("__hit"))
    both = dim.withColumn("__known", F.lit(True)).join(new_side, list(keys), "full_outer")
    hit, new = F.col("__hit").isNotNull(), F.col("__known").isNull()

    def value(name: str) -> Column:
        if name in keys:
            return F.col(name)
        fresh = stamp if name in (*created_cols, *touch_cols) else F.col(f"__s_{name}") if name in given else F.lit(None)
        if name == id_col:
            fresh = F.lit(None)
        changed = stamp if name in touch_cols else F.col(f"__s_{name}") if name in update_cols else F.col(name)
        return F.when(new, fresh).when(hit, changed).otherwise(F.col(name))

    return both.select(*[value(f.name).cast(f.dataType).alias(f.name) for f in dim.schema.fields], new.alias("is_new"))


def rows_to_insert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], *, first_by: Sequence[str] = ()
) -> DataFrame:
    """The source rows that ON CONFLICT DO NOTHING would insert: absent keys, first row of each key."""
    ordering = [F.col(c).asc() for c in first_by]
    batch = first_n_per_key(source, keys, ordering) if ordering else source.dropDuplicates(list(keys))
    return batch.join(target.select(*keys), list(keys), "left_anti")


def insert_ignore(
    target: DataFrame, source: DataFrame, keys: Sequence[str], *, first_by: Sequence[str] = ()
) -> DataFrame:
    """The target with the absent source rows appended."""
    added = rows_to_insert(target, source, keys, first_by=first_by)
    return target.unionByName(added, allowMissingColumns=True).select(*target.columns)


def insert_if_absent(target: DataFrame, source: DataFrame, match: Sequence[str]) -> DataFrame:
    """The source rows for which the target has no row with the same match columns."""
    return source.join(target.select(*match), list(match), "left_anti")


def delete_where(target: DataFrame, condition: Column) -> DataFrame:
    """Rows that DELETE ... WHERE condition leaves: those where it is false or NULL."""
    return target.filter(~F.coalesce(condition, F.lit(False)))


def delete_range(target: DataFrame, ts_col: str, start: dt.datetime, end: dt.datetime) -> DataFrame:
    return delete_where(target, within(F.col(ts_col), start, end))


def replace_range(
    target: DataFrame, batch: DataFrame, ts_col: str, start: dt.datetime, end: dt.datetime
) -> DataFrame:
    """Rows of the target outside [start, end) and all rows of the batch.

    A batch row outside the range fails the job when it is reached; it is
    neither loaded nor dropped in silence.
    """
    inside = F.coalesce(within(F.col(ts_col), start, end), F.lit(False))
    checked = batch.filter(
        F.when(inside, F.lit(True)).otherwise(
            F.raise_error(F.lit(f"batch row outside [{start}, {end}) in {ts_col}")).cast("boolean")
        )
    )
    return delete_range(target, ts_col, start, end).unionByName(checked.select(*target.columns))


def retention_split(target: DataFrame, month_col: str, cutoff: dt.date) -> tuple[DataFrame, DataFrame]:
    """(kept, archived): whole months before `cutoff` are archived.

    Both filters are on the partition column, so each side only lists its own months.
    """
    old = F.col(month_col) < F.lit(cutoff)
    return target.filter(~F.coalesce(old, F.lit(False))), target.filter(old)


def split_atomic(df: DataFrame, entity: Sequence[str], is_bad: Column) -> tuple[DataFrame, DataFrame]:
    """(good, voided): one bad row voids every row of its entity.

    The bad entities are reduced to one row each before the join, so Spark
    broadcasts them where they are few; no entity is gathered in one task. Rows
    without an entity belong together as well.
    """
    bad = df.filter(is_bad).select(*[F.col(c).alias(f"__bad_{c}") for c in entity]).distinct()
    same = [df[c].eqNullSafe(bad[f"__bad_{c}"]) for c in entity]
    return df.join(bad, same, "left_anti"), df.join(bad, same, "left_semi")


def not_in(batch: DataFrame, target: DataFrame, match: Sequence[str]) -> DataFrame:
    """The batch rows whose match columns, NULLs included, no target row has; repeated batch rows stay."""
    there = target.select(*[F.col(c).alias(f"__there_{c}") for c in match]).distinct()
    return batch.join(there, [batch[c].eqNullSafe(there[f"__there_{c}"]) for c in match], "left_anti")
