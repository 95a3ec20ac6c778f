"""Schema evolution, schema contracts and optional columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType


def optional(df: DataFrame, name: str, kind: DataType | str) -> Column:
    """The column if the table has it, else a typed NULL of the same name."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind).alias(name)


def evolve(
    df: DataFrame,
    *,
    rename: dict[str, str] | None = None,
    retype: dict[str, str] | None = None,
    add: dict[str, str] | None = None,
    backfill: dict[str, Column] | None = None,
) -> DataFrame:
    """Rename, change type, add NULL columns and backfill NULLs, in this order.

    Every step is skipped where it is already done, so the script can run again.
    """
    for old, new in (rename or {}).items():
        if old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    changes: dict[str, Column] = {}
    for name, kind in (retype or {}).items():
        if name in df.columns:
            changes[name] = F.col(name).cast(kind)
    for name, kind in (add or {}).items():
        if name not in df.columns:
            changes[name] = F.lit(None).cast(kind)
    df = df.withColumns(changes) if changes else df
    if backfill:
        kinds = {f.name: f.dataType for f in df.schema.fields}
        df = df.withColumns({c: F.coalesce(F.col(c), v.cast(kinds[c])) for c, v in backfill.items()})
    return df


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the schema's columns in order, cast, with NULL for absent ones."""
    return df.select(
        *[optional(df, f.name, f.dataType).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def contract_report(df: DataFrame, expected: StructType) -> DataFrame:
    """One row per expected column: (column_name, expected_type, actual_type, is_nullable, ok, null_count).

    Types come from the schema, the NULLs of all columns from one aggregation.
    """
    have = {f.name: f for f in df.schema.fields}
    present = [f.name for f in expected.fields if f.name in have]
    totals = df.agg(
        F.count(F.lit(1)).alias("__rows"), *[F.count(c).alias(f"__n_{i}") for i, c in enumerate(present)]
    )

    def line(field: StructField) -> Column:
        found = have.get(field.name)
        kind = found.dataType.simpleString() if found else None
        want = field.dataType.simpleString()
        nulls = F.col("__rows") - F.col(f"__n_{present.index(field.name)}") if found else F.lit(None)
        return F.struct(
            F.lit(field.name).alias("column_name"),
            F.lit(want).alias("expected_type"),
            F.lit(kind).cast("string").alias("actual_type"),
            F.lit(found.nullable if found else None).cast("boolean").alias("is_nullable"),
            F.lit(kind == want).alias("ok"),
            nulls.cast("bigint").alias("null_count"),
        )

    return totals.select(F.inline(F.array(*[line(f) for f in expected.fields])))


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]
