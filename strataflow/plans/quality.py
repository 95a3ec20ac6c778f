"""Expectations, checkpoints and the gate before the marts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow import schemas
from strataflow.operators.aggregate import count_if
from strataflow.operators.pick import newest_first, top_rows


class DataQualityError(RuntimeError):
    """A checkpoint failed; marts stay at their previous version."""


@dataclass(frozen=True)
class ColumnRule:
    """A share of at least `mostly` of the non-null values meets the condition."""

    name: str
    kind: str
    column: str
    low: float | None = None
    high: float | None = None
    strict: bool = False
    mostly: float = 1.0

    def holds(self) -> Column:
        ok, value = F.lit(True), F.col(self.column)
        if self.low is not None:
            ok = ok & (value > self.low if self.strict else value >= self.low)
        if self.high is not None:
            ok = ok & (value < self.high if self.strict else value <= self.high)
        return ok


@dataclass(frozen=True)
class Suite:
    """What a table must meet."""

    name: str
    unique: tuple[str, ...] = ()
    rules: tuple[ColumnRule, ...] = ()
    required: tuple[str, ...] = ()
    # (dimension, key, least rows) and (dimension, key)
    min_rows: tuple[DataFrame, str, int] | None = field(default=None, compare=False)
    references: tuple[DataFrame, str] | None = field(default=None, compare=False)


def in_range(column: str, bounds: tuple[float, float], mostly: float = schemas.MOSTLY) -> ColumnRule:
    return ColumnRule(f"{column}_in_range", "range", column, bounds[0], bounds[1], mostly=mostly)


def positive(column: str) -> ColumnRule:
    return ColumnRule(f"{column}_positive", "positive", column, low=0, strict=True)


def weather_suite(location: DataFrame | None = None) -> Suite:
    return Suite(
        "weather_fact_suite",
        unique=schemas.WEATHER_KEY,
        rules=(
            in_range("temperature_celsius", schemas.TEMPERATURE_RANGE),
            in_range("humidity_percent", schemas.HUMIDITY_RANGE),
            in_range("wind_speed_mps", schemas.WIND_RANGE),
        ),
        required=schemas.WEATHER_REQUIRED,
        min_rows=None if location is None else (location, "location_id", schemas.MIN_ROWS_PER_LOCATION),
    )


def revision_suite(page: DataFrame | None = None) -> Suite:
    return Suite(
        "wikipedia_revision_suite",
        unique=schemas.REVISION_KEY,
        rules=(positive("content_len"),),
        required=schemas.REVISION_REQUIRED,
        references=None if page is None else (page, "page_id"),
    )


def recent_batch(df: DataFrame, ts: str, tie: Sequence[str], n: int = schemas.QUALITY_BATCH_ROWS) -> DataFrame:
    """The newest n rows: the batch a checkpoint looks at unless the caller gives one."""
    return top_rows(df, newest_first(ts, tie), n)


def missing_references(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key is not in the dimension."""
    return fact.join(dim.select(key).distinct(), key, "left_anti")


def entities_below(fact: DataFrame, dim: DataFrame, key: str, least: int) -> DataFrame:
    """Dimension keys with fewer than `least` fact rows, and their row count."""
    counts = fact.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    return (
        dim.select(key)
        .join(counts, key, "left")
        .select(key, F.coalesce("row_count", F.lit(0)).alias("row_count"))
        .filter(F.col("row_count") < least)
    )


def rule_counts(df: DataFrame, rules: Sequence[ColumnRule]) -> DataFrame:
    """(name, kind, column, evaluated, unexpected, ratio, threshold, success) of all rules from one pass."""
    rules = [r for r in rules if r.column in df.columns]
    counts = []
    for i, rule in enumerate(rules):
        counts += [F.count(rule.column).alias(f"n{i}"), count_if(~rule.holds()).alias(f"bad{i}")]
    totals = df.agg(*counts)
    lines = [
        F.struct(
            F.lit(r.name).alias("name"),
            F.lit(r.kind).alias("kind"),
            F.lit(r.column).alias("column"),
            F.col(f"n{i}").alias("evaluated"),
            F.col(f"bad{i}").alias("unexpected"),
            F.lit(float(r.mostly)).alias("threshold"),
        )
        for i, r in enumerate(rules)
    ]
    return _judged(totals.select(F.inline(F.array(*lines))))


def _judged(counted: DataFrame) -> DataFrame:
    """Add ratio and success: an expectation over no values holds."""
    ratio = F.when(F.col("evaluated") > 0, (F.col("evaluated") - F.col("unexpected")) / F.col("evaluated")).otherwise(
        F.lit(1.0)
    )
    return counted.select(
        "name",
        "kind",
        "column",
        F.col("evaluated").cast("bigint").alias("evaluated"),
        F.col("unexpected").cast("bigint").alias("unexpected"),
        ratio.alias("ratio"),
        "threshold",
        (ratio >= F.col("threshold")).alias("success"),
    )


def _line(counted: DataFrame, name: str, kind: str, column: str) -> DataFrame:
    """One result line from a one-row (evaluated, unexpected) frame."""
    return _judged(
        counted.select(
            F.lit(name).alias("name"),
            F.lit(kind).alias("kind"),
            F.lit(column).alias("column"),
            "evaluated",
            "unexpected",
            F.lit(1.0).alias("threshold"),
        )
    )


def unique_line(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that share their key with another row count as unexpected."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    counted = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("evaluated"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("unexpected"),
    )
    return _line(counted, "unique_" + "_".join(keys), "unique", ",".join(keys))


def added_unique_line(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What `new` rows add to `unique_line` of a table of `old` rows; of these only the keys of new rows are looked at.

    A key that gets its second row makes the first unexpected as well.
    """
    keys = list(keys)
    fresh = new.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    there = old.select(*keys).join(fresh.select(*keys), keys, "left_semi")
    both = fresh.join(there.groupBy(*keys).agg(F.count(F.lit(1)).alias("m")), keys, "left")
    more = F.when(F.col("m").isNull(), F.when(F.col("n") > 1, F.col("n"))).otherwise(F.col("n") + (F.col("m") == 1).cast("int"))
    counted = both.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("evaluated"), F.coalesce(F.sum(more), F.lit(0)).alias("unexpected")
    )
    return _line(counted, "unique_" + "_".join(keys), "unique", ",".join(keys))


def min_rows_line(df: DataFrame, dim: DataFrame, key: str, least: int, counts: DataFrame | None = None) -> DataFrame:
    """`counts` (key, n) where the rows per key are known already."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")) if counts is None else counts
    counted = (
        dim.select(key)
        .join(counts, key, "left")
        .agg(
            F.count(F.lit(1)).alias("evaluated"),
            count_if(F.coalesce("n", F.lit(0)) < least).alias("unexpected"),
        )
    )
    return _line(counted, f"min_rows_per_{key}", "min_rows", key)


def reference_line(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    # Fact keys are counted before the join: a hot key is one row.
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    known = dim.select(key).distinct().withColumn("__known", F.lit(True))
    counted = counts.join(known, key, "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("evaluated"),
        F.coalesce(F.sum(F.when(F.col("__known").isNull(), F.col("n"))), F.lit(0)).alias("unexpected"),
    )
    return _line(counted, f"{key}_in_dimension", "referential", key)


def required_lines(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """One line per required column; only the schema is looked at."""
    rows = [
        (f"{c}_exists", "required", c, 1, int(c not in df.columns), float(c in df.columns), 1.0, c in df.columns)
        for c in required
    ]
    return df.sparkSession.createDataFrame(
        rows,
        "name string, kind string, column string, evaluated bigint, unexpected bigint,"
        " ratio double, threshold double, success boolean",
    )


def checkpoint(df: DataFrame, suite: Suite, name: str, *, counted: DataFrame | None = None) -> DataFrame:
    """One row per expectation, labelled with checkpoint and suite names.

    Where `df` is only the part that a run has changed, `counted` (key, n) has the rows of the whole table per key,
    for the rule on their minimum. All column rules come from one aggregation; uniqueness, minimum rows and
    references take one more each.
    """
    parts: list[DataFrame] = []
    if suite.rules:
        parts.append(rule_counts(df, suite.rules))
    if suite.unique:
        parts.append(unique_line(df, suite.unique))
    if suite.min_rows:
        parts.append(min_rows_line(df, *suite.min_rows, counts=counted))
    if suite.references:
        parts.append(reference_line(df, *suite.references))
    if suite.required:
        parts.append(required_lines(df, suite.required))
    lines = parts[0]
    for part in parts[1:]:
        lines = lines.unionByName(part)
    return lines.select(F.lit(name).alias("checkpoint_name"), F.lit(suite.name).alias("suite_name"), "*")


def checkpoint_of(
    spark: SparkSession, suite: Suite, counts: dict[str, Sequence[int]], columns: Sequence[str], name: str
) -> DataFrame:
    """The lines of `checkpoint` from counts that are known: expectation -> (evaluated, unexpected)."""
    kinds = [(r.name, r.kind, r.column, r.mostly) for r in suite.rules]
    kinds.append(("unique_" + "_".join(suite.unique), "unique", ",".join(suite.unique), 1.0))
    if suite.references:
        kinds.append((f"{suite.references[1]}_in_dimension", "referential", suite.references[1], 1.0))
    rows = [(n, kind, column, *map(int, counts[n]), float(mostly)) for n, kind, column, mostly in kinds]
    shape = "name string, kind string, column string, evaluated bigint, unexpected bigint, threshold double"
    lines = _judged(spark.createDataFrame(rows, shape))
    if suite.required:
        lines = lines.unionByName(required_lines(spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns)), suite.required))
    return lines.select(F.lit(name).alias("checkpoint_name"), F.lit(suite.name).alias("suite_name"), "*")


def summary(results: DataFrame) -> DataFrame:
    """One row per checkpoint: success and statistics."""
    return results.groupBy("checkpoint_name", "suite_name").agg(
        F.every("success").alias("success"),
        F.count(F.lit(1)).alias("evaluated_expectations"),
        count_if(F.col("success")).alias("successful_expectations"),
        count_if(~F.col("success")).alias("unsuccessful_expectations"),
    )


def enforce(results: DataFrame) -> DataFrame:
    """Raise DataQualityError if an expectation failed, else return the results.

    Only failed lines are fetched; there is one line per expectation, never per data row.
    """
    failed = results.filter(~F.col("success")).collect()
    if failed:
        raise DataQualityError(
            "; ".join(f"{r['checkpoint_name']}: {r['name']} ({r['unexpected']} of {r['evaluated']})" for r in failed)
        )
    return results


