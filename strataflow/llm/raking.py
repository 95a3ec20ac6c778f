"""Mixing documents to target weights by iterative proportional fitting, with DataFrame functions only.

Documents are counted into cells, one for each combination of values of the marginals (such as source, language and
topic). The cells' token weights are raked: for one marginal after the other they are scaled to its target shares,
until all hold together. A cell's weight over its tokens then calibrates the probability with which each of its
documents is sampled, so that the tokens sampled meet every target in expectation.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.session import stage

WORD = r"[^\x20\x09-\x0D]+"
TEMPER = 0.7
SWEEPS, TOLERANCE = 50, 1e-9
NOTHING = "-"


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def name_of(value: Column) -> Column:
    """A marginal's value as a key that is never null: `=value`, and `-` for null."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(NOTHING))


def tempered(cells: DataFrame, dim: str, temper: float) -> DataFrame:
    """Target shares (dim, share) in proportion to the tokens raised to `temper`: 1 keeps the mix, 0 levels it."""
    sums = cells.groupBy(dim).agg(F.sum("tokens").cast("double").alias("t"))
    powers = sums.select(dim, F.pow("t", F.lit(temper)).alias("share"))
    return stage(powers, "rake-target")


def rake(
    cells: DataFrame, dims: Sequence[str], targets: Mapping[str, DataFrame], sweeps: int = SWEEPS, tolerance: float = TOLERANCE
) -> DataFrame:
    """Add `weight` to cells (dims, tokens): weights sum to one, and to the target share for each value of each dim.

    A target (dim, share) holds one row per value; shares need not sum to one. Values without a target, or with a null
    or no positive share, get no weight; a target that meets no tokens is left out and the others share its part. Every
    sweep adds up the cells by value, pre-aggregated, and is written, so that the plan does not grow with the sweeps.
    Targets that contradict each other are not met, however many sweeps are made; a warning says so.
    """
    fitted = cells.filter("tokens > 0").withColumn("weight", F.col("tokens").cast("double"))
    for dim in dims:
        shares = targets[dim].filter("share > 0").select(F.col(dim), F.col("share").cast("double").alias(f"share_{dim}"))
        fitted = fitted.join(shares, dim)
    fitted = stage(fitted, "rake")
    for dim in dims:  # among the values that are there, shares sum to one
        total = fitted.select(dim, f"share_{dim}").distinct().agg(F.sum(f"share_{dim}")).first()[0]
        fitted = fitted.withColumn(f"share_{dim}", F.col(f"share_{dim}") / F.lit(total or 1.0))
    for _ in range(sweeps):
        off = F.lit(0.0)
        for dim in dims:
            sums = fitted.groupBy(dim).agg(F.sum("weight").alias("__sum"))
            fitted = fitted.join(sums, dim)
            scale = F.col(f"share_{dim}") / F.col("__sum")
            off = F.greatest(off, F.abs(scale - 1))
            fitted = fitted.withColumn("weight", F.col("weight") * scale).withColumn("__off", off).drop("__sum")
            off = F.col("__off")
        fitted = stage(fitted, "rake")
        worst = fitted.agg(F.max("__off")).first()[0]
        fitted = fitted.drop("__off")
        if worst is None or worst < tolerance:
            break
    else:
        warnings.warn(f"the targets are not met after {sweeps} sweeps; the last moved a weight by a share of {worst:.1e}", stacklevel=2)
    return fitted.drop(*[f"share_{d}" for d in dims])


def uniform(key: Column, fallback: Column, seed: int) -> Column:
    """A number in [0, 1) that the key alone decides (the fallback where it is null)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), fallback, F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / float(1 << 52)


def mix(
    df: DataFrame,
    marginals: Mapping[str, Column],
    *,
    targets: Mapping[str, DataFrame] | None = None,
    temper: float = TEMPER,
    budget: int | None = None,
    key: str = "doc_id",
    text: str = "text",
    seed: int = 7,
    drop: Sequence[str] = (),
    names: Sequence[str] = ("n_tokens", "weight", "probability", "copies"),
) -> DataFrame:
    """Add n_tokens, weight, probability and copies, under these or other `names`, to every document.

    `marginals` names the dims and gives their columns, `targets` their shares as (dim, share) with values written as in
    `name_of`; a dim without one is tempered. `weight` is the document's share of the raked tokens over its share of the
    corpus. Without a budget, `probability` is the largest multiple of the weight that is at most one everywhere, and
    `copies` is 1 for a sampled document, else 0. With a budget of tokens the multiple is what the budget asks for in
    expectation, and a document with a probability above one is repeated.

    The decision depends on the key alone (on the text where it is null), so repeated rows fare alike. Null values of a
    marginal are a value of their own. A null or wordless text has no tokens, weight nothing, and is not sampled. An
    empty table gives an empty one. Input columns that clash with the added ones, in any case, are replaced.
    """
    added = {n.lower() for n in names}
    others = [c for c in df.columns if c.lower() not in added and c not in drop]
    dims = [f"__dim_{d}" for d in marginals]
    named = [name_of(c).alias(d) for d, c in zip(dims, marginals.values(), strict=True)]
    draw = uniform(F.col(key), F.col(text), seed)
    rows = df.select(*[F.col(f"`{c}`") for c in others], *named, count_words(F.col(text)).alias("__n"), draw.alias("__u"))
    cells = stage(rows.groupBy(*dims).agg(F.sum("__n").alias("tokens")), "rake-cells")
    told = {f"__dim_{d}": t.withColumnRenamed(d, f"__dim_{d}") for d, t in (targets or {}).items()}
    told = {d: told[d] if d in told else tempered(cells, d, temper) for d in dims}
    fitted = rake(cells, dims, told)
    tokens, weights = fitted.agg(F.sum("tokens"), F.max(F.col("weight") / F.col("tokens"))).first()
    tokens = float(tokens or 1)
    ratio = (F.col("weight") / F.col("tokens") * tokens).alias("__ratio")
    per_cell = stage(fitted.select(*dims, ratio), "rake-ratio")
    scale = budget / tokens if budget is not None else 1 / ((weights or 1.0) * tokens)
    joined = rows.join(per_cell, dims, "left")
    weight = F.when(F.col("__n") > 0, F.coalesce("__ratio", F.lit(0.0))).otherwise(0.0)
    probability = weight * F.lit(scale)
    copies = F.floor(probability) + F.when(F.col("__u") < probability - F.floor(probability), 1).otherwise(0)
    return joined.select(
        *[F.col(f"`{c}`") for c in others],
        F.col("__n").alias(names[0]),
        weight.alias(names[1]),
        probability.alias(names[2]),
        copies.cast("int").alias(names[3]),
    )


def format_of(text: Column) -> Column:
    """A topic that the form of a text tells: legal, table, noise, shouting, contact, prose, or empty."""
    t = F.coalesce(text, F.lit(""))
    has = lambda *parts: F.greatest(*[t.contains(p) for p in parts], F.lit(False))
    return (
        F.when(t == "", "empty")
        .when(has("icense", "ICENSE", "opyright", "ights reserved"), "legal")
        .when(has(" | "), "table")
        .when(has("%%%", "###", "$$$", "&&&", "***"), "noise")
        .when(has("!!"), "shouting")
        .when(has("@", "+1 ("), "contact")
        .otherwise("prose")
    )
