"""Near-duplicate vectors by Euclidean p-stable hashing, confirmed by exact cosine.

Vectors of one label are normalised and hashed by `tables` functions of `projections` quantised Gaussian projections
each: floor((a . x + b) / width). Vectors that share all projections of a table meet in its bucket, and every pair of
a bucket is compared by cosine in double precision. Buckets of any size are compared whole, in blocks: the pairs of
blocks are dealt out over tasks, and a block pair gives a row per vector, not per pair.

With the default parameters a pair at cosine 0.93 shares a table with probability 0.999, a closer one with more. The
pairs of a label that share none are found too: blocks of whole labels are held against each other by a few of the same
projections, made orthogonal, which bound the cosine from above; what the bound lets through is compared by cosine.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.batches import runs
from strataflow.llm.components import components
from strataflow.session import stage

THRESHOLD = 0.93
TABLES, PROJECTIONS, WIDTH, SEED = 32, 10, 2.0, 20231
# Vectors of a bucket that are compared at once.
BLOCK = 512
# A block of a whole label: this many times BLOCK, or fewer long vectors, of so many components together.
WIDER, BLOCK_COMPONENTS = 64, 1 << 21
# Projections that bound the cosine, and what single precision may take off the bound.
SKETCH, SLACK = 16, 1e-5
# Cosines of unit vectors this close to the threshold are computed anew, from the vectors as they were given.
EDGE = 1e-9
# Codes come of whole multiples of 1 / FIXED, whose products and sums are exact.
FIXED = 1 << 20

LINKS = "a long, b long, n long"


@functools.lru_cache(maxsize=4)
def projections(dim: int, tables: int, per_table: int, width: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions (dim, tables * per_table) and offsets; the same for a dimension on every machine."""
    draw = np.random.default_rng([seed, dim])
    return draw.standard_normal((dim, tables * per_table)), draw.uniform(0, width, tables * per_table)


def codes(vectors: np.ndarray, tables: int, per_table: int, width: float, seed: int) -> np.ndarray:
    """A 64-bit bucket code for each normalised vector and table, the same in any batch and on any machine."""
    directions, offsets = projections(vectors.shape[1], tables, per_table, width, seed)
    along = np.rint(vectors * FIXED) @ np.rint(directions * FIXED) + np.rint(offsets * FIXED * FIXED)
    cells = np.floor(along / (width * FIXED * FIXED)).astype(np.int64).reshape(-1, tables, per_table)
    weights = np.random.default_rng([seed, 1]).integers(1, 1 << 62, per_table, dtype=np.int64) | 1
    with np.errstate(over="ignore"):
        return (cells * weights).sum(axis=2)


def sketch(unit: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """A few components of each vector and the length of the rest: the products of two sketches bound the cosine from above."""
    axes = np.linalg.qr(directions[:, : min(SKETCH, unit.shape[1])])[0]
    seen = unit @ axes
    rest = np.sqrt(np.maximum(0, 1 - (seen * seen).sum(axis=1, keepdims=True)))
    return np.hstack([seen, rest]).astype(np.float32)


def cosine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Of each row with its counterpart; powers of two keep the sums in range and round nothing."""
    left, right = (np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1]) for v in (left, right))
    return (left * right).sum(axis=1) / np.sqrt((left * left).sum(axis=1) * (right * right).sum(axis=1))


def normal(vectors: np.ndarray) -> np.ndarray:
    """The rows, finite and not zero, at length one."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # so that the norm neither overflows nor vanishes
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def embeddings(part: pa.Table) -> np.ndarray:
    """The vectors of a block, all of one length."""
    flat = part.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(part.num_rows, -1)


def linked(found: np.ndarray, a: np.ndarray, b: np.ndarray, given: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs reach the threshold, of those whose unit vectors come within EDGE of it; `found` are their products."""
    enough = found >= threshold
    edge = np.flatnonzero(np.abs(found - threshold) <= EDGE)
    for at in range(0, len(edge), 1 << 12):
        some = edge[at : at + (1 << 12)]
        enough[some] = cosine(given[a[some]], given[b[some]]) >= threshold
    return enough


def apart(unit: np.ndarray, a: np.ndarray, b: np.ndarray, upto: int, *params) -> np.ndarray:
    """The places of the pairs that meet in none of the first `upto` tables."""
    left = np.arange(len(a))
    if upto and len(a):
        met, place = np.unique(np.concatenate([a, b]), return_inverse=True)
        code = codes(unit[met], *params)
        u, v = place[: len(a)], place[len(a) :]
        for tab in range(upto):
            left = left[code[u[left], tab] != code[v[left], tab]]
    return left


def grouped(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The first row of each row's group: of the groups `root`, joined where a row of `a` links with its counterpart in `b`."""
    u, v = root[a], root[b]
    while (u != v).any():
        np.minimum.at(root, np.maximum(u, v), np.minimum(u, v))
        while ((up := root[root]) != root).any():
            root = up
        u, v = root[a], root[b]
    return root


def link_rows(rep: np.ndarray, root: np.ndarray, count: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Each row with the first of its group; edges to least neighbours alone would leave out links inside a chain."""
    least = rep[root]
    told = (count > 0) | (least != rep)
    if told.any():
        yield pa.RecordBatch.from_arrays(
            [pa.array(rep[told]), pa.array(least[told]), pa.array(count[told])], names=["a", "b", "n"]
        )


def find_links(
    distinct: DataFrame,
    threshold: float,
    tables: int,
    per_table: int,
    width: float,
    seed: int,
    block: int,
) -> DataFrame:
    """(a, b, n): summed over the rows of an `a`, `n` is how many vectors link with it; the edges a - b connect what links connect.

    `distinct` has (label, rep, copies, embedding), one row per different vector, the label as a hash. A pair that meets in several tables
    counts at the first of them only, which its codes tell.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, rep, copies, vectors = (c.to_pylist() for c in batch.columns)
            by_dim: dict[int, list[int]] = {}
            for i, vector in enumerate(vectors):
                by_dim.setdefault(len(vector), []).append(i)
            for dim, found in by_dim.items():
                for lo in range(0, len(found), 256):
                    rows = found[lo : lo + 256]
                    unit = normal(np.array([vectors[i] for i in rows], np.float64))
                    code = codes(unit, tables, per_table, width, seed)
                    every = [i for i in rows for _ in range(tables)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([label[i] for i in every], pa.int64()),
                            pa.array([dim] * len(every), pa.int32()),
                            pa.array(list(range(tables)) * len(rows), pa.int32()),
                            pa.array(code.ravel()),
                            pa.array([rep[i] for i in every], pa.int64()),
                            pa.array([copies[i] for i in every], pa.int64()),
                        ],
                        names=["label", "dim", "tab", "code", "rep", "copies"],
                    )

    buckets = distinct.select("label", "rep", "copies", "embedding").mapInArrow(
        hashed, "label long, dim int, tab int, code long, rep long, copies long"
    )
    key = ["label", "dim", "tab", "code"]
    # Only ids are dealt by bucket here. Blocks are chosen by hash, so that a bucket needs no numbering.
    sizes = buckets.groupBy(*key).agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = buckets.join(sizes, key).withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    members = members.withColumn("own", F.pmod(F.xxhash64("rep", "tab"), F.col("blocks")).cast("int"))
    members = members.join(distinct.select("label", "rep", "embedding"), ["label", "rep"])
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = members.select(*key, "rep", "copies", "embedding", "own", other)
    key += ["lo", "hi"]
    pair = {"lo": F.least("own", "other"), "hi": F.greatest("own", "other")}
    dealt = dealt.withColumns(pair).select(*key, "own", "rep", "copies", "embedding")
    dealt = dealt.repartition(*key).sortWithinPartitions(*key, "rep")

    params = tables, per_table, width, seed

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in runs(batches, key):
            tab, lo, hi = (part.column(c)[0].as_py() for c in ("tab", "lo", "hi"))
            own, rep, copies = (part.column(c).to_numpy() for c in ("own", "rep", "copies"))
            given = embeddings(part)
            unit = normal(given)
            left, right = np.flatnonzero(own == lo), np.flatnonzero(own == hi)
            count, root = np.zeros(part.num_rows, np.int64), np.arange(part.num_rows)
            for start in range(0, len(left), block):
                rows = left[start : start + block]
                found = unit[rows] @ unit[right].T
                near = found >= threshold - EDGE
                if lo == hi:
                    near &= rows[:, None] < right[None, :]
                i, j = np.nonzero(near)
                a, b = rows[i], right[j]
                enough = linked(found[i, j], a, b, given, threshold)
                a, b = a[enough], b[enough]
                root = grouped(root, a, b)
                new = apart(unit, a, b, tab, *params)  # a pair is counted where the two first met
                a, b = a[new], b[new]
                np.add.at(count, a, copies[b])
                np.add.at(count, b, copies[a])
            yield from link_rows(rep, root, count)

    rest = unmet_links(distinct, threshold, tables, per_table, width, seed, block)
    return dealt.mapInArrow(compare, LINKS).unionByName(rest)


def unmet_links(
    distinct: DataFrame,
    threshold: float,
    tables: int,
    per_table: int,
    width: float,
    seed: int,
    block: int,
) -> DataFrame:
    """The links, as in `find_links`, of vectors that share no bucket, of which hashing alone would leave out a few.

    All vectors of a label and a length are held against each other, so the time grows with the square of a label; a task
    holds two blocks. A sketch of SKETCH + 1 numbers settles most pairs.
    """
    params = tables, per_table, width, seed
    rows = distinct.select("label", F.size("embedding").alias("dim"), "rep", "copies", "embedding")
    fit = F.greatest(F.lit(256), F.floor(F.lit(BLOCK_COMPONENTS) / F.col("dim")))
    blocks = F.ceil(F.col("size") / F.least(F.lit(block * WIDER), fit)).cast("int")
    sizes = rows.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = rows.join(sizes.select("label", "dim", blocks.alias("blocks")), ["label", "dim"])
    members = members.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = members.select("label", "dim", "rep", "copies", "embedding", "own", other)
    key = ["label", "dim", "lo", "hi"]
    pair = {"lo": F.least("own", "other"), "hi": F.greatest("own", "other")}
    dealt = dealt.withColumns(pair).select(*key, "own", "rep", "copies", "embedding")
    dealt = dealt.repartition(*key).sortWithinPartitions(*key, "rep")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in runs(batches, key):
            lo, hi = (part.column(c)[0].as_py() for c in ("lo", "hi"))
            own, rep, copies = (part.column(c).to_numpy() for c in ("own", "rep", "copies"))
            given = embeddings(part)
            unit = normal(given)
            short = sketch(unit, projections(unit.shape[1], *params)[0])
            left, right = np.flatnonzero(own == lo), np.flatnonzero(own == hi)
            count, root = np.zeros(part.num_rows, np.int64), np.arange(part.num_rows)
            for start in range(0, len(left), 512):
                rows = left[start : start + 512]
                for at in range(start if lo == hi else 0, len(right), 2048):
                    cols = right[at : at + 2048]
                    near = short[rows] @ short[cols].T >= np.float32(threshold - SLACK)
                    if lo == hi and at < start + 512:
                        near &= rows[:, None] < cols[None, :]
                    passed = np.count_nonzero(near)
                    if not passed:
                        continue
                    if passed > near.size >> 4:  # then one product of all is cheaper
                        found = unit[rows] @ unit[cols].T
                        near &= found >= threshold - EDGE
                        i, j = np.nonzero(near)
                        found = found[i, j]
                        a, b = rows[i], cols[j]
                    else:
                        i, j = np.nonzero(near)
                        a, b = rows[i], cols[j]
                        steps = range(0, len(a), 1 << 13)
                        found = np.concatenate(
                            [np.einsum("ij,ij->i", unit[a[k : k + (1 << 13)]], unit[b[k : k + (1 << 13)]]) for k in steps]
                        )
                        close = found >= threshold - EDGE
                        a, b, found = a[close], b[close], found[close]
                    enough = linked(found, a, b, given, threshold)
                    a, b = a[enough], b[enough]
                    new = apart(unit, a, b, tables, *params)
                    a, b = a[new], b[new]
                    root = grouped(root, a, b)
                    np.add.at(count, a, copies[b])
                    np.add.at(count, b, copies[a])
            yield from link_rows(rep, root, count)

    return dealt.mapInArrow(compare, LINKS)


def near_duplicates(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    *,
    threshold: float = THRESHOLD,
    tables: int = TABLES,
    per_table: int = PROJECTIONS,
    width: float = WIDTH,
    seed: int = SEED,
    block: int = BLOCK,
) -> DataFrame:
    """One row per vector: key, n_links (other vectors linked directly), component_id, kept (is the least of its component).

    Two rows link if their labels are equal and not null, their vectors have the same length, and their cosine in
    double precision is at least `threshold`. Null, empty and zero vectors and those with null or non-finite components
    link with nothing. Equal vectors of a label are one candidate with a number of copies, so that a group of copies
    never forms pairs. A row with a null key keeps itself out of every group: no links, component null, not kept.
    Repeated rows of one key are one vector; a key with several vectors has the most links of any and the least component. Other columns are not carried, so none can clash.
    """
    rows = df.select(F.col(key).alias("id"), F.col(vector).alias("embedding"), F.col(label).alias("label"))
    rows = rows.withColumn("label", F.when(F.col("label").isNotNull(), F.xxhash64("label")))
    good = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    flawed = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    flawed = flawed | ~F.exists("embedding", lambda x: x != 0)
    sound = rows.filter(good).filter(~flawed)
    # -0.0 and 0.0 are the same component
    plain = F.transform("embedding", lambda x: F.when(x == 0, F.abs(x)).otherwise(x))
    sound = sound.select("id", "label", plain.alias("embedding")).dropDuplicates(["id", "label", "embedding"])
    hashed = sound.withColumn("same", F.sha2(F.concat_ws(",", F.transform("embedding", lambda x: x.cast("string"))), 256))
    groups = hashed.groupBy("label", "same").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("embedding").alias("embedding")
    )
    distinct = stage(groups, "vectors")
    links = stage(
        find_links(distinct.select("label", "rep", "copies", "embedding"), threshold, tables, per_table, width, seed, block),
        "vector-links",
    )
    found = components(links.select("a", "b"), "vector-components")
    outside = links.groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("others"))
    tied = distinct.select("label", "same", "rep", "copies").join(outside, "rep", "left")
    tied = tied.join(found.withColumnRenamed("id", "rep"), "rep", "left")
    per_row = hashed.select("id", "label", "same").join(tied, ["label", "same"])
    per_row = per_row.select(
        "id",
        (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component_id", "rep").alias("component_id"),
    )
    per_id = per_row.groupBy("id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    ids = rows.select("id").distinct()
    return ids.join(per_id, "id", "left").select(
        F.col("id").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").cast("long").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(False)).alias("kept"),
    )
