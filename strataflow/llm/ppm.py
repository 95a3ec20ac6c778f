"""Language identification by partial matching: per-language byte context trees with frozen statistics.

Every language gets a tree of the byte contexts (up to ORDER bytes) that occur often enough in its sample. A symbol
seen after a context has the probability count / (total + distinct); the escape mass distinct / (total + distinct)
goes to the symbols not seen there, in proportion to the next shorter context's prediction of them (so symbols of
the longer context are excluded); below the empty context all bytes are alike. The code length of a text under a
language is the exact sum of -log2 of these probabilities, each at the longest context that the tree holds.

The predictions of every tree are laid out once in a table of its own: a row per context of this tree, a column per
byte class of its language. Scoring a byte is then, for each language, a walk back over at most ORDER bytes and one
lookup. The tables grow with the number of languages, not with its square.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from strataflow.llm.batches import lean, pieces, sliced, tidy
from strataflow.session import stage

UNDETERMINED = "und"
ORDER = 4
# The bounded sample a language's tree is fitted on: whole documents, lowest hash first, while they start below
# SAMPLE_CHARS and are at most SAMPLE_DOCS.
SAMPLE_DOCS, SAMPLE_CHARS = 400, 300_000
SHARES = 64
# A context needs so many occurrences in the sample to get a node.
LEAST_SEEN = 24
# Bound of the code lengths of one language in the broadcast model.
LANGUAGE_BYTES = 16 << 20


@dataclass
class Tree:
    """Counts of one language: rows (context length, context bytes as a number, symbol, count)."""

    language: str
    length: np.ndarray
    context: np.ndarray
    symbol: np.ndarray
    count: np.ndarray


# ASCII bytes that are no letters tell nothing about a language; noise made of them must not outweigh the words.
LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def fold(text: str) -> bytes:
    """Lower case, with every run of ASCII bytes other than letters as one space."""
    return b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(LETTERS).split())


def grow(language: str, texts: Sequence[str], order: int = ORDER, least: int = LEAST_SEEN) -> Tree:
    """Count the symbols after every context of up to `order` bytes; contexts do not reach over a text's start."""
    found = []
    for text in texts:
        data = np.frombuffer(fold(text), np.uint8).astype(np.int64)
        context = np.zeros(len(data), np.int64)
        found.append((0, context, data))
        for k in range(1, order + 1):
            if len(data) <= k:
                break
            # the most recent byte is the lowest digit, so the parent context is the number modulo 256^(k-1)
            context = np.zeros(len(data) - k, np.int64)
            for back in range(1, k + 1):
                context |= data[k - back : len(data) - back] << (8 * (back - 1))
            found.append((k, context, data[k:]))
    parts = []
    for k in range(order + 1):
        own = [(c << 8) | s for n, c, s in found if n == k]
        keys, counts = np.unique(np.concatenate(own) if own else np.zeros(0, np.int64), return_counts=True)
        contexts, place = np.unique(keys >> 8, return_inverse=True)
        kept = np.bincount(place, counts, len(contexts))[place] >= least if k else np.ones(len(keys), bool)
        parts.append((np.full(kept.sum(), k), keys[kept] >> 8, keys[kept] & 255, counts[kept]))
    return Tree(language, *(np.concatenate(x).astype(np.int64) for x in zip(*parts, strict=True)))


@dataclass
class Model:
    """The trees of all languages, each a part of the flat `walk` and `bits`, (node, class) each.

    `walk` leads from a context to the one a byte longer, or to DEAD, which is node 0; node 1 is the empty context.
    """

    languages: list[str]
    classes: np.ndarray  # (language, byte) -> class; bytes that its sample does not hold share class 0
    widths: list[int]  # classes of each language; the last is a text's start, over which no context reaches
    starts: list[int]  # of each language's part, and the end
    walk: np.ndarray  # node
    bits: np.ndarray  # code length
    order: int


def probabilities(tree: Tree, limit: int) -> tuple[dict[tuple[int, int], int], np.ndarray]:
    """The contexts kept, as (length, context) -> row, and each row's 256 probabilities.

    At most `limit` contexts are kept, the most frequent first and shorter ones before longer ones, so that the
    suffixes of a kept context are kept.
    """
    key = tree.length << 40 | tree.context
    nodes, place = np.unique(key, return_inverse=True)
    seen = np.bincount(place, tree.count, len(nodes))
    first = np.lexsort((nodes, -seen))  # a suffix is seen as often at least and sorts first
    kept = np.sort(first[: max(1, limit)])
    row_of = np.full(len(nodes), -1)
    row_of[kept] = np.arange(len(kept))
    p = np.empty((len(kept), 256))
    rows = {(int(nodes[i]) >> 40, int(nodes[i]) & ((1 << 40) - 1)): int(row_of[i]) for i in kept}
    members = np.argsort(place, kind="stable")
    starts = np.searchsorted(place[members], np.arange(len(nodes) + 1))
    uniform = np.full(256, 1 / 256)
    for (k, context), row in rows.items():  # sorted by length: a parent comes before its children
        own = members[starts[kept[row]] : starts[kept[row] + 1]]
        symbols, counts = tree.symbol[own], tree.count[own]
        parent = p[rows[(k - 1, context & ((1 << (8 * (k - 1))) - 1))]] if k else uniform
        total, distinct = counts.sum(), len(symbols)
        unseen = np.ones(256, bool)
        unseen[symbols] = False
        left = parent[unseen].sum()
        p[row] = parent * (distinct / (total + distinct) / left if left > 0 else 0)
        p[row, symbols] = counts / (total + distinct if left > 0 else total)
    return rows, p


def build(trees: Sequence[Tree], order: int = ORDER, model_bytes: int | None = None) -> Model:
    """Lay out the trees; each may take LANGUAGE_BYTES, or an equal part of `model_bytes` where that is given."""
    trees = sorted(trees, key=lambda t: t.language)
    each = LANGUAGE_BYTES if model_bytes is None else model_bytes // max(1, len(trees))
    classes, widths, starts, walks, costs = np.zeros((len(trees), 256), np.int32), [], [0], [], []
    for place, tree in enumerate(trees):
        seen = np.unique(tree.symbol)
        classes[place, seen] = np.arange(1, len(seen) + 1)
        width = len(seen) + 2
        stands_for = np.zeros(width, np.int64)  # a byte of each class
        stands_for[1 : len(seen) + 1] = seen
        unseen = np.setdiff1d(np.arange(256), seen)
        stands_for[0] = unseen[0] if len(unseen) else 0
        rows, p = probabilities(tree, each // (4 * width) - 1)
        walk = np.zeros((len(rows) + 1, width), np.int32)
        for (k, context), row in rows.items():
            if k:
                oldest = context >> (8 * (k - 1))
                walk[rows[(k - 1, context & ((1 << (8 * (k - 1))) - 1))] + 1, classes[place, oldest]] = row + 1
        cost = np.zeros(walk.shape, np.float32)
        cost[1:, :-1] = -np.log2(p[:, stands_for[:-1]])
        widths.append(width)
        starts.append(starts[-1] + walk.size)
        walks.append(walk.ravel())
        costs.append(cost.ravel())
    flat = [np.concatenate([*x, np.zeros(0, t)]) for x, t in ((walks, np.int32), (costs, np.float32))]
    return Model([t.language for t in trees], classes, widths, starts, *flat, order)


def code_lengths(model: Model, texts: Sequence[str]) -> np.ndarray:
    """Bits of every text (rows) under every language (columns)."""
    total = np.zeros((len(texts), len(model.languages)))
    encoded = [fold(t) for t in texts]
    lengths = np.array([len(e) for e in encoded], np.int64)
    data = np.frombuffer(b"\0" + b"\0".join(encoded), np.uint8)
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    for place, width in enumerate(model.widths):
        boundary = width - 1
        walk, bits = (x[model.starts[place] : model.starts[place + 1]] for x in (model.walk, model.bits))
        symbol = model.classes[place][data]
        symbol[starts] = boundary
        for lo in range(0, len(data), 1 << 20):  # a very long text is scored in runs; its contexts reach back over them
            hi = min(len(data), lo + (1 << 20))
            at = np.ones(hi - lo, np.int32)  # the empty context
            path = at.copy()
            for back in range(1, model.order + 1):
                previous = np.full(hi - lo, boundary, np.int32)
                previous[max(0, back - lo) :] = symbol[max(0, lo - back) : max(0, hi - back)]
                path = walk[path * width + previous]
                at = np.where(path > 0, path, at)
            cost = bits[at * width + symbol[lo:hi]].astype(np.float64)  # nothing for a text's start
            inside = starts[(starts > lo) & (starts < hi)] - lo
            first = np.searchsorted(starts, lo, side="right") - 1
            sums = np.add.reduceat(cost, np.concatenate([[0], inside]))
            total[first : first + len(sums), place] += sums
    return total


def fit(
    df: DataFrame,
    text: str = "text",
    label: str = "lang",
    key: str = "doc_id",
    docs: int = SAMPLE_DOCS,
    chars: int = SAMPLE_CHARS,
) -> Model:
    """Fit one tree per label value on the bounded sample; rows with a null label, text or key are not learned from.

    The sample is chosen on ids and lengths alone and holds `docs` rows per label at most; only then are its texts
    read, each label's in one task, and only the counted trees reach the driver.
    """
    rows = df.select(F.col(label).alias("lang"), F.col(key).alias("key"), F.col(text).alias("text"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("key").isNotNull() & F.col("text").isNotNull())
    by_hash = Window.partitionBy("lang").orderBy(F.col("mixed"), F.col("key"))
    lengths = rows.select("lang", "key", F.length("text").alias("n"), F.xxhash64("key").alias("mixed"))
    # First within shares of a label, so that a label with very many rows is no single task.
    share = F.pmod(F.xxhash64("key", F.lit("share")), F.lit(SHARES))
    within = Window.partitionBy("lang", "share").orderBy("mixed", "key")
    fewer = lengths.withColumn("share", share).withColumn("rank", F.row_number().over(within)).filter(F.col("rank") <= docs)
    few = fewer.withColumn("rank", F.row_number().over(by_hash)).filter(F.col("rank") <= docs)
    before = F.sum("n").over(by_hash.rowsBetween(Window.unboundedPreceding, -1))
    chosen = few.withColumn("before", F.coalesce(before, F.lit(0))).filter(F.col("before") < chars)
    # Written, so that Spark knows how small it is and need not shuffle the texts.
    chosen = stage(chosen.select("lang", "key").distinct(), "language-sample")
    sample = rows.join(chosen, ["lang", "key"], "left_semi")

    def counted(language: str, texts: list[str]) -> pa.RecordBatch:
        tree = grow(language, sorted(texts))
        arrays = [pa.array([a.tobytes()]) for a in (tree.length, tree.context, tree.symbol, tree.count)]
        return pa.RecordBatch.from_arrays([pa.array([language]), *arrays], names=["lang", "length", "context", "symbol", "count"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        language, texts = None, []
        for batch in batches:
            for lang, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if lang != language and texts:
                    yield counted(language, texts)
                    texts = []
                language = lang
                texts.append(body)
        if texts:
            yield counted(language, texts)

    schema = "lang string, length binary, context binary, symbol binary, count binary"
    # As text: a label of another type is compared and returned by its text.
    dealt = sample.select(F.col("lang").cast("string").alias("lang"), F.col("text")).repartition("lang")
    grown = dealt.sortWithinPartitions("lang").mapInArrow(tidy(train), schema).collect()
    return build([Tree(r[0], *(np.frombuffer(b, np.int64) for b in r[1:])) for r in grown])


def predict(
    df: DataFrame,
    model: Model,
    text: str = "text",
    keep: Sequence[str | Column] | None = None,
    names: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """Add the language with the shortest code for each whole text, and its posterior probability as score (0 to 1).

    There is no shuffle. A text that is null or has no letter is `und` with score 0, and so is every text if nothing
    was learned. Equal code lengths go to the alphabetically first language. Case and ASCII signs are folded. Input columns that
    clash with the added names, in any case, are replaced; an empty table gives an empty one.
    """
    clash = {n.lower() for n in names}
    kept = df.select(*(keep if keep is not None else [F.col(f"`{c}`") for c in df.columns]))
    kept_names = [c for c in kept.columns if c.lower() not in clash]
    letters = F.col(text).isNotNull() & F.col(text).rlike(r"\p{L}")
    carried = [c for c in (keep if keep is not None else [F.col(f"`{n}`") for n in kept_names])]
    source = df.select(*carried, F.when(letters, F.col(text)).alias("__text"))
    added = [StructField(names[0], StringType(), False), StructField(names[1], DoubleType(), False)]
    schema = StructType([kept.schema[c] for c in kept_names] + added)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in sliced(batches):
            texts = batch.column(len(kept_names)).to_pylist()
            language, score = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            known = [i for i, t in enumerate(texts) if t] if own.languages else []
            lettered = [texts[i] for i in known]
            for lo, hi in pieces(lettered):
                length = code_lengths(own, lettered[lo:hi])
                best = length.argmin(axis=1)
                more = length - length.min(axis=1, keepdims=True)
                posterior = 1 / np.exp2(-np.minimum(more, 1000)).sum(axis=1)
                for i, b, p in zip(known[lo:hi], best.tolist(), posterior.tolist(), strict=True):
                    language[i], score[i] = own.languages[b], min(1.0, p)
            arrays = [batch.column(i) for i in range(len(kept_names))]
            arrays += [pa.array(language, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept_names, *names])

    return lean(source).mapInArrow(tidy(run), schema)
