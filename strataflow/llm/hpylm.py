"""A hierarchical Pitman-Yor language model over words, trained and applied on Spark.

Every learned word, and the start of a text, is a context with a restaurant of its own: customers are the words that
follow it. All of them share one parent, the restaurant of words without context, to which each of their tables sends
a customer; below it all known words and one unknown are alike. The number of tables at which each dish is served is
sampled by Gibbs: given how many tables there are elsewhere, its conditional over 1, 2, ... tables is known in closed
form through generalised Stirling numbers. Words of many customers are seated in growing batches instead.
Probabilities are averaged over the samples after the first.

Dishes are dealt by the hash of the word, so that all restaurants' seats for one word, and the parent's, are in one
bucket. The tables of a context are spread over the buckets of its dishes: after each sweep these send their part to
the bucket of the context's own word, which answers with the sum. A pair seen once has one table whatever is drawn, so
only pairs seen more often take part in this. Texts are kept in chunks, numbered once; what a chunk needs to know of
the model is asked for and answered per distinct word and distinct pair of words.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.batches import pieces, runs, sliced
from strataflow.llm.words import word_hashes
from strataflow.session import stage

CHUNK_CHARS = 12_000_000
BUCKET_WORDS = 1 << 18
DISCOUNT = {"root": 0.65, "context": 0.75}
STRENGTH = {"root": 1.0, "context": 1.0}
SWEEPS = 3
# Dishes of up to so many customers have their tables drawn from the exact conditional.
EXACT = 32
# The end of a text as a word; as a context, the start of one.
END = np.uint64(0xE0D0E0D0E0D0E0D1)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value, first bytes first, which leaves runs where numbers are small or sorted."""
    parts = []
    for a in arrays:
        data = zlib.compress(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes(), 1)
        parts += [struct.pack("<2sQ", np.dtype(a.dtype).str[1:].encode(), len(data)), data]
    return b"".join(parts)


def unpack(data: bytes) -> list[np.ndarray]:
    arrays, at = [], 0
    while at < len(data):
        kind, n = struct.unpack_from("<2sQ", data, at)
        at += struct.calcsize("<2sQ")
        dtype = np.dtype(kind.decode())
        planes = np.frombuffer(zlib.decompress(data[at : at + n]), np.uint8).reshape(dtype.itemsize, -1)
        arrays.append(np.ascontiguousarray(planes.T).reshape(-1).view(dtype))
        at += n
    return arrays


def rising(a: np.ndarray) -> np.ndarray:
    """The steps between sorted numbers, to be packed; np.cumsum turns them back."""
    return np.diff(a, prepend=a.dtype.type(0))


def chunked(df: DataFrame, key: str, text: str, held_out: Column) -> DataFrame:
    """The texts as chunks of word numbers: (chunk, ids, held, lengths, words, tokens)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        hashes: list[np.ndarray] = []
        lengths: list[np.ndarray] = []
        ids, held, chars = [], [], 0

        def flush() -> pa.RecordBatch:
            n = np.concatenate(lengths)
            words, tokens = np.unique(np.concatenate(hashes), return_inverse=True)
            names = ["chunk", "ids", "held", "lengths", "words", "tokens"]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([(part << 24) + number]),
                    pa.array([ids], pa.list_(pa.int64())),
                    pa.array([held], pa.list_(pa.bool_())),
                    pa.array([pack(n.astype(np.uint32))]),
                    pa.array([pack(words)]),
                    pa.array([pack(tokens.astype(np.uint32))]),
                ],
                names=names,
            )

        for batch in sliced(batches):
            keys, outside, texts = (c.to_pylist() for c in batch.columns)
            for lo, hi in pieces(texts):
                words, bounds = word_hashes(texts[lo:hi])
                hashes.append(np.insert(words, bounds[1:], END))
                lengths.append(np.diff(bounds) + 1)
                ids += keys[lo:hi]
                held += outside[lo:hi]
                chars += sum(len(t or "") for t in texts[lo:hi])
                if chars >= CHUNK_CHARS:
                    yield flush()
                    number += 1
                    hashes, lengths, ids, held, chars = [], [], [], [], 0
        if ids:
            yield flush()

    source = df.select(F.col(key).cast("long"), F.coalesce(held_out, F.lit(True)), F.col(text))
    return source.mapInArrow(encode, "chunk long, ids array<long>, held array<boolean>, lengths binary, words binary, tokens binary")


class Chunk:
    """A chunk's tokens and the distinct (word, context) pairs among them, in the order in which they are asked for."""

    def __init__(self, lengths: bytes, words: bytes, tokens: bytes, held: list[bool], contexts: np.ndarray | None):
        self.lengths = unpack(lengths)[0].astype(np.int64)
        self.words = unpack(words)[0]
        self.tokens = unpack(tokens)[0].astype(np.int64)
        self.first = np.cumsum(self.lengths) - self.lengths
        self.learned = np.repeat(~np.array(held, bool), self.lengths)
        self.seen = np.bincount(self.tokens[self.learned], minlength=len(self.words)).astype(np.uint32)
        # Before a text's first word stands the end of the text before it, or what is the same, the start of its own.
        context = np.concatenate([[np.searchsorted(self.words, END)], self.tokens[:-1]])
        self.own = np.ones(len(context), bool) if contexts is None else np.isin(self.words, contexts)[context]
        self.context = context[self.own]
        self.width = len(self.words)
        self.pairs, self.pair_of = np.unique(self.tokens[self.own] * self.width + self.context, return_inverse=True)


def context_words(chunks: DataFrame, contexts: int) -> np.ndarray:
    """Hashes of the `contexts` most frequent words of all learned texts, and of the start of a text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                held, lengths, words, tokens = (batch.column(c)[row].as_py() for c in range(4))
                chunk = Chunk(lengths, words, tokens, held, None)
                there = chunk.seen > 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(chunk.words[there].view(np.int64)), pa.array(chunk.seen[there].astype(np.int64))], names=["word", "n"]
                )

    each = chunks.select("held", "lengths", "words", "tokens").mapInArrow(count, "word long, n long")
    best = each.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), "word").limit(contexts).collect()
    return np.append(np.array([r[0] for r in best], np.int64).view(np.uint64), END)


def bucket_edges(words: np.ndarray, bits: int) -> np.ndarray:
    """Where each bucket of the sorted words starts, and the end."""
    marks = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(1, np.uint64)
    return np.append(np.searchsorted(words, marks), len(words))


def asked(chunks: DataFrame, contexts: np.ndarray | None, bits: int) -> DataFrame:
    """(bucket, chunk, request): per bucket of words what a chunk counts there in learned texts, and asks about."""
    shared = chunks.sparkSession.sparkContext.broadcast(contexts)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                number, held, lengths, words, tokens = (batch.column(c)[row].as_py() for c in range(5))
                chunk = Chunk(lengths, words, tokens, held, shared.value)
                of_pair = np.bincount(chunk.pair_of, chunk.learned[chunk.own], len(chunk.pairs)).astype(np.uint32)
                edges = bucket_edges(chunk.words, bits)
                cuts = np.searchsorted(chunk.pairs, edges * chunk.width)
                for b in range(1 << bits):
                    lo, hi, start, end = edges[b], edges[b + 1], cuts[b], cuts[b + 1]
                    if lo == hi:
                        continue
                    own = chunk.pairs[start:end]
                    per_word = np.bincount(own // chunk.width - lo, minlength=hi - lo).astype(np.uint32)
                    used, context = np.unique(own % chunk.width, return_inverse=True)
                    blob = pack(
                        rising(chunk.words[lo:hi]), chunk.seen[lo:hi], per_word,
                        rising(chunk.words[used]), context.astype(np.uint32), of_pair[start:end],
                    )
                    arrays = [pa.array([b], pa.int32()), pa.array([number], pa.int64()), pa.array([blob], pa.binary())]
                    yield pa.RecordBatch.from_arrays(arrays, names=["bucket", "chunk", "request"])

    rows = chunks.select("chunk", "held", "lengths", "words", "tokens")
    return rows.mapInArrow(ask, "bucket int, chunk long, request binary")


def gathered(requests: DataFrame, bits: int) -> DataFrame:
    """A row per bucket: its `words` and their counts, the `contexts` of its pairs, what is drawn anew in a sweep, and
    per chunk what never changes, `fixed`, and the places of what does, `wanted`.

    Drawn anew are the tables of `live`, the pairs seen more than once, with contexts numbered as in `near`.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in runs(batches, ["bucket"]):
            parts = []
            for steps, seen, per_word, about, *rest in (unpack(r) for r in part.column("request").to_pylist()):
                parts.append((np.cumsum(steps), seen, per_word, np.cumsum(about), *rest))
            words = np.unique(np.concatenate([p[0][p[1] > 0] for p in parts]))
            contexts = np.unique(np.concatenate([p[3] for p in parts]))
            width = max(1, len(contexts))
            count = np.zeros(len(words), np.int64)
            keys, counts, asks = [], [], []
            for own, seen, per_word, about, context, of_pair in parts:
                at = np.full(len(own), -1)
                if len(words):
                    at = np.searchsorted(words, own)
                    at[at == len(words)] = 0
                    at[words[at] != own] = -1
                count += np.bincount(at[seen > 0], seen[seen > 0], len(words)).astype(np.int64)
                word_of = np.repeat(at, per_word)
                key = np.where(word_of >= 0, word_of * width + np.searchsorted(contexts, about)[context], -1)
                keys.append(key[of_pair > 0])  # a pair that was learned has a word that was
                counts.append(of_pair[of_pair > 0].astype(np.int64))
                asks.append((at, key))
            pairs, place = np.unique(np.concatenate(keys), return_inverse=True)
            together = np.bincount(place, np.concatenate(counts), len(pairs)).astype(np.int64)
            again = together > 1
            number_of = np.cumsum(again) - 1
            fixed, wanted = [], []
            for at, key in asks:
                of_pair, place = np.zeros(len(key), np.uint32), np.zeros(len(key), np.int64)
                if len(pairs):
                    place = np.searchsorted(pairs, key)
                    place[place == len(pairs)] = 0
                    met = pairs[place] == key
                    of_pair[met] = together[place[met]]
                fixed.append(pack(np.append(count, 0)[at].astype(np.uint32), of_pair))
                wanted.append(pack(at >= 0, rising(at[at >= 0]).astype(np.uint32), rising(number_of[place[of_pair > 1]]).astype(np.uint32)))
            near, number = np.unique(pairs[again] % width, return_inverse=True)
            live = pack(np.zeros(len(words), np.uint8), count, pairs[again] // width * max(1, len(near)) + number, together[again])
            used, n = np.unique(pairs % width, return_counts=True)
            at_root = count.sum() - together.sum() + len(pairs)
            values = {
                "bucket": part.column("bucket").combine_chunks()[:1],
                "words": pa.array([pack(rising(words), count)], pa.binary()),
                "contexts": pa.array([pack(rising(contexts[used]), n.astype(np.uint32), np.isin(used, near))], pa.binary()),
                "sums": pa.array([[count.sum(), len(words), at_root, len(words)]], pa.list_(pa.float64())),
                "live": pa.array([live], pa.binary()),
                "near": pa.array([pack(rising(contexts[near]))], pa.binary()),
                "chunks": pa.array([part.column("chunk").to_pylist()], pa.list_(pa.int64())),
                "fixed": pa.array([fixed], pa.list_(pa.binary())),
                "wanted": pa.array([wanted], pa.list_(pa.binary())),
            }
            yield pa.RecordBatch.from_arrays(list(values.values()), names=list(values))

    dealt = requests.repartition(1 << bits, "bucket").sortWithinPartitions("bucket", "chunk")
    ddl = (
        "bucket int, words binary, contexts binary, sums array<double>, live binary, near binary,"
        " chunks array<long>, fixed array<binary>, wanted array<binary>"
    )
    return dealt.mapInArrow(merge, ddl)


def stirling(discount: float, most: int) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers: [customers, tables]."""
    log = np.full((most + 1, most + 1), -np.inf)
    log[1, 1] = 0
    for c in range(1, most):
        t = np.arange(1, c + 2)
        with np.errstate(divide="ignore"):
            stay = log[c, t] + np.log(np.maximum(c - discount * t, 1e-300))
        log[c + 1, t] = np.logaddexp(log[c, t - 1], stay)
    return log


def seat(draw: np.random.Generator, customers: np.ndarray, new: np.ndarray, discount: float, log: np.ndarray) -> np.ndarray:
    """Draw the number of tables of dishes with these customers.

    `new` is the weight of opening one more table for the dish: (strength + discount * tables) times the parent's
    probability of it. Up to EXACT customers the draw is from the conditional; more are seated in batches that grow by an
    eighth, in each of which the chance of a new table is that of its first customer.
    """
    tables = np.ones(len(customers), np.int64)
    few = np.minimum(customers, EXACT)
    order = np.argsort(few, kind="stable")
    edges = np.searchsorted(few[order], np.arange(EXACT + 2))
    log_new = np.log(new)
    for c in range(2, EXACT + 1):
        for start in range(edges[c], edges[c + 1], 1 << 16):
            rows = order[start : min(edges[c + 1], start + (1 << 16))]
            t = np.arange(1, c + 1)
            weight = log[c, t] + t * log_new[rows, None]
            weight = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
            tables[rows] = 1 + (weight < draw.random(len(rows))[:, None] * weight[:, -1:]).sum(axis=1)
    rows, seated = order[edges[EXACT] :], EXACT
    rows = rows[customers[rows] > EXACT]
    while len(rows):
        batch = np.minimum(customers[rows] - seated, max(1, seated // 8))
        chance = new[rows] / (new[rows] + seated - discount * tables[rows])
        tables[rows] = np.minimum(tables[rows] + draw.binomial(batch, np.clip(chance, 0, 1)), seated + batch)
        seated += max(1, seated // 8)
        rows = rows[customers[rows] > seated]
    return tables


class Totals:
    """Sums over all buckets: customers and tables of a bucket's contexts, then words, customers and tables of the root."""

    def __init__(self, sums: np.ndarray, width: int):
        self.customers, self.tables = sums[:width], sums[width : 2 * width]
        self.tokens, self.words, self.root_customers, self.root_tables = sums[2 * width :]


def state_of(data: bytes, width: int) -> tuple[np.ndarray, ...]:
    words, count, pairs, together = unpack(data)
    return words, count, pairs // max(1, width), pairs % max(1, width), together


def sweeps(bucket: int, data: bytes, width: int, history: list[np.ndarray], seed: int) -> Iterator[tuple[np.ndarray, ...]]:
    """The seating of a bucket after each sweep that the totals so far allow: (tables, root customers, root tables).

    The draws depend on the seed, the bucket and the sweep alone, so that every task that repeats them, also after the
    loss of an executor, finds the same seating.
    """
    words, count, of, context, together = state_of(data, width)
    logs = {name: stirling(DISCOUNT[name], EXACT) for name in DISCOUNT}
    direct = count - np.bincount(of, together, len(words)).astype(np.int64)  # customers that come to the root themselves
    tables = np.ones(len(of), np.int64)
    at_root = direct + np.bincount(of, tables, len(words)).astype(np.int64)
    root = np.ones(len(words), np.int64)
    for number, sums in enumerate(history):
        totals, draw = Totals(sums, width), np.random.default_rng([seed, bucket, number])
        p = root_probability(at_root, root, totals)
        new = (STRENGTH["context"] + DISCOUNT["context"] * totals.tables[context]) * p[of]
        tables = seat(draw, together, new, DISCOUNT["context"], logs["context"])
        at_root = direct + np.bincount(of, tables, len(words)).astype(np.int64)
        opens = (STRENGTH["root"] + DISCOUNT["root"] * totals.root_tables) / (totals.words + 1)
        root = seat(draw, at_root, np.full(len(words), opens), DISCOUNT["root"], logs["root"])
        yield tables, at_root, root


def root_probability(customers: np.ndarray, tables: np.ndarray, totals: Totals) -> np.ndarray:
    """Predictive probability of words in the root restaurant (no customers and tables: a word that was not learned)."""
    unseen = (STRENGTH["root"] + DISCOUNT["root"] * totals.root_tables) / (totals.words + 1)
    return (customers - DISCOUNT["root"] * tables + unseen) / (STRENGTH["root"] + totals.root_customers)


MESSAGE = "to int, sender int, message binary, sums array<double>"


def sent(bucket: int, contexts: np.ndarray, values: np.ndarray, asks: np.ndarray, sums: list[float], bits: int) -> Iterator[pa.RecordBatch]:
    """What a bucket adds to contexts (sorted), to the buckets of their words; `asks` marks those whose sum it needs."""
    edges = bucket_edges(contexts, bits)
    for to in range(1 << bits):
        lo, hi = edges[to], edges[to + 1]
        if lo < hi or to == bucket:
            blob = pack(rising(contexts[lo:hi]), values[lo:hi].astype(np.uint32), asks[lo:hi])
            arrays = [
                pa.array([to], pa.int32()),
                pa.array([bucket], pa.int32()),
                pa.array([blob], pa.binary()),
                pa.array([sums if to == bucket else [0.0] * 4], pa.list_(pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["to", "sender", "message", "sums"])


def exchanged(messages: DataFrame, bits: int, step: int) -> tuple[DataFrame, np.ndarray]:
    """(bucket, step, place, told): every sender's sums by the bucket that made them, as `place`, and with place -1 the
    contexts of a bucket's own words and their sums; and the four sums over all."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in runs(batches, ["to"]):
            to = part.column("to")[0].as_py()
            parts = [(np.cumsum(m[0]), *m[1:]) for m in (unpack(m) for m in part.column("message").to_pylist())]
            contexts, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            total = np.bincount(place, np.concatenate([p[1] for p in parts]), len(contexts)).astype(np.int64)
            cuts = np.cumsum([0, *[len(p[0]) for p in parts]])
            told = [pack(total[place[cuts[i] : cuts[i + 1]]][p[2]]) for i, p in enumerate(parts)]
            n = len(parts)
            sums = np.sum(part.column("sums").to_pylist(), axis=0).tolist()
            arrays = [
                pa.array([to, *part.column("sender").to_pylist()], pa.int32()),
                pa.array([step] * (n + 1), pa.int32()),
                pa.array([-1] + [to] * n, pa.int32()),
                pa.array([pack(rising(contexts), total), *told], pa.binary()),
                pa.array([sums] + [[0.0] * 4] * n, pa.list_(pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["bucket", "step", "place", "told", "sums"])

    dealt = messages.repartition(1 << bits, "to").sortWithinPartitions("to", "sender")
    told = stage(dealt.mapInArrow(add, "bucket int, step int, place int, told binary, sums array<double>"), "lm-told")
    sums = told.agg(*[F.sum(F.col("sums")[i]) for i in range(4)]).first()
    return told.drop("sums"), np.array([x or 0.0 for x in sums])


def started(buckets: DataFrame, bits: int) -> DataFrame:
    """The messages before the first sweep, when every pair has one table."""

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, blob, sums in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                steps, n, asks = unpack(blob)
                yield from sent(bucket, np.cumsum(steps), n, asks, sums, bits)

    return buckets.select("bucket", "contexts", "sums").mapInArrow(start, MESSAGE)


def with_told(buckets: DataFrame, told: list[DataFrame], bits: int) -> DataFrame:
    """The rows of buckets, each followed by what its bucket was told, by step and place."""
    rows = buckets.withColumns({"step": F.lit(-1), "place": F.lit(-1), "told": F.lit(None).cast("binary")})
    for step in told:
        rows = rows.unionByName(step, allowMissingColumns=True)
    return rows.repartition(1 << bits, "bucket").sortWithinPartitions("bucket", "step", "place")


def tables_told(part: pa.Table, n_steps: int) -> list[np.ndarray]:
    """Tables of the bucket's live contexts after each step; later steps tell how many are added to the first one's."""
    steps, places, told = (part.column(c).to_pylist()[1:] for c in ("step", "place", "told"))
    found: list[list[np.ndarray]] = [[np.zeros(0)] for _ in range(n_steps)]
    for step, place, data in zip(steps, places, told, strict=True):
        if place >= 0:
            found[step].append(unpack(data)[0])
    each = [np.concatenate(f) for f in found]
    return [each[0], *[each[0] + extra for extra in each[1:]]]


def swept(buckets: DataFrame, told: list[DataFrame], sums: list[np.ndarray], seed: int, bits: int) -> DataFrame:
    """The messages after one more sweep: tables beyond the first of each pair."""

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in runs(batches, ["bucket"]):
            bucket, live, near = (part.column(c)[0].as_py() for c in ("bucket", "live", "near"))
            contexts = np.cumsum(unpack(near)[0])
            width = len(contexts)
            history = [np.concatenate([np.zeros(width), t, s]) for t, s in zip(tables_told(part, len(sums)), sums, strict=True)]
            for tables, at_root, root in sweeps(bucket, live, width, history, seed):  # noqa: B007
                pass
            words, count, _, context, _ = state_of(live, width)
            more = np.bincount(context, tables - 1, width)
            totals = [float(x) for x in (count.sum(), len(words), at_root.sum(), root.sum())]
            yield from sent(bucket, contexts, more, np.ones(width, bool), totals, bits)

    near_only = [t.filter("place >= 0") for t in told]
    return with_told(buckets.select("bucket", "live", "near"), near_only, bits).mapInArrow(sweep, MESSAGE)


def answers(buckets: DataFrame, told: list[DataFrame], sums: list[np.ndarray], seed: int, bits: int) -> DataFrame:
    """(chunk, bucket, answer): for each sample (that after every sweep but the first) the root probabilities of the words
    asked about and their tables as contexts, and the tables of the pairs seen more than once."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in runs(batches, ["bucket"]):
            bucket, blob, live, chunks, wanted = (part.column(c)[0].as_py() for c in ("bucket", "words", "live", "chunks", "wanted"))
            words = np.cumsum(unpack(blob)[0])
            after = tables_told(part, len(sums))
            width = len(after[0])
            history = [np.concatenate([np.zeros(width), t, s]) for t, s in zip(after, sums, strict=True)]
            own = [np.zeros(len(words), np.int64) for _ in sums]
            for step, place, data in zip(*(part.column(c).to_pylist()[1:] for c in ("step", "place", "told")), strict=True):
                if place < 0:
                    steps, n = unpack(data)
                    own[step][np.searchsorted(words, np.cumsum(steps))] = n
            seatings = list(zip(sweeps(bucket, live, width, history[:-1], seed), history[1:], own[1:], strict=True))
            samples = []
            for (tables, at_root, root), row, extra in seatings[1:] or seatings:
                totals = Totals(row, width)
                # The last is for words that were not learned.
                p = np.append(root_probability(at_root, root, totals), root_probability(np.zeros(1), np.zeros(1), totals))
                samples.append((p.astype(np.float32), np.append(own[0] + extra, 0).astype(np.uint32), tables.astype(np.uint32)))
            for number, request in zip(chunks, wanted, strict=True):
                known, steps, pair_steps = unpack(request)
                at = np.full(len(known), -1)
                at[known] = np.cumsum(steps.astype(np.int64))
                place = np.cumsum(pair_steps.astype(np.int64))
                reply = pack(*[a for p, t, e in samples for a in (p[at], t[at], e[place])])
                arrays = [pa.array([number], pa.int64()), pa.array([bucket], pa.int32()), pa.array([reply], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["chunk", "bucket", "answer"])

    rows = with_told(buckets.select("bucket", "words", "live", "chunks", "wanted"), told, bits)
    return rows.mapInArrow(answer, "chunk long, bucket int, answer binary")


SCORES = pa.schema(
    [
        ("id", pa.int64()),
        ("held_out", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("train_tokens", pa.int64()),
        ("base_score", pa.float64()),
        ("score", pa.float64()),
        ("perplexity", pa.float64()),
    ]
)


def score(
    df: DataFrame,
    held_out: Column,
    key: str = "doc_id",
    text: str = "text",
    *,
    contexts: int | None = None,
    gibbs: int = SWEEPS,
    seed: int = 11,
) -> DataFrame:
    """Learn the model from the rows that are not held out, and score all of them.

    Returns per row: key, held_out, n_tokens (words and the end), n_known (of them, seen in learned texts), train_tokens,
    base_score (log10 under add-one unigrams), score (log10 of the text under the model) and perplexity per token. Null and
    empty texts are an end alone. Where `held_out` is null, as for a row without a key, nothing is learned. Repeated
    rows are learned and scored each. If nothing is learned all words are alike. An empty table gives an empty one.
    With `contexts`, only so many of the most frequent words, and the start of a text, have a restaurant.
    """
    chunks = stage(chunked(df, key, text, held_out), "lm-chunks")
    known = None if contexts is None else context_words(chunks, contexts)
    asks = chunks.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("words")), F.lit(0))).first()
    # Buckets that hold about BUCKET_WORDS of the words asked about, which take some seven bytes each.
    bits = max(6, int(asks[1] // (7 * BUCKET_WORDS)).bit_length())
    buckets = stage(gathered(asked(chunks, known, bits), bits), "lm-buckets")
    told, sums = ([x] for x in exchanged(started(buckets, bits), bits, 0))
    for step in range(1, gibbs + 1):
        more, totals = exchanged(swept(buckets, told, sums, seed, bits), bits, step)
        told.append(more)
        sums.append(totals)
    tokens, words = int(sums[0][0]), int(sums[0][1])
    replied = answers(buckets, told, sums, seed, bits)
    shared = df.sparkSession.sparkContext.broadcast(known)

    answered = buckets.select("bucket", F.explode(F.arrays_zip("chunks", "fixed")).alias("f"))
    fixed = answered.select(F.col("f.chunks").alias("chunk"), "bucket", F.lit(0).alias("drawn"), F.col("f.fixed").alias("answer"))
    own = chunks.withColumns({"bucket": F.lit(-1), "drawn": F.lit(0)})
    both = own.unionByName(fixed, allowMissingColumns=True).unionByName(replied.withColumn("drawn", F.lit(1)), allowMissingColumns=True)
    both = both.repartition(max(1, asks[0]), "chunk").sortWithinPartitions("chunk", "drawn", "bucket")

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in runs(batches, ["chunk"]):
            ids, held, lengths, data, numbers = (part.column(c)[0].as_py() for c in ("ids", "held", "lengths", "words", "tokens"))
            chunk = Chunk(lengths, data, numbers, held, shared.value)
            replies = [unpack(a) for a in part.column("answer").to_pylist()[1:]]
            half = len(replies) // 2  # from every bucket what is fixed, then what is drawn
            seen, of_pair = (np.concatenate(x).astype(np.float64) for x in zip(*replies[:half], strict=True))
            samples = [np.concatenate(x).astype(np.float64) for x in zip(*replies[half:], strict=True)]
            each = np.zeros(len(chunk.tokens))
            customers = STRENGTH["context"] + seen[chunk.context]  # every learned word is followed by one, or by the end
            for p, of_context, tables in zip(samples[::3], samples[1::3], samples[2::3], strict=True):
                sample = p[chunk.tokens]
                lone = STRENGTH["context"] + DISCOUNT["context"] * of_context[chunk.context]
                at_tables = np.minimum(of_pair, 1)
                at_tables[of_pair > 1] = tables
                seats = (of_pair - DISCOUNT["context"] * at_tables)[chunk.pair_of]
                sample[chunk.own] = (seats + lone * sample[chunk.own]) / customers
                each += sample
            each = np.log10(each / (len(samples) // 3))
            base = np.log10((seen + 1) / (tokens + words + 1))[chunk.tokens]
            sums = [np.add.reduceat(x, chunk.first) for x in ((seen > 0)[chunk.tokens].astype(np.int64), base, each)]
            per_token = 10 ** np.minimum(-sums[2] / chunk.lengths, 300)
            arrays = [ids, held, chunk.lengths, sums[0], np.full(len(ids), tokens), sums[1], sums[2], per_token]
            yield pa.RecordBatch.from_arrays([pa.array(a, f.type) for a, f in zip(arrays, SCORES, strict=True)], schema=SCORES)

    ddl = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
    scored = both.mapInArrow(add_up, ddl)
    return scored.withColumnRenamed("id", key)
