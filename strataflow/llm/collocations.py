"""Phrases that occur more often than their parts would by chance, found by Misra-Gries summaries.

An n-gram has a 64-bit hash. One half names its hash partition, the other its counter there; n-grams that share both are
counted as one, which can only keep more. Tasks count what they read and send their counts to the partitions; each
partition merges them into one Misra-Gries summary with more counters than its mass divided by the threshold, so that
whatever is frequent keeps a counter. First come words, then pairs of words that are both left, then longer n-grams whose
pairs are all left. What survives is kept as a bitmap of fixed size, which may let others pass but stops nothing
frequent. The last pass counts all n-grams that pass it by their words, exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.batches import pieces, sliced
from strataflow.llm.words import mix
from strataflow.session import stage

LONGEST, THRESHOLD, TOP = 5, 100, 2000
UNKNOWN = "und"
# Bits of each of the three bitmaps of survivors, whatever the corpus.
BITS = 1 << 25
# Counts that a task gathers before it sends them, rows that a partition gathers before it merges them.
GATHERED = 1 << 20
# Bytes of phrases in a batch of the last pass.
PHRASE_BYTES = 1 << 24

_DRAW = np.random.default_rng(12)
_BYTE = _DRAW.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = _DRAW.integers(1, 1 << 63, LONGEST, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0xD6E8FEB86659FD93)
# What a byte is: part of a word, between words, or the end of a piece.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2


class Words:
    """The words of some texts in order: where they lie in `data`, their piece, and their hash within their language.

    In `data` the words of a piece are one space apart, so a phrase is a slice.
    """

    def __init__(self, texts: list[bytes | None], langs: list[str], seeds: dict[str, int]):
        encoded = [(t or b"").lower() for t in texts]  # of bytes: A-Z only
        raw = np.frombuffer(b"\n" + b"\n".join(encoded) + b"\n", np.uint8)
        begins = np.cumsum([1, *[len(e) + 1 for e in encoded]])
        kind = _KIND[raw]
        gap = kind == 1
        stays = ~gap
        stays[1:] |= ~gap[:-1]
        begins = np.concatenate([[0], np.cumsum(stays)])[begins]
        kind = kind[stays]
        self.data = np.where(kind == 1, np.uint8(0x20), raw[stays])
        inside = kind == 0
        self.starts = np.flatnonzero(~inside[:-1] & inside[1:]) + 1
        self.ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
        self.bounds = np.searchsorted(self.starts, begins)
        n = len(self.starts)
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.bounds))
        self.piece = np.cumsum(kind == 2)[self.starts] if n else np.zeros(0, np.int64)
        for lang in langs:
            if lang not in seeds:
                seeds[lang] = int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "big")
        self.hash = np.zeros(0, np.uint64)
        if n:
            lengths = self.ends - self.starts
            first = np.cumsum(lengths) - lengths
            letters = self.data[inside]
            power = np.full(int(lengths.max()), _BASE)
            power[0] = 1
            power = np.cumprod(power, dtype=np.uint64)
            place = np.arange(len(letters)) - np.repeat(first, lengths)
            word = np.add.reduceat(_BYTE[letters] * power[place], first) + lengths.astype(np.uint64)
            seed = np.array([seeds[lang] for lang in langs], np.uint64)
            self.hash = mix(word ^ seed[self.text])

    def grams(self, size: int) -> np.ndarray:
        """Hash of the `size` words from each word on, for all places where so many follow."""
        n = max(len(self.hash) - size + 1, 0)
        if size == 1 or not n:
            return self.hash[:n]
        out = np.full(n, np.uint64(size))
        for i in range(size):
            out += self.hash[i : n + i] * _STEP[i]
        return mix(out)

    def whole(self, size: int) -> np.ndarray:
        """For the same places, whether these words are of one piece."""
        n = max(len(self.hash) - size + 1, 0)
        return self.piece[size - 1 :] == self.piece[:n] if n else np.zeros(0, bool)

    def phrases(self, places: np.ndarray, size: int) -> Iterator[tuple[slice, pa.Array]]:
        """The phrases of `size` words at these places, in batches of bounded bytes."""
        starts = self.starts[places]
        lengths = self.ends[places + size - 1] - starts
        total = np.cumsum(lengths)
        lo = 0
        while lo < len(places):
            hi = max(lo + 1, int(np.searchsorted(total, total[lo] - lengths[lo] + PHRASE_BYTES, side="right")))
            own = lengths[lo:hi]
            offsets = np.concatenate([[0], np.cumsum(own)])
            body = self.data[np.repeat(starts[lo:hi] - offsets[:-1], own) + np.arange(offsets[-1])]
            buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(body)]
            yield slice(lo, hi), pa.Array.from_buffers(pa.string(), hi - lo, buffers)
            lo = hi


def passes(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the slots of these hashes, given by their low bits, are set."""
    slot = hashes & np.uint64(len(bitmap) * 64 - 1)
    return (bitmap[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def candidates(words: Words, bitmaps: list[np.ndarray], longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, hashes, places where they may be frequent) of the n-grams that the next pass is to look at.

    Without a bitmap words, with that of words pairs, with that of pairs all longer ones; with all three, all sizes.
    """
    known = len(bitmaps)
    if known == 0:
        yield 1, words.hash, np.ones(len(words.hash), bool)
        return
    single = passes(bitmaps[0], words.hash)
    if known == 3:
        yield 1, words.hash, single
    pair = words.grams(2)
    good = words.whole(2) & single[:-1] & single[1:] if len(pair) else np.zeros(0, bool)
    if known == 1:
        yield 2, pair, good
        return
    good &= passes(bitmaps[1], pair)
    if known == 3:
        yield 2, pair, good
    run = good
    for size in range(3, longest + 1):
        n = max(len(words.hash) - size + 1, 0)
        run = run[:n] & good[size - 2 : size - 2 + n]
        hashes = words.grams(size)
        yield size, hashes, run & passes(bitmaps[2], hashes) if known == 3 else run


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


class Summary:
    """A Misra-Gries summary that others can be merged into.

    It takes less than mass / capacity off any count, so with more counters than mass / threshold a key of the
    threshold or more keeps one. `taken` is the most that any count has lost.
    """

    def __init__(self, capacity: int, gathered: int = GATHERED):
        self.capacity, self.gathered, self.taken, self.held = capacity, max(gathered, capacity), 0, 0
        self.keys: list[np.ndarray] = [np.zeros(0, np.int32)]
        self.counts: list[np.ndarray] = [np.zeros(0, np.int64)]

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts)
        self.held += len(keys)
        if self.held > self.gathered:
            self.merge()

    def merge(self) -> None:
        keys, counts = summed(np.concatenate(self.keys), np.concatenate(self.counts))
        if len(keys) > self.capacity:
            off = int(np.partition(counts, len(counts) - self.capacity - 1)[len(counts) - self.capacity - 1])
            self.taken += off
            keys, counts = keys[counts > off], counts[counts > off] - off
        self.keys, self.counts, self.held = [keys], [counts], 0

    def frequent(self, threshold: int) -> np.ndarray:
        """Keys that may have the threshold: all that have it, and few others."""
        self.merge()
        return self.keys[0][self.counts[0] + self.taken >= threshold]


def survivors(texts: DataFrame, bitmaps: list[np.ndarray], longest: int, threshold: int, partitions: int) -> DataFrame:
    """(key): low halves of the hashes of the n-grams of the next sizes that may reach the threshold."""
    sent = texts.sparkSession.sparkContext.broadcast(bitmaps)

    def batch(part: np.ndarray, keys: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
        arrays = [pa.array(part, pa.int32()), keys, pa.array(counts, pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, names=["part", "key", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds: dict[str, int] = {}
        mass = np.zeros(partitions, np.int64)
        keys, counts, held = [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            found, totals = summed(np.concatenate(keys), np.concatenate(counts))
            part = ((found >> np.uint64(32)) % np.uint64(partitions)).astype(np.int64)
            mass[:] += np.bincount(part, totals, partitions).astype(np.int64)
            low = found.astype(np.uint32).view(np.int32)
            for lo in range(0, len(found), 1 << 16):
                cut = slice(lo, lo + (1 << 16))
                yield batch(part[cut], pa.array(low[cut]), totals[cut])

        for b in sliced(batches):
            bodies, langs = b.column(0).to_pylist(), b.column(1).to_pylist()
            for lo, hi in pieces(bodies):
                words = Words(bodies[lo:hi], langs[lo:hi], seeds)
                for _, hashes, good in candidates(words, sent.value, longest):
                    found, n = np.unique(hashes[good], return_counts=True)
                    keys.append(found)
                    counts.append(n)
                    held += len(found)
                if held > GATHERED:
                    keys, counts = ([x] for x in summed(np.concatenate(keys), np.concatenate(counts)))
                    held = len(keys[0])
                    if held > GATHERED // 2:
                        yield from flush()
                        keys, counts, held = [], [], 0
        if keys:
            yield from flush()
        there = np.flatnonzero(mass)
        yield batch(there, pa.nulls(len(there), pa.int32()), mass[there])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mass, summary = 0, None
        for b in batches:
            keys, counts = b.column("key"), b.column("n").to_numpy()
            if keys.null_count:  # the masses come first
                valid = keys.is_valid().to_numpy(zero_copy_only=False)
                mass += int(counts[~valid].sum())
                keys, counts = keys.drop_null(), counts[valid]
            if len(keys):
                summary = summary or Summary(mass // threshold + 1)
                summary.add(keys.to_numpy().copy(), counts.copy())
        if summary:
            left = summary.frequent(threshold)
            for lo in range(0, len(left), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(left[lo : lo + (1 << 16)])], names=["key"])

    counted = texts.mapInArrow(count, "part int, key int, n long")
    dealt = counted.repartitionById(partitions, "part").sortWithinPartitions(F.col("key").isNotNull())
    return dealt.mapInArrow(merge, "key int")


def bitmap_of(keys: DataFrame, bits: int) -> np.ndarray:
    """The keys as a bitmap of `bits` bits, a power of two; so many bits at most come to the driver."""
    slot = F.expr(f"cast(key as long) & {bits - 1}L")
    word = F.shiftright(slot, 6).cast("int").alias("word")
    bit = F.expr("shiftleft(1L, cast(cast(key as long) & 63L as int))").alias("bit")
    found = keys.select(word, bit).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def counted(texts: DataFrame, bitmaps: list[np.ndarray], longest: int) -> DataFrame:
    """(lang, size, phrase, n): exact counts of all that pass the bitmaps; size 0 counts all words of the language.

    A piece of text is counted by hashes, pieces are added up by their phrases, in each task before anything is sent.
    """
    sent = texts.sparkSession.sparkContext.broadcast(bitmaps)

    def batch(lang: pa.Array, size: int, phrase: pa.Array, n: np.ndarray) -> pa.RecordBatch:
        sizes = pa.array(np.full(len(n), size), pa.int32())
        return pa.RecordBatch.from_arrays([lang, sizes, phrase, pa.array(n, pa.int64())], names=["lang", "size", "phrase", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds: dict[str, int] = {}
        for b in sliced(batches):
            bodies, langs = b.column(0).to_pylist(), b.column(1).to_pylist()
            for lo, hi in pieces(bodies):
                words, own = Words(bodies[lo:hi], langs[lo:hi], seeds), pa.array(langs[lo:hi], pa.string())
                yield batch(own, 0, pa.array([""] * (hi - lo), pa.string()), np.diff(words.bounds))
                for size, hashes, good in candidates(words, sent.value, longest):
                    places = np.flatnonzero(good)
                    _, first, n = np.unique(hashes[places], return_index=True, return_counts=True)
                    places = places[first]
                    for cut, phrase in words.phrases(places, size):
                        yield batch(own.take(pa.array(words.text[places[cut]])), size, phrase, n[cut])

    found = texts.mapInArrow(count, "lang string, size int, phrase string, n long")
    return found.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))


def frequent_phrases(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    *,
    longest: int = LONGEST,
    threshold: int = THRESHOLD,
    bits: int = BITS,
) -> DataFrame:
    """(lang, size, phrase, n): every phrase of up to `longest` words that occurs `threshold` times, with its exact count.

    A row of size 0 has the number of all words of its language. Phrases lie within pieces, A-Z is in lower case. Rows
    without a language are `und`; null and empty texts have no words; a text is read whole, however long; repeated rows
    count as often as they are there; an empty table gives no rows. Other columns are not looked at.
    """
    body = F.col(text).cast("binary").alias("body")
    texts = df.select(body, F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"))
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bitmaps: list[np.ndarray] = []
    for _ in range(3):
        bitmaps.append(bitmap_of(survivors(texts, bitmaps, longest, threshold, partitions), bits))
    return stage(counted(texts, bitmaps, longest).filter((F.col("size") == 0) | (F.col("n") >= threshold)), "phrases")


def collocations(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    *,
    longest: int = LONGEST,
    threshold: int = THRESHOLD,
    top: int = TOP,
    phrases: Callable[..., DataFrame] = frequent_phrases,
) -> DataFrame:
    """The `top` phrases of each language: (lang, rank, phrase, a, l, r, n, score).

    A phrase of count `a` is cut in two at each place; of the scores 1000 * a * n / (l * r), rounded down, the least
    counts, of equal ones that with the shortest first part. A phrase that is never seen outside a longer one is left
    out. Ranked by score, then a, both descending, then by the phrase's bytes. What nulls, empty and long texts and
    repeated rows do is told at `frequent_phrases`.
    """
    known = phrases(df, text, lang, longest=longest, threshold=threshold)
    totals = known.filter("size = 0").select("lang", F.col("n").cast("decimal(38,0)").alias("n"))
    found = known.filter("size >= 2").select("lang", "size", "phrase", F.col("n").alias("a"))
    # f(longer) = a for some longer phrase means that it is so for one with a single word more.
    words = F.split("phrase", " ")
    parts = F.array(*[F.array_join(F.slice(words, at, F.col("size") - 1), " ") for at in (1, 2)])
    inside = found.filter("size >= 3").select("lang", F.explode(parts).alias("phrase"), "a").distinct()
    left = found.join(inside, ["lang", "phrase", "a"], "left_anti")

    cut = left.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "*",
        F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("tail"),
    )
    head = known.filter("size > 0").select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    tail = known.filter("size > 0").select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r"))
    both = cut.join(head, ["lang", "head"]).join(tail, ["lang", "tail"]).join(totals, "lang")
    score = F.expr("(1000 * cast(a as decimal(20,0)) * n) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    best = both.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    ranked = best.select("lang", "phrase", "a", "cut.l", "cut.r", F.col("n").cast("long").alias("n"), "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return (
        ranked.withColumn("rank", F.row_number().over(order).cast("long"))
        .filter(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
