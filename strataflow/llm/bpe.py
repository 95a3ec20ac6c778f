"""Byte-level BPE encoding and decoding with a segment tree over byte positions.

Each piece of the pre-split text is a row of a forest: the leaves of its tree are
its byte positions and hold the rank of the pair that starts there, and every inner
node holds the smallest (rank, position) below it, so that the root names the
leftmost pair of minimum rank. A merge links the live neighbours and updates three
leaves, with a logarithmic number of nodes each. Pieces of one batch that need
trees of the same size are merged in lockstep; a long piece has a tree of its own.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from strataflow.llm.batches import lean, sliced, tidy

# A pair that cannot merge. Ranks stay below 2^31, positions below 2^31.
NONE = np.int64(1) << 62
# Pieces that one worker remembers; beyond that the memory starts anew, which changes no result.
REMEMBERED = 300_000
# Longest tree that is merged in lockstep with others.
LOCKSTEP = 64
# Bytes of pieces that are merged in lockstep at a time; numpy holds some eighty bytes for each.
LOCKSTEP_BYTES = 1 << 17


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from the lines `base64 rank` of a vocabulary file."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


class PairTable:
    """Rank of every pair of tokens that merges, in an open-addressing table of fixed size."""

    def __init__(self, ranks: dict[bytes, int]):
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        keys = (np.array(left, np.int64) << 31) | np.array(right, np.int64)
        order = np.argsort(keys, kind="stable")
        keys, values = keys[order], np.array(merged, np.int64)[order]
        self.bits = max(4, int(4 * max(1, len(keys))).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int64)
        slots, left_over = self.slot(keys), np.arange(len(keys))
        self.probes = 0
        while len(left_over):  # every round places at most one key in a slot and moves the rest on
            self.probes += 1
            free = left_over[self.keys[slots[left_over]] == -1]
            _, first = np.unique(slots[free], return_index=True)
            put = free[first]
            self.keys[slots[put]], self.values[slots[put]] = keys[put], values[put]
            left_over = np.setdiff1d(left_over, put, assume_unique=True)
            slots[left_over] = (slots[left_over] + 1) & ((1 << self.bits) - 1)
        self.sorted_keys, self.sorted_values = memoryview(keys), memoryview(values)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, key: int) -> int | None:
        """Rank of one pair, (left << 31) | right, or None."""
        at = bisect.bisect_left(self.sorted_keys, key)
        return self.sorted_values[at] if at < len(self.sorted_keys) and self.sorted_keys[at] == key else None

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair (a, b), NONE where it does not merge; a or b may be -1."""
        keys = (a << 31) | b
        slots = self.slot(keys)
        found = np.full(len(keys), NONE, np.int64)
        open_ = np.flatnonzero((a >= 0) & (b >= 0))
        for _ in range(self.probes):
            if not len(open_):
                break
            there = self.keys[slots[open_]]
            hit = there == keys[open_]
            found[open_[hit]] = self.values[slots[open_[hit]]]
            open_ = open_[~hit & (there != -1)]
            slots[open_] = (slots[open_] + 1) & ((1 << self.bits) - 1)
        return found


# Of a piece: its ids, or only how many; their decimal digits, and the bytes they decode to, where these are wanted.
Entry = tuple[tuple[int, ...] | int, str | None, bytes | None]


class Codec:
    """Encoder and decoder of one vocabulary; lives once in each worker process."""

    def __init__(self, vocabulary: bytes, pattern: str):
        self.ranks = read_ranks(vocabulary)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.split = regex.compile(pattern).findall
        self.pairs = PairTable(self.ranks)
        self.of_byte = np.array([self.ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        if (self.of_byte < 0).any():
            raise ValueError("the vocabulary must hold all 256 single bytes")
        self.number = list(range(max(self.tokens, default=0) + 1))  # one object for each id, however often it is kept
        self.known: dict[str, Entry] = {}
        self.wanted = (True, True, True)

    def merge_together(self, pieces: Sequence[bytes], size: int) -> list[tuple[int, ...]]:
        """Token ids of pieces of at most `size` bytes, a power of two: one tree per piece, merged in lockstep."""
        rows = len(pieces)
        lengths = np.array([len(p) for p in pieces])
        raw = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), np.uint8).reshape(rows, size)
        place = np.arange(size)
        token = np.where(place < lengths[:, None], self.of_byte[raw], -1)
        token = np.concatenate([token, np.full((rows, 1), -1)], axis=1)  # position `size`: no neighbour
        after = np.minimum(np.broadcast_to(place + 1, (rows, size)), lengths[:, None])
        after = np.concatenate([np.where(after >= lengths[:, None], size, after), np.full((rows, 1), size)], axis=1)
        before = np.broadcast_to(np.where(place > 0, place - 1, size), (rows, size))
        before = np.concatenate([before, np.full((rows, 1), size)], axis=1).copy()
        shift = size.bit_length() - 1
        tree = np.full((rows, 2 * size), NONE, np.int64)
        right = np.concatenate([token[:, 1:size], np.full((rows, 1), -1)], axis=1)
        rank = self.pairs.ranks(token[:, :size].ravel(), right.ravel()).reshape(rows, size)
        tree[:, size:] = np.where(rank < NONE, (rank << shift) | place, NONE)
        for node in range(size - 1, 0, -1):
            tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])
        live = np.flatnonzero(tree[:, 1] < NONE)
        while len(live):
            top = tree[live, 1]
            at = top & (size - 1)
            gone = after[live, at]
            then = after[live, gone]
            prior = before[live, at]
            token[live, at] = top >> shift
            token[live, gone] = -1
            after[live, at] = then
            before[live, then] = at
            before[live, size] = size
            new = self.pairs.ranks(token[live, at], token[live, then])
            tree[live, size + at] = np.where(new < NONE, (new << shift) | at, NONE)
            tree[live, size + gone] = NONE
            has = prior < size
            row, where = live[has], prior[has]
            new = self.pairs.ranks(token[row, where], token[row, at[has]])
            tree[row, size + where] = np.where(new < NONE, (new << shift) | where, NONE)
            for changed, leaf in ((live, size + at), (live, size + gone), (row, size + where)):
                node = leaf >> 1
                for _ in range(shift):
                    tree[changed, node] = np.minimum(tree[changed, 2 * node], tree[changed, 2 * node + 1])
                    node = node >> 1
            live = live[tree[live, 1] < NONE]
        kept = token[:, :size]
        return [tuple(row[row >= 0].tolist()) for row in kept]

    def merge_alone(self, piece: bytes) -> tuple[int, ...]:
        """Token ids of one long piece: the same tree in flat lists."""
        n = len(piece)
        size = 1 << max(1, (n - 1).bit_length())
        token = [int(self.of_byte[b]) for b in piece]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank_of, none = self.pairs.rank, (int(NONE), 0)
        tree = [none] * (2 * size)
        for i in range(n - 1):
            rank = rank_of((token[i] << 31) | token[i + 1])
            if rank is not None:
                tree[size + i] = (rank, i)
        for node in range(size - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def update(i: int, rank: int | None) -> None:
            node = size + i
            tree[node] = none if rank is None else (rank, i)
            node >>= 1
            while node:
                least = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == least:
                    break
                tree[node] = least
                node >>= 1

        while tree[1] is not none and tree[1] != none:
            rank, i = tree[1]
            gone = after[i]
            then, prior = after[gone], before[i]
            token[i], token[gone], after[i] = rank, -1, then
            if then < n:
                before[then] = i
            update(gone, None)
            update(i, rank_of((rank << 31) | token[then]) if then < n else None)
            if prior >= 0:
                update(prior, rank_of((token[prior] << 31) | rank))
        return tuple(t for t in token if t >= 0)

    def merge(self, pieces: Sequence[bytes]) -> list[tuple[int, ...]]:
        """Token ids of each piece. A piece that is itself a token is that token, as the public library has it."""
        found: list[tuple[int, ...] | None] = [None] * len(pieces)
        by_size: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                found[i] = (whole,)
            elif len(piece) > LOCKSTEP:
                found[i] = self.merge_alone(piece)
            else:
                by_size.setdefault(1 << max(1, (len(piece) - 1).bit_length()), []).append(i)
        for size, rows in by_size.items():
            step = max(1, LOCKSTEP_BYTES // size)
            for start in range(0, len(rows), step):
                part = rows[start : start + step]
                for i, ids in zip(part, self.merge_together([pieces[i] for i in part], size), strict=True):
                    found[i] = ids
        return found

    def remember(self, pieces: Iterable[str]) -> None:
        """Make sure that `known` holds what is wanted of these pieces."""
        new = [p for p in set(pieces) if p not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {}
            new = list(set(pieces))
        encoded = self.merge([p.encode("utf-8", "surrogatepass") for p in new])
        with_ids, with_digits, with_bytes = self.wanted
        for piece, ids in zip(new, encoded, strict=True):
            self.known[piece] = (
                tuple([self.number[i] for i in ids]) if with_ids else len(ids),
                ",".join(map(str, ids)) if with_digits else None,
                self.decode(ids) if with_bytes else None,
            )

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join([self.tokens[i] for i in ids])

    def want(self, ids: bool, digits: bool, decoded: bool) -> None:
        """Say what `encode` is to give of each piece; the rest is not kept."""
        if self.wanted != (ids, digits, decoded):
            self.wanted, self.known = (ids, digits, decoded), {}

    def encode(self, texts: Sequence[str | None]) -> Iterator[list[Entry]]:
        """For each text (null: empty) the entries of its pieces in order."""
        start = 0
        while start < len(texts):  # a group of texts whose pieces fit into the memory together
            split, distinct = [], set()
            while start < len(texts) and (not split or len(distinct) < REMEMBERED // 4):
                found = self.split(texts[start] or "")
                distinct.update(found)
                split.append(found)
                start += 1
            self.remember(distinct)
            known = self.known
            for found in split:
                yield [known[p] for p in found]


_codecs: dict[tuple[bytes, str], Codec] = {}


def codec(vocabulary: bytes, pattern: str) -> Codec:
    """The worker's codec of a vocabulary, built on first use."""
    key = (hashlib.sha256(vocabulary).digest(), pattern)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(vocabulary, pattern)
    return _codecs[key]


OUTPUTS = {
    "ids": StructField("ids", ArrayType(IntegerType(), False), False),
    "decoded": StructField("decoded", BinaryType(), False),
    "n_tokens": StructField("n_tokens", LongType(), False),
    "ids_sha256": StructField("ids_sha256", StringType(), False),
    "decoded_sha256": StructField("decoded_sha256", StringType(), False),
}


def tokenize(
    df: DataFrame,
    vocabulary: str,
    pattern: str,
    outputs: Sequence[str] = ("ids", "decoded"),
    text: str = "text",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Encode every whole text and decode its ids again; adds the columns `outputs` names.

    `vocabulary` is the path of a rank file on the driver; its bytes, fixed in size, are broadcast. The texts never
    leave their partition: there is no shuffle, and each task holds one batch of texts and a bounded memory of pieces.
    `keep` names the columns to carry along (all by default). An output replaces an input column of its name, in any
    case. A null or empty text has no tokens and decodes to no bytes; repeated rows give repeated results; an empty
    table gives an empty one.
    """
    outputs = list(outputs)
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in {o.lower() for o in outputs}]
    with open(vocabulary, "rb") as file:
        shared = df.sparkSession.sparkContext.broadcast(file.read())
    source = df.select(*[F.col(f"`{c}`") for c in kept], F.col(text).alias("__text"))
    schema = StructType([source.schema[c] for c in kept] + [OUTPUTS[o] for o in outputs])
    types = [pa.list_(pa.int32()), pa.binary(), pa.int64(), pa.string(), pa.string()]
    arrow = dict(zip(OUTPUTS, types, strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(shared.value, pattern)
        coder.want("ids" in outputs, "ids_sha256" in outputs, "decoded" in outputs or "decoded_sha256" in outputs)
        for batch in sliced(batches):
            texts = batch.column(len(kept)).to_pylist()
            made: dict[str, list] = {o: [] for o in outputs}
            for entries in coder.encode(texts):
                if "ids" in made:
                    made["ids"].append([i for ids, _, _ in entries for i in ids])
                if "n_tokens" in made:
                    made["n_tokens"].append(sum([len(n) if "ids" in made else n for n, _, _ in entries]))
                if "ids_sha256" in made:
                    made["ids_sha256"].append(hashlib.sha256(",".join([d for _, d, _ in entries]).encode()).hexdigest())
                if "decoded" in made or "decoded_sha256" in made:
                    back = b"".join([b for _, _, b in entries])
                    if "decoded" in made:
                        made["decoded"].append(back)
                    if "decoded_sha256" in made:
                        made["decoded_sha256"].append(hashlib.sha256(back).hexdigest())
            arrays = [batch.column(i) for i in range(len(kept))] + [pa.array(made[o], arrow[o]) for o in outputs]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, *outputs])
        coder.known = {}

    return lean(source).mapInArrow(tidy(run), schema)
