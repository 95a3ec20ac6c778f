"""N-gram Jaccard self-join by a token-group matrix: which documents share three quarters of their word shingles.

Texts with one set of shingles are one candidate. All candidates are ordered alike: shingles that a counting sketch
over the whole corpus finds in few texts come first. If two sets are similar enough, their first shingles in this
order, about a third of them, must have a certain number in common; candidates that have too few of these in common
with anything cannot link at all.

The rest is partitioned into blocks of similar documents, of bounded size. The shingles of a block's documents are kept
as a matrix of tokens and documents whose rows are the block's token union. A query is first held against the union:
only where enough of its shingles are there is the block opened, and the overlap with each document counted. That finds
the links within each block, and groups; the hubs of large groups then draw in what is like them elsewhere. Last, blocks
whose token unions meet often enough are held against each other, unless all their documents are in one group already.
No block is expanded into pairs, and no check is left out: blocks bound the memory, not the number of partners.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.batches import lean, pieces, runs, sliced, tidy
from strataflow.llm.components import components
from strataflow.llm.words import mix, shingle_sets
from strataflow.session import stage

SIZE, PERCENT = 5, 75
# Slots of the counting sketch; the broadcast bitmap of frequent slots has a bit for each, whatever the corpus.
SLOTS = 1 << 22
SLOT_BLOCK = 1 << 16
# Documents of a block, and of those held against one at a time.
BLOCK, SHARE = 256, 2048
# In further rounds, groups of at least so many documents draw in others by the HUBS largest groups of each place.
ROUNDS, LARGE, HUBS = 3, 8, 8
# Blocks of a token that are paired in one place, and pairs of blocks made at a time.
POSTINGS, PAIRS = 4096, 1 << 21
# Rows of ids, some 40 bytes each, up to which a table may be broadcast.
BROADCAST_ROWS = 500_000


class Matrix:
    """Tokens of a block's documents: the union, and for each of its tokens the documents that hold it."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets])
        tokens = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(tokens, kind="stable")
        self.owner = owner[order]
        self.union, first = np.unique(tokens[order], return_index=True)
        self.first = np.append(first, len(tokens))

    def linked(self, query: np.ndarray, percent: int) -> np.ndarray:
        """The block's documents that link with the query; none are counted if the union holds too little of it."""
        n = len(query)
        at = np.searchsorted(self.union, query)
        at[at == len(self.union)] = 0
        at = at[self.union[at] == query]
        least = -(-percent * max(n, int(self.sizes.min())) // 100)  # overlap that a link needs at least
        if len(at) < least:
            return np.zeros(0, np.int64)
        starts, counts = self.first[at], self.first[at + 1] - self.first[at]
        inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        shared = np.bincount(self.owner[np.repeat(starts, counts) + inside], minlength=len(self.sizes))
        return np.flatnonzero(100 * shared >= percent * (n + self.sizes - shared))


def sets_of(part: pa.Table, column: str = "tokens") -> list[np.ndarray]:
    lists = part.column(column).combine_chunks()
    values, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def fingerprint(tokens: np.ndarray, seed: int) -> int:
    return int(mix(tokens.view(np.uint64) + np.uint64(seed)).sum(dtype=np.uint64).view(np.int64))


def slot_of(tokens: np.ndarray, slots: int) -> np.ndarray:
    return (tokens.view(np.uint64) % np.uint64(slots)).astype(np.int64)


def survey(df: DataFrame, key: str, text: str, size: int, slots: int) -> DataFrame:
    """One scan of the texts: a row per document (id, n, fp1, fp2), and rows (slots, counts) of each task's sketch."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(slots, np.uint32)
        for batch in sliced(batches):
            texts = batch.column(1).to_pylist()
            n, one, two = [], [], []
            for lo, hi in pieces(texts):
                sets = shingle_sets(texts[lo:hi], size)
                sketch += np.bincount(slot_of(np.concatenate(sets), slots), minlength=slots).astype(np.uint32)
                n += [len(s) for s in sets]
                one += [fingerprint(s, 1) for s in sets]
                two += [fingerprint(s, 2) for s in sets]
            none, rows = pa.nulls(len(n), pa.int32()), pa.array(n, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), rows, pa.array(one, pa.int64()), pa.array(two, pa.int64()), none,
                 pa.nulls(len(n), pa.binary())],
                names=["id", "n", "fp1", "fp2", "slots", "counts"],
            )
        for at in range(0, slots, SLOT_BLOCK):
            own = np.minimum(sketch[at : at + SLOT_BLOCK], 65535).astype(np.uint16)
            if own.any():
                blank = [pa.nulls(1, pa.int64())] * 4
                row = [pa.array([at // SLOT_BLOCK], pa.int32()), pa.array([zlib.compress(own.tobytes(), 1)])]
                yield pa.RecordBatch.from_arrays([*blank, *row], names=["id", "n", "fp1", "fp2", "slots", "counts"])

    source = df.select(F.col(key).cast("long"), F.col(text))
    return lean(source).mapInArrow(tidy(scan), "id long, n long, fp1 long, fp2 long, slots int, counts binary")


def frequent(sketches: DataFrame, total: int, slots: int) -> np.ndarray:
    """Bitmap of the slots that hold clearly more than their share; it has `slots` bits."""
    limit = 64 + 3 * total // slots

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in runs(batches, ["slots"]):
            held = np.zeros(min(slots, SLOT_BLOCK), np.int64)
            for counts in part.column("counts"):
                held += np.frombuffer(zlib.decompress(counts.as_py()), np.uint16)
            bits = np.packbits(held > limit).tobytes()
            yield pa.RecordBatch.from_arrays([part.column("slots").combine_chunks()[:1], pa.array([bits])], names=["slots", "bits"])

    dealt = sketches.repartition("slots").sortWithinPartitions("slots")
    bitmap = np.zeros((slots + SLOT_BLOCK - 1) // SLOT_BLOCK * SLOT_BLOCK, np.uint8)
    for block, bits in dealt.mapInArrow(tidy(add), "slots int, bits binary").collect():  # slots / 8 bytes in all
        own = np.unpackbits(np.frombuffer(bits, np.uint8))
        bitmap[block * SLOT_BLOCK : block * SLOT_BLOCK + len(own)] = own
    return np.packbits(bitmap[:slots])


def needed(n: int, percent: int) -> int:
    """Shingles that a set of `n` must share with any other to link."""
    return -(-percent * n // 100)


def margin(n: int) -> int:
    """How many shingles of two prefixes must meet; the prefixes are that much longer than a single one needs."""
    return 1 + n // 16


def prefixes(df: DataFrame, text: str, size: int, percent: int, slots: int, bitmap: np.ndarray) -> DataFrame:
    """(cls, tokens): the leading shingles of every set, rare ones first; a set is named by its first fingerprint.

    A set that repeats within a task is told once.
    """
    shared = df.sparkSession.sparkContext.broadcast(bitmap)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, told = np.unpackbits(shared.value).astype(bool), set()
        for batch in sliced(batches):
            texts = batch.column(0).to_pylist()
            for lo, hi in pieces(texts):
                names, leading = [], []
                for tokens in shingle_sets(texts[lo:hi], size):
                    n, name = len(tokens), fingerprint(tokens, 1)
                    if not n or name in told:
                        continue
                    told.add(name)
                    often = bits[slot_of(tokens, slots)]
                    ordered = np.concatenate([tokens[~often], tokens[often]])
                    names.append(name)
                    leading.append(ordered[: n - needed(n, percent) + margin(n)])
                if names:
                    offsets = np.cumsum([0, *map(len, leading)]).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(leading)))
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), lists], names=["cls", "tokens"])

    return lean(df.select(text)).mapInArrow(tidy(scan), "cls long, tokens array<long>")


def sets_table(df: DataFrame, size: int) -> DataFrame:
    """(rep, place, part, tokens) of rows (rep, place, part, text)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = batch.column(3).to_pylist()
            for lo, hi in pieces(texts):
                sets = shingle_sets(texts[lo:hi], size)
                offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets)))
                ids = [batch.column(i).slice(lo, hi - lo) for i in range(3)]
                yield pa.RecordBatch.from_arrays([*ids, lists], names=["rep", "place", "part", "tokens"])

    return lean(df.select("rep", "place", "part", "text")).mapInArrow(tidy(scan), "rep long, place long, part int, tokens array<long>")


def merge_blocks(dealt: DataFrame, key: list[str], percent: int) -> DataFrame:
    """(head, into): which documents of each run of `key` are connected by links within it.

    Rows are (key, rep, tokens), each `rep` in one run. Connected documents all point to the one of them that has most
    links, the least such, which itself points to none.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in runs(batches, key):
            if part.num_rows < 2:
                continue
            rep, sets = part.column("rep").to_numpy(), sets_of(part)
            matrix, group, degree = Matrix(sets), np.arange(len(rep)), np.zeros(len(rep), np.int64)
            for i, query in enumerate(sets):
                near = matrix.linked(query, percent)
                degree[i] = len(near)
                names = np.unique(np.append(group[near], group[i]))
                if len(names) > 1:
                    group[np.isin(group, names)] = names[0]
            order = np.lexsort((rep, -degree))
            hub = np.empty(len(rep), np.int64)
            names, best = np.unique(group[order], return_index=True)
            hub[names] = order[best]
            joined = np.flatnonzero(hub[group] != np.arange(len(rep)))
            if len(joined):
                yield pa.RecordBatch.from_arrays([pa.array(rep[joined]), pa.array(rep[hub[group[joined]]])], names=["head", "into"])

    ordered = dealt.select(*key, "rep", "tokens").repartition(*key).sortWithinPartitions(*key, "rep")
    return ordered.mapInArrow(tidy(merge), "head long, into long")


def follow_hubs(dealt: DataFrame, percent: int) -> DataFrame:
    """(head, into): documents (side 1) that link with a hub (side 0) of their (place, part); the first one in order counts."""

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in runs(batches, ["place", "part"]):
            rep, side, sets = part.column("rep").to_numpy(), part.column("side").to_numpy(), sets_of(part)
            members = np.flatnonzero(side == 1)
            if not len(members) or len(members) == len(rep):
                continue
            matrix, into = Matrix([sets[i] for i in members]), np.full(len(members), -1)
            for i in np.flatnonzero(side == 0):
                near = matrix.linked(sets[i], percent)
                into[near[into[near] < 0]] = i
            moved = into >= 0
            if moved.any():
                yield pa.RecordBatch.from_arrays([pa.array(rep[members[moved]]), pa.array(rep[into[moved]])], names=["head", "into"])

    ordered = dealt.select("place", "part", "side", "rep", "tokens").repartition("place", "part")
    return ordered.sortWithinPartitions("place", "part", "side", "rep").mapInArrow(tidy(follow), "head long, into long")


def hubs_and_heads(placed: DataFrame, groups: DataFrame, block: int) -> DataFrame:
    """(place, part, side, rep): the large groups' hubs of each place, in all its blocks, and the heads of small ones in one each."""
    counts = groups.groupBy("grp").agg(F.count(F.lit(1)).alias("docs"))
    heads = counts.join(placed, F.col("grp") == F.col("rep")).select("rep", "docs", "place")
    by_size = Window.partitionBy("place").orderBy(F.col("docs").desc(), "rep")
    hubs = heads.filter(F.col("docs") >= LARGE).withColumn("rank", F.row_number().over(by_size)).filter(F.col("rank") <= HUBS)
    others = heads.filter(F.col("docs") < LARGE)
    at = hubs.select("place").distinct()
    near = others.join(at, "place")
    parts = near.groupBy("place").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"))
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    own = F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int").alias("part")
    left = hubs.join(parts, "place").select("place", every, F.lit(0).alias("side"), "rep")
    return left.union(near.join(parts, "place").select("place", own, F.lit(1).alias("side"), "rep"))


def by_few(large: DataFrame, small: DataFrame, on: str) -> DataFrame:
    """Join rows of sets with a staged table of ids that is broadcast if it is counted to be small, and dealt if not."""
    return large.join(F.broadcast(small) if small.count() <= BROADCAST_ROWS else small, on)


def linked_groups(dealt: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of groups that a link between two blocks connects, as many as it takes to connect them.

    Rows are (block, share, side, rep, grp, tokens): the documents of a block on side 1, and on side 0 a share of those that
    are held against it.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in runs(batches, ["block", "share"]):
            side, grp, sets = part.column("side").to_numpy(), part.column("grp").to_numpy(), sets_of(part)
            names, own = np.unique(grp, return_inverse=True)
            members, queries = np.flatnonzero(side == 1), np.flatnonzero(side == 0)
            if len(names) < 2 or not len(members) or not len(queries):
                continue
            matrix, top, edges = Matrix([sets[i] for i in members]), np.arange(len(names)), []
            for i in queries:
                for j in members[matrix.linked(sets[i], percent)]:
                    x, y = top[own[i]], top[own[j]]
                    if x != y:
                        top[top == max(x, y)] = min(x, y)
                        edges.append((names[own[i]], names[own[j]]))
            if edges:
                a, b = zip(*edges, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    ordered = dealt.select("block", "share", "side", "rep", "grp", "tokens").repartition("block", "share")
    return ordered.sortWithinPartitions("block", "share", "side", "rep").mapInArrow(tidy(compare), "a long, b long")


def held_against(pairs: DataFrame, blocks: DataFrame) -> DataFrame:
    """(block, share, side, rep, grp): each block of a pair that has more documents, against those of all its smaller ones.

    So a block is dealt once for all that is held against it, and again only for every further SHARE of that.
    """
    members = blocks.select("block", "rep", "grp")
    queries = stage(pairs.join(members.withColumnRenamed("block", "small"), "small").drop("small"), "jaccard-queries")
    shares = queries.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / SHARE).cast("int").alias("shares"))
    own = F.pmod(F.xxhash64("rep"), F.col("shares")).cast("int").alias("share")
    every = F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share")
    left = queries.join(shares, "block").select("block", own, F.lit(0).alias("side"), "rep", "grp")
    return left.union(shares.join(members, "block").select("block", every, F.lit(1).alias("side"), "rep", "grp"))


def meeting_pairs(blocks: np.ndarray, tokens: np.ndarray, shares: np.ndarray, own: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(lo, hi, meets) from rows sorted by token (and share) and block: two blocks for each token that both have.

    Pairs are made PAIRS at a time and each is told once for all tokens among them. Where a token has several shares,
    a share makes the pairs of its own blocks with the higher ones.
    """
    last = np.append((tokens[1:] != tokens[:-1]) | (own[1:] != own[:-1]), True)
    ends = np.flatnonzero(last)[np.cumsum(np.append(0, last[:-1]))]
    higher = ends - np.arange(len(blocks))
    higher[mix(blocks.view(np.uint64)) % shares.astype(np.uint64) != own.astype(np.uint64)] = 0
    total = np.cumsum(higher)
    start = 0
    while start < len(blocks):
        end = max(start + 1, int(np.searchsorted(total, total[start] - higher[start] + PAIRS, side="right")))
        n = higher[start:end]
        first = np.repeat(np.arange(start, end), n)
        other = first + 1 + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        start = end
        if not len(first):
            continue
        lo, hi = blocks[first], blocks[other]
        order = np.lexsort((hi, lo))
        lo, hi = lo[order], hi[order]
        new = np.flatnonzero(np.append(True, (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])))
        meets = np.diff(np.append(new, len(lo)))
        yield pa.RecordBatch.from_arrays([pa.array(lo[new]), pa.array(hi[new]), pa.array(meets)], names=["lo", "hi", "meets"])


def meeting_blocks(named: DataFrame) -> DataFrame:
    """(lo, hi, meets): in how many tokens two blocks meet, of the rows (token, block).

    Tokens of a passage that many blocks share have much the same blocks. They come together by the least of their
    blocks, in an order that is as good as random, and a pair is told once for them, not once for each. A token of very
    many blocks is dealt in shares, each with all blocks of it.
    """

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows = 0
        for part in runs(batches, ["run", "share"]):
            held.append(part)
            rows += part.num_rows
            if rows >= POSTINGS:
                yield from meeting_pairs(*columns(held))
                held, rows = [], 0
        if held:
            yield from meeting_pairs(*columns(held))

    def columns(held: list[pa.Table]) -> list[np.ndarray]:
        whole = pa.concat_tables(held)
        return [whole.column(c).to_numpy() for c in ("block", "token", "shares", "share")]

    by_token = Window.partitionBy("token")
    counted = named.withColumn("k", F.count(F.lit(1)).over(by_token)).withColumn("least", F.min(F.xxhash64("block")).over(by_token))
    shares = F.ceil(F.col("k") / POSTINGS).cast("int")
    run = F.when(F.col("k") > POSTINGS, F.xxhash64("token")).otherwise(F.col("least")).alias("run")
    share = F.explode(F.sequence(F.lit(0), shares - 1)).alias("share")
    dealt = counted.filter("k > 1").select(run, "token", "block", shares.alias("shares"), share).repartition("run", "share")
    found = dealt.sortWithinPartitions("run", "share", "token", "block").mapInArrow(tidy(meet), "lo long, hi long, meets long")
    return found.groupBy("lo", "hi").agg(F.sum("meets").alias("meets"))


def block_pairs(tokens: DataFrame, blocks: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Pairs (block, small) that may hold a link, `small` having no more documents: token unions that meet often enough,
    sizes close enough.

    Blocks all of whose documents are in one group already are not paired with each other. `blocks` has (rep, block, grp).
    """
    named = tokens.join(blocks.select("rep", "block"), "rep").select("token", "block").distinct()
    meets = meeting_blocks(named)
    only = F.when(F.min("grp") == F.max("grp"), F.min("grp")).alias("only")
    docs = F.count(F.lit(1)).alias("docs")
    extent = blocks.join(sizes, "rep").groupBy("block").agg(F.min("n").alias("small"), F.max("n").alias("large"), only, docs)
    extent = stage(extent, "jaccard-extent")
    names = ("small", "large", "only", "docs")
    a, b = (extent.toDF(side, *[f"{n}_{side}" for n in names]) for side in ("lo", "hi"))
    near_lo = F.col("large_lo") * 100 >= F.col("small_hi") * percent
    near_hi = F.col("large_hi") * 100 >= F.col("small_lo") * percent
    enough = F.col("meets") >= 1 + F.floor(F.least("small_lo", "small_hi") / 16)
    apart = F.coalesce(F.col("only_lo") != F.col("only_hi"), F.lit(True))
    more = F.col("docs_lo") >= F.col("docs_hi")
    ends = [F.when(more, F.col("lo")).otherwise(F.col("hi")), F.when(more, F.col("hi")).otherwise(F.col("lo"))]
    found = meets.join(a, "lo").join(b, "hi").filter(near_lo & near_hi & enough & apart)
    return found.select(ends[0].alias("block"), ends[1].alias("small"))


def placed(tokens: DataFrame, turn: int) -> DataFrame:
    """(rep, place): each document's least shared shingle in the order of this turn."""
    return tokens.groupBy("rep").agg(F.min(F.xxhash64("token", F.lit(turn))).alias("place"))


def moved(groups: DataFrame, merged: DataFrame) -> DataFrame:
    joined = groups.join(merged, F.col("grp") == F.col("head"), "left")
    return joined.select("rep", F.coalesce("into", "grp").alias("grp"))


def similar_sets(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    *,
    size: int = SIZE,
    percent: int = PERCENT,
    slots: int = SLOTS,
    block: int = BLOCK,
) -> DataFrame:
    """One row per row of `df`: key, n_shingles, component_id (the least key reachable by links, itself included).

    Two rows link if 100 * |A and B| >= percent * |A or B| for their sets of shingles of `size` words. Null, empty and
    wordless texts have no shingles and link with nothing. A row with a null key gets its number of shingles and a null
    component, and links nothing. Rows that repeat a key are returned once each; a key with several texts is one node
    that all of them connect. Other columns are not carried, so none can clash. An empty table gives an empty one.
    """
    told = stage(survey(df, key, text, size, slots), "jaccard-survey")
    documents = told.filter("slots IS NULL").select("id", "n", "fp1", "fp2")
    total = documents.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bitmap = frequent(told.filter("slots IS NOT NULL").select("slots", "counts"), total, slots)

    keyed = documents.filter("n > 0 AND id IS NOT NULL")
    classes = keyed.groupBy("fp1", "fp2", "n").agg(F.min("id").alias("rep"))
    classes = stage(classes, "jaccard-classes")

    with_key = df.filter(F.col(key).isNotNull() & F.col(text).isNotNull())
    leading = prefixes(with_key, text, size, percent, slots, bitmap).select(F.explode("tokens").alias("token"), "cls")
    by_token = Window.partitionBy("token")
    seen = (
        leading.withColumn("before", F.lag("cls").over(by_token.orderBy("cls")))
        .withColumn("first", F.min("cls").over(by_token))
        .withColumn("last", F.max("cls").over(by_token))
    )
    several = seen.filter("first <> last AND (before IS NULL OR before <> cls)").select("token", "cls")
    several = stage(several, "jaccard-tokens")
    # A partner has at least `percent` of the own size, and so a margin of that size's at least.
    open_ = several.groupBy("cls").agg(F.count(F.lit(1)).alias("meets"))
    least = F.floor(F.ceil(F.col("n") * percent / 100) / 16) + 1
    likely = open_.join(classes, open_.cls == classes.fp1).filter(F.col("meets") >= least)
    likely = stage(likely.select("cls", "rep", "n"), "jaccard-likely")
    tokens = several.join(likely.select("cls", "rep"), "cls").select("rep", "token")
    tokens = stage(tokens, "jaccard-shared")
    # Similar documents tend to have their least shingle, by an order of each round, in common. A block that holds all
    # documents of such a place, or a share of them, is a group to begin with.
    first = placed(tokens, 0)
    counts = first.groupBy("place").agg(F.count(F.lit(1)).alias("n"))
    part = F.when(F.col("n") > 1, F.pmod(F.xxhash64("rep"), F.ceil(F.col("n") / block))).otherwise(-1).cast("int")
    dealt = stage(first.join(counts, "place").select("rep", "place", part.alias("part")), "jaccard-places")
    wanted = with_key.select(F.col(key).cast("long").alias("rep"), F.col(text).alias("text"))
    sets = stage(sets_table(by_few(wanted, dealt, "rep"), size), "jaccard-sets")
    merged = merge_blocks(sets.filter("part >= 0"), ["place", "part"], percent)
    groups = likely.select("rep", F.col("rep").alias("grp")).distinct()
    groups = stage(moved(groups, merged), "jaccard-groups")
    sets = sets.select("rep", "tokens")
    for turn in range(ROUNDS):
        again = stage(hubs_and_heads(placed(tokens, turn), groups, block), "jaccard-hubs")
        if again.isEmpty():
            break
        groups = stage(moved(groups, follow_hubs(by_few(sets, again, "rep"), percent)), "jaccard-groups")

    block_id = F.xxhash64("place", "part").alias("block")
    blocks = stage(dealt.select("rep", block_id).join(groups, "rep"), "jaccard-blocks")
    pairs = stage(block_pairs(tokens, blocks, likely.select("rep", "n"), percent), "jaccard-pairs")
    across = stage(held_against(pairs, blocks), "jaccard-across")
    links = linked_groups(by_few(sets, across, "rep"), percent)

    # A class is named by the least id of its group, or its own; ids that repeat with several texts connect theirs.
    least = groups.groupBy("grp").agg(F.min("rep").alias("name"))
    names = stage(groups.join(least, "grp").select("rep", "name", "grp"), "jaccard-names")
    heads = names.select("grp", "name").distinct()
    ends = {c: heads.select(F.col("grp").alias(c), F.col("name").alias(f"of_{c}")) for c in ("a", "b")}
    links = links.join(ends["a"], "a").join(ends["b"], "b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))
    by_class = documents.join(classes, ["fp1", "fp2", "n"], "left").select("id", "n", "rep")
    by_class = by_class.join(names.select("rep", "name"), "rep", "left").select("id", "n", F.coalesce("name", "rep").alias("grp"))
    by_class = stage(by_class, "jaccard-class")
    tied = by_class.filter("id IS NOT NULL AND grp IS NOT NULL").groupBy("id")
    tied = tied.agg(F.min("grp").alias("least"), F.max("grp").alias("most")).filter("least <> most")
    tied = by_class.join(tied, "id").filter("grp <> least").select(F.col("grp").alias("a"), F.col("least").alias("b"))
    tops = components(links.union(tied), "jaccard-components").toDF("grp", "top")
    return by_class.join(tops, "grp", "left").select(
        F.col("id").alias(key),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("top", "grp", "id")).cast("long").alias("component_id"),
    )
