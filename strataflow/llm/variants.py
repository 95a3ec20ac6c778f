"""Groups of words that differ by one letter, found with k-d trees over letter counts.

Words are vectors of how often each letter occurs. Replacing a letter raises one count by one and lowers another;
inserting one raises one count; so words that are one edit apart are at L1 distance two or one. Words of one length are
dealt to the cells of a k-d tree; a word visits all cells, of its own length and of the length above, whose boxes are
within reach. In a cell a finer tree is searched alike, and what it finds is compared letter by letter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.batches import runs, sliced
from strataflow.session import stage

RUN = re.compile("[A-Za-zÀ-ÿ]+")
DROP_ONE_IN, SHORTEST, LEAST, RATIO = 97, 5, 3, 2
# Different words that a task holds before it sends their counts.
HELD_WORDS = 300_000
# Letters of a cell's words, all told, and the most and fewest words it is meant to hold.
CELL_LETTERS, CELL_MOST, CELL_LEAST = 1 << 18, 1 << 15, 64
# Words per length that the borders of cells are chosen by. Every word gets its cell by these borders.
SAMPLE = 1 << 15
# Words of a leaf, and letters of pairs compared at a time.
LEAF, PAIR_LETTERS = 8, 1 << 23

_COLUMN = np.zeros(256, np.int64)
_LETTERS = [*range(0x61, 0x7B), *range(0xC0, 0x100)]
_COLUMN[_LETTERS] = np.arange(len(_LETTERS))
# What may be met on the way from a word to its near words: letters gained and lost.
REACH = {"same": (1, 1), "longer": (1, 0)}
RESIDENT, SAME, SHORTER = 0, 1, 2


def occurrences(df: DataFrame, key: str, text: str, drop_one_in: int = DROP_ONE_IN) -> DataFrame:
    """(word, n): how often each run of letters occurs, of which one in `drop_one_in` has lost a letter."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush() -> Iterator[pa.RecordBatch]:
            names, counts = list(held), list(held.values())
            for lo in range(0, len(names), 1 << 14):
                cut = slice(lo, lo + (1 << 14))
                yield pa.RecordBatch.from_arrays([pa.array(names[cut], pa.string()), pa.array(counts[cut], pa.int64())], names=["word", "n"])
            held.clear()

        for batch in sliced(batches):
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not body:
                    continue
                prefix = zlib.crc32(f"{name or ''}:".encode())
                for word, n in Counter(RUN.findall(body.lower().decode("utf-8", "replace"))).items():
                    h = zlib.crc32(word.encode(), prefix)
                    if h % drop_one_in == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                    held[word] += n
                if len(held) > HELD_WORDS:
                    yield from flush()
        yield from flush()

    source = df.select(F.col(key).cast("string"), F.col(text).cast("binary"))
    return source.mapInArrow(scan, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def codes_of(words: list[str], length: int) -> np.ndarray:
    """Words of one length as rows of bytes; all letters are in Latin-1."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), length)


def counts_of(codes: np.ndarray) -> np.ndarray:
    """Letter counts, a row per word."""
    n, length = codes.shape
    place = np.arange(n).repeat(length) * len(_LETTERS) + _COLUMN[codes.ravel()]
    kind = np.int16 if length < 1 << 15 else np.int32
    return np.bincount(place, minlength=n * len(_LETTERS)).reshape(n, -1).astype(kind)


class Tree:
    """A k-d tree whose nodes ask whether a letter occurs at least so often; leaves hold `leaf` vectors where they can.

    A node keeps the letter, the count asked for, and the least and largest count of that letter that its box allows.
    """

    def __init__(self, points: np.ndarray, leaf: int, deepest: int = 64):
        self.letter, self.count, self.low, self.high = [], [], [], []
        self.left, self.right = [], []
        self.leaves: list[np.ndarray] = []
        most = np.iinfo(points.dtype).max
        root = (np.arange(len(points)), {}, 0)
        todo = [(root, -1, False)]
        while todo:
            (inside, box, depth), above, is_right = todo.pop()
            split = self._split(points[inside]) if len(inside) > leaf and depth < deepest else None
            if split is None:
                name = -1 - len(self.leaves)
                self.leaves.append(inside)
            else:
                letter, count = split
                name = len(self.letter)
                low, high = box.get(letter, (0, most))
                for column, value in zip((self.letter, self.count, self.low, self.high), (letter, count, low, high), strict=True):
                    column.append(value)
                self.left.append(0)
                self.right.append(0)
                many = points[inside, letter] >= count
                todo.append(((inside[many], {**box, letter: (count, high)}, depth + 1), name, True))
                todo.append(((inside[~many], {**box, letter: (low, count - 1)}, depth + 1), name, False))
            if above >= 0:
                (self.right if is_right else self.left)[above] = name
        for field in ("letter", "count", "low", "high", "left", "right"):
            setattr(self, field, np.array(getattr(self, field), np.int64))
        self.sizes = np.array([len(x) for x in self.leaves])
        self.first = np.cumsum(self.sizes) - self.sizes
        self.members = np.concatenate(self.leaves)
        del self.leaves

    @staticmethod
    def _split(points: np.ndarray) -> tuple[int, int] | None:
        """The question that parts the points most evenly, or None if they are all alike."""
        best, half = None, len(points) / 2
        for count in (1, 2, 3):
            many = (points >= count).sum(axis=0)
            off = np.abs(many - half)
            letter = int(off.argmin())
            if 0 < many[letter] < len(points) and (best is None or off[letter] < best[0]):
                best = (off[letter], letter, count)
        if best is None:
            spread = points.max(axis=0) - points.min(axis=0)
            letter = int(spread.argmax())
            if not spread[letter]:
                return None
            return letter, int(np.sort(points[:, letter])[-1 - (points[:, letter] == points[:, letter].max()).sum()]) + 1
        return best[1], best[2]

    def reached(self, points: np.ndarray, up: int, down: int) -> tuple[np.ndarray, np.ndarray]:
        """(point, leaf) wherever the leaf's box has a vector with at most `up` letters more and `down` fewer."""
        who = np.arange(len(points))
        if not len(self.letter):
            return who, np.zeros(len(who), np.int64)
        node = np.zeros(len(who), np.int64)
        gain, loss = np.zeros(len(who), np.int64), np.zeros(len(who), np.int64)
        found_who, found_leaf = [], []
        while len(who):
            letter, count = self.letter[node], self.count[node]
            have = points[who, letter].astype(np.int64)
            low, high = self.low[node], self.high[node]
            # What the node's box already asks of this letter is replaced by what the child's box asks.
            base_gain, base_loss = gain - np.maximum(low - have, 0), loss - np.maximum(have - high, 0)
            sides = []
            for child, lo, hi in ((self.left[node], low, count - 1), (self.right[node], count, high)):
                g, d = base_gain + np.maximum(lo - have, 0), base_loss + np.maximum(have - hi, 0)
                near = (g <= up) & (d <= down)
                sides.append((who[near], child[near], g[near], d[near]))
            who, node, gain, loss = (np.concatenate(x) for x in zip(*sides, strict=True))
            end = node < 0
            found_who.append(who[end])
            found_leaf.append(-1 - node[end])
            who, node, gain, loss = who[~end], node[~end], gain[~end], loss[~end]
        return np.concatenate(found_who), np.concatenate(found_leaf)


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of equal length differ in exactly one place."""
    return (a != b).sum(axis=1) == 1


def one_inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether a letter inserted into the row of `a` gives that of `b`, which is longer by one."""
    n = a.shape[1]
    front, back = a == b[:, :n], (a == b[:, 1:])[:, ::-1]
    ahead = np.where(front.all(axis=1), n, front.argmin(axis=1))
    behind = np.where(back.all(axis=1), n, back.argmin(axis=1))
    return ahead + behind >= n


class Cell:
    """The words of a cell, in order, with their tree."""

    def __init__(self, words: list[str], counts: np.ndarray, length: int):
        self.words, self.n, self.length = words, counts, length
        self.codes = codes_of(words, length)
        self.tree = Tree(counts_of(self.codes), LEAF)

    def near(self, codes: np.ndarray, shorter: bool) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) for each query that is one edit from a word of the cell."""
        who, leaf = self.tree.reached(counts_of(codes), *REACH["longer" if shorter else "same"])
        test, found_who, found_word = one_inserted if shorter else one_replaced, [], []
        sizes = self.tree.sizes[leaf]
        ends = np.cumsum(sizes)
        step, lo = max(1, PAIR_LETTERS // self.length), 0
        while lo < len(who):
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] - sizes[lo] + step, side="right")))
            own = sizes[lo:hi]
            query = np.repeat(who[lo:hi], own)
            inside = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
            word = self.tree.members[np.repeat(self.tree.first[leaf[lo:hi]], own) + inside]
            good = test(codes[query], self.codes[word])
            found_who.append(query[good])
            found_word.append(word[good])
            lo = hi
        empty = np.zeros(0, np.int64)
        return np.concatenate([empty, *found_who]), np.concatenate([empty, *found_word])


def best_of(who: np.ndarray, other: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each `who` the number of its pairs, and the `other` of largest n, of equal ones the first."""
    order = np.lexsort((other, -n, who))
    who, other = who[order], other[order]
    found, first, times = np.unique(who, return_index=True, return_counts=True)
    return found, times, other[first]


def borders(words: DataFrame, sample: int) -> dict[int, Tree]:
    """A tree of cells for each length that has too many words for one cell, over `sample` words of the length."""
    sizes = {r.length: r.words for r in words.groupBy("length").agg(F.count(F.lit(1)).alias("words")).collect()}
    limit = {k: max(CELL_LEAST, min(CELL_MOST, CELL_LETTERS // k)) for k in sizes}
    many = [k for k, n in sizes.items() if n > limit[k]]
    trees = {}
    for length in many:
        own = words.filter(F.col("length") == length).select("word")
        share = own.orderBy(F.xxhash64("word"), "word").limit(sample)
        drawn = [r.word for r in share.collect()]
        cells = -(-sizes[length] // limit[length])
        points = counts_of(codes_of(drawn, length))
        trees[length] = Tree(points, max(1, len(drawn) // cells))
    return trees


def visits(words: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """(length, cell, role, word, n): each word as a resident of its cell and as a query of all cells within reach."""

    def rows(words: list, n: np.ndarray, who: np.ndarray, cell: np.ndarray, length: int, role: int) -> pa.RecordBatch:
        k = len(who)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(k, length), pa.int32()),
                pa.array(cell, pa.int32()),
                pa.array(np.full(k, role), pa.int32()),
                pa.array(words, pa.string()).take(pa.array(who)),
                pa.array(n[who], pa.int64()),
            ],
            names=["length", "cell", "role", "word", "n"],
        )

    def place(points: np.ndarray, length: int, up: int, down: int) -> tuple[np.ndarray, np.ndarray]:
        if length in trees:
            return trees[length].reached(points, up, down)
        return np.arange(len(points)), np.zeros(len(points), np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 4096):
            by_length: dict[int, list[int]] = {}
            for i, word in enumerate(all_words := batch.column(0).to_pylist()):
                by_length.setdefault(len(word), []).append(i)
            n = batch.column(1).to_numpy()
            for length, at in by_length.items():
                own, own_n = [all_words[i] for i in at], n[at]
                points = counts_of(codes_of(own, length))
                yield rows(own, own_n, *place(points, length, 0, 0), length, RESIDENT)
                yield rows(own, own_n, *place(points, length, *REACH["same"]), length, SAME)
                yield rows(own, own_n, *place(points, length + 1, *REACH["longer"]), length + 1, SHORTER)

    return words.select("word", "n").mapInArrow(deal, "length int, cell int, role int, word string, n long")


def cell_links(visiting: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best): what each word has found in each cell, and each resident of shorter words."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, shorter = None, [], {}

        def out(words: list[str], near: np.ndarray, best_n: np.ndarray, best: list[str]) -> pa.RecordBatch:
            arrays = [pa.array(words, pa.string()), pa.array(near, pa.int64()), pa.array(best_n, pa.int64()), pa.array(best, pa.string())]
            return pa.RecordBatch.from_arrays(arrays, names=["word", "n_near", "best_n", "best"])

        def tell() -> Iterator[pa.RecordBatch]:
            found = sorted(shorter)
            for lo in range(0, len(found), 1 << 14):
                part = found[lo : lo + (1 << 14)]
                told = [shorter[i] for i in part]
                yield out([cell.words[i] for i in part], [t[0] for t in told], [t[1] for t in told], [t[2] for t in told])
            shorter.clear()

        last = None
        for part in runs(slices_of(batches), ["length", "cell", "role", "slice"]):
            length, here, role = (part.column(c)[0].as_py() for c in ("length", "cell", "role"))
            words, n = part.column("word").to_pylist(), part.column("n").to_numpy()
            if (length, here) != last:
                yield from tell()
                cell, held, last = None, [], (length, here)
            if role == RESIDENT:
                held.append((words, n))
                continue
            if cell is None:
                if not held:
                    continue  # nobody lives here
                cell = Cell([w for ws, _ in held for w in ws], np.concatenate([x for _, x in held]), length)
                held = []
            at, near = cell.near(codes_of(words, length - (role == SHORTER)), role == SHORTER)
            who, times, best = best_of(at, near, cell.n[near])
            yield out([words[i] for i in who], times, cell.n[best], [cell.words[i] for i in best])
            if role == SHORTER:
                who, times, best = best_of(near, at, n[at])
                for i, k, b in zip(who.tolist(), times.tolist(), best.tolist(), strict=True):
                    old = shorter.get(i, (0, 0, ""))
                    new = (int(n[b]), words[b])
                    # Queries come in order, so of equal counts the earlier one stays.
                    shorter[i] = (old[0] + k, *(new if new[0] > old[1] else old[1:]))
        yield from tell()

    dealt = visiting.repartition("length", "cell").sortWithinPartitions("length", "cell", "role", "word")
    return dealt.mapInArrow(search, "word string, n_near long, best_n long, best string")


def slices_of(batches: Iterator[pa.RecordBatch], rows: int = 2048) -> Iterator[pa.RecordBatch]:
    """The rows in numbered slices, so that a run of queries is never longer than a slice."""
    for number, batch in enumerate(sliced(batches, rows)):
        yield batch.append_column("slice", pa.array(np.full(batch.num_rows, number), pa.int64()))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the forms (word, form) lead to. Each round doubles the steps, so rounds are few."""
    links = stage(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = links.join(onward, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        )
        held = stage(moved, "variant-roots")
        links = held.select("word", "root")
        if held.filter("moved").isEmpty():
            return links


def spelling_variants(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    *,
    shortest: int = SHORTEST,
    least: int = LEAST,
    ratio: int = RATIO,
    drop_one_in: int = DROP_ONE_IN,
    sample: int = SAMPLE,
) -> DataFrame:
    """Words with the more frequent word that each may be a misspelling of: (word, form, root, n, n_near, form_n).

    Words are the runs of Latin letters of all texts, A-Z in lower case, that have `shortest` letters and occur `least`
    times. Near words differ by one inserted, deleted or replaced letter. The form is the near word of largest n, of
    equal ones the first, if it occurs `ratio` times as often. `sample` words a length choose the cells' borders; every
    word is looked up in every cell that can hold a near word, so nothing depends on them but the work.

    Null and empty texts have no words; a text is read whole, however long; repeated rows count as often as they are
    there; a row without a key counts as if its key were the empty text; an empty table gives no rows. Other columns are
    not looked at.
    """
    counted = occurrences(df, key, text, drop_one_in)
    length = F.char_length("word").alias("length")
    words = stage(counted.select("word", "n", length).filter((F.col("length") >= shortest) & (F.col("n") >= least)), "variant-words")
    found = cell_links(visits(words, borders(words, sample)))
    first = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("form"))).alias("first")
    near = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first)
    frequent = -F.col("first.less") >= ratio * F.col("n")
    formed = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(frequent, F.col("first.form")).alias("form"),
        F.when(frequent, -F.col("first.less")).alias("form_n"),
    )
    formed = stage(formed, "variant-forms")
    led = roots(formed.filter("form IS NOT NULL"))
    return formed.join(led, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
