"""Rows of Arrow batches in pieces of bounded text, for work inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa

if TYPE_CHECKING:  # tasks do without it
    from pyspark.sql import DataFrame

PIECE_CHARS = 1 << 20
SLICE_ROWS = 512
# Rows in a batch of whole texts: both sides of the pipe to Python hold some batches at a time.
LEAN_ROWS = 1000


def sliced(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, without a copy: what Python makes of a batch stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def pieces(texts: Sequence[str | None], limit: int = PIECE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts hold at most `limit` characters together; a longer text is a range of its own.

    No text is cut. The limit bounds the memory of numpy work on a range.
    """
    start = held = 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if i > start and held + n > limit:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(texts):
        yield start, len(texts)


def runs(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal `keys` (not null, of a number type), whole even where batches cut them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        changes = np.zeros(batch.num_rows - 1, bool)
        for c in columns:
            changes |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(changes) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(c[start] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)


def lean(df: DataFrame) -> DataFrame:
    """The rows, for a scan of whole texts: Spark then hands Python LEAN_ROWS of them at a time.

    That is a setting of the session; it is left alone where it is not Spark's own default.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if conf.get(name) == "10000":
        conf.set(name, str(LEAN_ROWS))
    return df


def tidy(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The task, giving freed memory back to the machine at its end: its process stays, for whatever runs next."""

    def run(batches: Iterator) -> Iterator:
        yield from task(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library; others do without
        if trim is not None:
            trim(0)

    return run
