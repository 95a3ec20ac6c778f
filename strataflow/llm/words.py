"""Words of whole texts and their hashes as numpy arrays, alike on every machine.

A word is a run of bytes other than space and 0x09-0x0D, with A-Z in lower case. Words and shingles are known by
64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_DRAW = np.random.default_rng(64)
_BYTE = _DRAW.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = _DRAW.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_GAP = np.zeros(256, bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (uint64) of the words of all texts in order, and for each text where its words start, plus the end."""
    encoded = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    data = np.frombuffer(b"\n" + b"\n".join(encoded) + b"\n", np.uint8)
    begins = np.cumsum([1, *[len(e) + 1 for e in encoded]])
    gap = _GAP[data]
    starts = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
    ends = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
    bounds = np.searchsorted(starts, begins)
    if not len(starts):
        return np.zeros(0, np.uint64), bounds
    lengths = ends - starts
    letters = data[~gap]
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(letters)) - np.repeat(first, lengths)
    power = np.full(int(lengths.max()), _BASE)
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint64)
    return mix(np.add.reduceat(_BYTE[letters] * power[place], first) + lengths.astype(np.uint64)), bounds


def shingle_sets(texts: Sequence[str | None], size: int = 5) -> list[np.ndarray]:
    """For each text the sorted hashes (int64) of its distinct word shingles of `size` words.

    A text with fewer words has one shingle of all of them; one without words has none.
    """
    words, bounds = word_hashes(texts)
    full = np.zeros(0, np.uint64)
    if len(words) >= size:
        full = np.zeros(len(words) - size + 1, np.uint64)
        for i in range(size):
            full += words[i : len(words) - size + 1 + i] * _STEP[i]
        full = mix(full)
    sets = []
    for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        n = end - start
        if n >= size:
            found = full[start : end - size + 1]
        elif n:
            found = mix((words[start:end] * _STEP[:n]).sum(keepdims=True) + np.uint64(n))
        else:
            found = words[:0]
        sets.append(np.unique(found.view(np.int64)))
    return sets
