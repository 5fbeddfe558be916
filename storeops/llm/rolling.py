"""Hashes of words and of runs of words or bytes, for whole chunks of documents at once (numpy, inside tasks)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20  # bytes of text handled at once; a longer document is a chunk of its own
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(29))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers["up"]) < n:
        size = max(n, 2 * CHUNK)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"], _powers["down"]


class Prefix:
    """Hashes of any byte ranges of a buffer, in constant time each."""

    def __init__(self, buf: np.ndarray):
        up, self.down = _power(len(buf) + 1)
        self.sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(_BYTE[buf] * up[: len(buf)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))

    def every(self, k: int) -> np.ndarray:
        """Hashes of the ranges of k bytes from each place on."""
        n = max(len(self.sums) - k, 0)
        return mix((self.sums[k:] - self.sums[:n]) * self.down[:n] + np.uint64(k))


def chunks(sizes: Iterable[int]) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive documents of about ``CHUNK`` bytes."""
    first, held, n = 0, 0, 0
    for n, size in enumerate(sizes):
        if held and held + size > CHUNK:
            yield first, n
            first, held = n, 0
        held += size + 1
    if held:
        yield first, n + 1


def text_chunks(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[int, int, list[bytes]]]:
    """(first, end, texts as bytes) over a batch; null is empty.  Only one chunk's texts leave the batch at a time."""
    texts = batch.column(column).cast(pa.binary())
    for a, b in chunks(pc.binary_length(texts).fill_null(0).to_pylist()):
        yield a, b, [x or b"" for x in texts.slice(a, b - a).to_pylist()]


class Words:
    """The words of some texts: start, end, hash, and the text each belongs to."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        self.buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        if lower:
            self.buf = _LOWER[self.buf]
        self.text_start = np.cumsum([0] + [len(t) + 1 for t in texts])
        space = _SPACE[self.buf]
        before = np.concatenate([[True], space[:-1]])
        self.start = np.flatnonzero(~space & before)
        self.end = np.flatnonzero(space & ~before)
        self.prefix = Prefix(self.buf)
        self.hash = self.prefix.of(self.start, self.end)
        # words of text i are first[i] up to first[i + 1]
        self.first = np.searchsorted(self.start, self.text_start)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))


def runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive values; runs over text borders are included and left to the caller."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out = out * np.uint64(0x9FB21C651E98DF25) + hashes[j : j + n]
    return mix(out)


def fold_unique(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (owner, value) pairs, ordered by owner."""
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    keep = np.ones(len(v), bool)
    keep[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
    return v[keep], o[keep]
