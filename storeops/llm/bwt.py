"""Removal of byte strings that an earlier document already holds, by merging Burrows-Wheeler transforms of shards.

Each shard of segments (see ``repeats``) gets its own transform.  The transforms are merged by refining their interleave:
a round orders all suffixes by two more of their first bytes, using only the transforms and their last-to-first maps.
Neighbours that a round parts first share the bytes compared before, which gives the common prefixes; where these reach 50
bytes without a break lie the repeated strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from storeops.llm.repeats import BYTES, removals, spans
from storeops.llm.rolling import Prefix

LENGTH = 50
SHARDS = 4


def suffixes(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling from eight symbols on; ends of texts (0) stop a comparison, equal suffixes keep their order."""
    n = len(text)
    end = np.append(np.flatnonzero(text == 0), n)
    left = np.repeat(end, np.diff(end, prepend=-1))[:n] - np.arange(n)  # symbols before the text's end
    key, open_ = np.zeros(n, np.uint64), np.ones(n, bool)
    for i in range(min(8, n)):  # eight symbols in one number, zeros from the end on
        open_ &= left > i
        key[: n - i] |= np.where(open_[: n - i], text[i:], 0).astype(np.uint64) << np.uint64(56 - 8 * i)
    step, classes = 8, 0
    while True:
        order = np.argsort(key)
        change = np.ones(n, np.int64)
        change[1:] = key[order[1:]] != key[order[:-1]]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(change)
        # classes that a round does not split are never split again
        if rank[order[-1]] == classes or step > int(left.max(initial=0)) + 1:
            return np.argsort(rank * n + np.arange(n))
        classes = int(rank[order[-1]])
        ahead = np.zeros(n, np.int64)
        if step < n:
            ahead[: n - step] = rank[step:] + 1
        ahead[left < step] = 0
        key = rank * (classes + 2) + ahead
        step *= 2


def transform(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array, transform and last-to-first map of texts that each end in 0."""
    order = suffixes(text)
    bwt = text[order - 1]  # before a text's first byte stands the end of the text before it
    place = np.empty(len(text), np.int64)
    place[order] = np.arange(len(text))
    return order, bwt, place[order - 1]


def merged(bwt: np.ndarray, last_to_first: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Merged order of all suffixes by ``length`` symbols, and the common prefix of each with the one before it.

    ``bwt`` and ``last_to_first`` are the shards' transforms one after the other.  A round goes two steps back in each
    text: suffixes ordered by t symbols, sorted by the two symbols before them, are ordered by t + 2.  An odd ``length``
    begins with a round of one step.  Neighbours that a round parts first share what the rounds before compared, so common
    prefixes are told to the even symbol; they end at ``length``.
    """
    n = len(bwt)
    order, block = np.arange(n), np.zeros(n, np.int32)
    common = np.full(n, length, np.uint8)
    common[:1] = 0
    two_back = last_to_first[last_to_first]
    pairs = bwt[last_to_first].astype(np.uint16) << np.uint16(8) | bwt
    for t in range(2 - length % 2, length + 1, 2):
        symbols, back, step = (bwt, last_to_first, 1) if t == 1 else (pairs, two_back, 2)
        symbol = symbols.take(order)
        by = symbol.argsort(kind="stable")
        order = back.take(order.take(by))
        symbol, before = symbol.take(by), block.take(by)
        new = symbol[1:] != symbol[:-1]
        new |= before[1:] != before[:-1]
        common[1:][new & (common[1:] == length)] = t - step
        np.cumsum(new, out=block[1:])
    return order, common


def repeated(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """First and last window of each body whose hash occurs again in any of the bodies; the last is -1 where none does.

    Equal windows have equal hashes, so no other window can be equal to one elsewhere; a chance hit is only compared.
    """
    sizes = np.array([len(b) for b in bodies])
    n = np.maximum(sizes - LENGTH + 1, 0)
    of = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(of)) - (np.cumsum(n) - n)[of]
    begin = (np.cumsum(sizes) - sizes)[of] + at
    h = Prefix(np.frombuffer(b"".join(bodies), np.uint8)).of(begin, begin + LENGTH)
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    again = np.zeros(len(h), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    hit = np.flatnonzero(again)  # by body, and by window inside it
    first, last = np.zeros(len(n), np.int64), np.full(len(n), -1)
    last[of[hit]] = at[hit]
    first[of[hit[::-1]]] = at[hit[::-1]]
    return first, last


def match(bodies: list[bytes], docs: np.ndarray) -> list[np.ndarray]:
    """For each window of each body the smallest document that holds it.

    Only the stretch of a body between its first and its last repeated window takes part in the transforms; its other
    windows are its own alone.
    """
    first, last = repeated(bodies)
    n = np.maximum(np.array([len(b) for b in bodies]) - LENGTH + 1, 0)
    start = np.cumsum(np.append(0, n))
    low = np.repeat(docs, n)
    hit = np.flatnonzero(last >= 0)
    if len(hit):
        parts = [bodies[i][a : b + LENGTH] for i, a, b in zip(hit.tolist(), first[hit].tolist(), last[hit].tolist())]
        for at, least in zip((start[hit] + first[hit]).tolist(), smallest(parts, docs[hit])):
            low[at : at + len(least)] = least
    return [low[a:b] for a, b in zip(start[:-1].tolist(), start[1:].tolist())]


def smallest(bodies: list[bytes], docs: np.ndarray) -> list[np.ndarray]:
    """For each window of each body the smallest document that holds it, from the merged transforms of all bodies."""
    sizes = np.array([len(b) for b in bodies])
    bounds = np.searchsorted(np.cumsum(sizes), np.linspace(0, sizes.sum(), SHARDS + 1)[1:-1]) if len(bodies) > SHARDS else []
    places, bwts, maps, base = [], [], [], 0
    for part in np.split(np.arange(len(bodies)), bounds):
        if len(part):
            # UTF-8 has no byte 0xFF, so bytes shifted by one leave 0 for the ends
            text = np.frombuffer(b"".join([x for i in part for x in (bodies[i], b"\xff")]), np.uint8) + np.uint8(1)
            order, bwt, lf = transform(text)
            places.append(order + base)
            bwts.append(bwt)
            maps.append(lf + base)
            base += len(text)
    order, common = merged(np.concatenate(bwts), np.concatenate(maps))
    block = np.cumsum(common < LENGTH) - 1  # a repeated interval goes on while neighbours share the whole length
    start = np.cumsum(np.append(0, sizes + 1))
    at = np.concatenate(places)[order]
    real = at + LENGTH <= np.repeat(start[1:] - 1, sizes + 1)[at]
    least = np.full(int(block[-1]) + 1, 1 << 62, np.int64)
    np.minimum.at(least, block[real], np.repeat(docs, sizes + 1)[at[real]])
    out = np.empty(int(start[-1]), np.int64)
    out[at] = least[block]
    return [out[a : a + max(n - LENGTH + 1, 0)] for a, n in zip(start, sizes)]


def remove_strings(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (remaining bytes), per row of ``docs`` (doc_id, text).

    A byte goes if a 50-byte string over it also starts in a document with a smaller doc_id.  A null or empty text has no
    bytes; a row without id keeps all; repeated rows agree.  The remaining bytes need not be valid UTF-8.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, removed, runs, kept = [], [], [], []
            for text, copy, at in zip(*[batch.column(c).to_pylist() for c in ("text", "copy", "at")]):
                raw = (text or "").encode()
                if copy and len(raw) >= LENGTH:
                    a, b = np.array([0]), np.array([len(raw)])
                else:
                    a, b = spans(at, LENGTH)
                edges = [0, *np.stack([a, b], 1).reshape(-1).tolist(), len(raw)]
                rest = b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2]))
                size.append(len(raw))
                removed.append(len(raw) - len(rest))
                runs.append(len(a))
                kept.append(rest)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(x, pa.int64()) for x in (size, removed, runs)], pa.array(kept, pa.binary()), pa.array([hashlib.sha256(k).hexdigest() for k in kept])],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"],
            )

    return removals(docs, BYTES, match).mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
