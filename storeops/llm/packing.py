"""Hierarchical packing of token ids into windows of several lengths.

A document gives full 2048-token windows and one rest.  Rests are routed to context-size tiers by their length.  Those of
the longest tier open long windows, the longest first, whose gaps take the longest shorter rests that fit.  Each short
tier is then packed from its own rests and those left by shorter tiers, keeping windows that are exactly full; what is
left fills long windows again.
The plan needs only the histogram of rest lengths (at most 2047 rows, whatever the input); each rest then finds its place
by its rank among the rests of its length.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storeops.llm.common import store

LENGTH = 2048
TIERS = (256, 512, 1024, 2048)
END = 1  # closes every document
STEP_SIZE = 64  # windows per step group
RANK_ROWS = 200_000  # rows numbered by one window task
_encoders: dict[str, object] = {}


def encoder(ranks: str):
    """Byte-level BPE from a rank file, once per worker; same ids as the vocabulary's other file forms."""
    if ranks not in _encoders:
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as f:
            table = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
        _encoders[ranks] = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    return _encoders[ranks]


def tokenized(docs: DataFrame, ranks: str, length: int = LENGTH) -> DataFrame:
    """doc_id, n_tokens and the checksum of each cut of ``length`` ids; the ids themselves stay in the task."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks).encode_ordinary
        for batch in batches:
            counts, sums = [], []
            for text in batch.column("text"):
                ids = np.array([*encode(text.as_py() or ""), END], dtype="<u4")
                counts.append(len(ids))
                sums.append([zlib.crc32(ids[i : i + length].tobytes()) for i in range(0, len(ids), length)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(sums, pa.list_(pa.int64()))], ["doc_id", "n_tokens", "sums"]
            )

    return docs.select("doc_id", "text").mapInArrow(cut, "doc_id long, n_tokens long, sums array<long>")


def exact_fill(left: dict[int, int], n: int, size: int) -> Counter[int] | None:
    """Lengths still left that make up ``size`` together with one ``n``: the rest of the gap at each step by one or two, else the longest first."""
    pattern = Counter([n])
    free = lambda m: left.get(m, 0) - pattern[m]
    gap = size - n
    while gap:
        if free(gap) > 0:
            pattern[gap] += 1
            return pattern
        longest = 0
        for m in range(gap - 1, 0, -1):
            if free(m) > 0:
                if free(gap - m) > (m == gap - m):
                    pattern.update([m, gap - m])
                    return pattern
                longest = longest or m
        if not longest:
            return None
        pattern[longest] += 1
        gap -= longest
    return pattern


def plan(histogram: dict[int, int], length: int = LENGTH, tiers=TIERS) -> tuple[dict[int, list[tuple[int, int, int, int, int]]], int]:
    """Where the rests of each length go: (first rank, first window, rests per window, offset, tier) entries, and the windows used.

    Every pattern uses up one length, so there are at most ``length`` patterns.
    """
    left = {n: c for n, c in histogram.items() if c > 0}
    used: dict[int, int] = dict.fromkeys(left, 0)
    places: dict[int, list[tuple[int, int, int, int, int]]] = {n: [] for n in left}
    window = 0

    def lay(pattern: dict[int, int], tier: int) -> None:
        nonlocal window
        times = min(left[n] // c for n, c in pattern.items())
        offset = 0
        for n, c in pattern.items():
            places[n].append((used[n], window, c, offset, tier))
            offset += n * c
            used[n] += times * c
            left[n] -= times * c
        window += times

    def fill_long(least: int) -> None:
        """Long windows led by rests of at least ``least``, gaps taken by the longest rests that fit."""
        sizes = sorted(n for n in left if left[n])
        while sizes and sizes[-1] >= least:
            pattern: dict[int, int] = {}
            gap = length
            at = len(sizes) - 1
            while at >= 0:
                n = sizes[at]
                fit = min(gap // n, left[n])
                if fit:
                    pattern[n] = fit
                    gap -= fit * n
                at = min(at, bisect_right(sizes, gap)) - 1
            lay(pattern, length)
            sizes = [n for n in sizes if left[n]]

    short = sorted(t for t in tiers if t < length)
    above = 0
    fill_long(short[-1] + 1 if short else 1)
    for tier in short:  # exactly full
        for n in sorted((n for n in left if above < n <= tier), reverse=True):
            while left[n] and (pattern := exact_fill(left, n, tier)):
                lay(pattern, tier)
        above = tier
    fill_long(1)
    return places, window


def ranked(cut: DataFrame, length: int) -> DataFrame:
    """Adds the rank of each rest among those of its length, and the number of full windows before each document's."""
    salts = max(1, cut.count() // RANK_ROWS)
    rows = cut.select(
        "doc_id", "n_tokens", "sums", (F.col("n_tokens") % length).cast("int").alias("rest"), F.floor(F.col("n_tokens") / length).cast("long").alias("full"),
        F.pmod(F.xxhash64("doc_id", "sums"), F.lit(salts)).alias("salt"),
    )
    per_cell = rows.groupBy("rest", "salt").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("rest").orderBy("salt")
    firsts = per_cell.select("rest", "salt", (F.sum("n").over(earlier) - F.col("n")).alias("first"))
    windows = rows.groupBy("salt").agg(F.sum("full").alias("f")).select("salt", (F.sum("f").over(Window.orderBy("salt")) - F.col("f")).alias("before"))
    order = ["doc_id", "n_tokens", "sums"]
    return (
        rows.withColumn("nth", F.row_number().over(Window.partitionBy("rest", "salt").orderBy(*order)) - 1)
        .join(firsts, ["rest", "salt"])
        .withColumn("own", F.sum("full").over(Window.partitionBy("salt").orderBy("rest", "nth").rowsBetween(Window.unboundedPreceding, -1)))
        .join(windows, "salt")
        .select("doc_id", "n_tokens", "sums", "rest", "full", (F.col("first") + F.col("nth")).alias("nth"), (F.col("before") + F.coalesce("own", F.lit(0))).alias("before"))
    )


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step long"


def pack(docs: DataFrame, ranks: str, length: int = LENGTH, tiers=TIERS, step_size: int = STEP_SIZE) -> DataFrame:
    """One row per piece of a document (doc_id, text): its place in the document, checksum, window and offset there.

    A null or empty text is the closing id alone.  Repeated rows are packed each by itself; ties between equal rows are
    interchangeable.  A document of any length is cut, never dropped.  ``tier`` is the window's length and ``step`` its
    step group: windows are numbered by pattern and dealt to the steps in turn, so every step gets
    an equal mix.  An empty table gives no rows.
    """
    cut = store(tokenized(docs, ranks, length), "token_cuts")
    rests = cut.groupBy((F.col("n_tokens") % length).cast("int").alias("rest")).count().where("rest > 0")
    places, n_mixed = plan({r.rest: r["count"] for r in rests.collect()}, length, tiers)
    n_full = cut.agg(F.sum(F.floor(F.col("n_tokens") / length))).first()[0] or 0
    steps = max(1, -(-(n_mixed + n_full) // step_size))
    table = {n: np.array(entries, np.int64).T for n, entries in places.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in ("n_tokens", "rest", "full", "nth", "before")}
            pieces = np.diff(batch.column("sums").offsets.to_numpy())
            row = np.repeat(np.arange(batch.num_rows), pieces)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            is_rest = nth == col["full"][row]
            sequence = n_mixed + col["before"][row] + nth
            offset, size, tier = np.zeros(len(row), np.int64), np.full(len(row), length, np.int64), np.full(len(row), length, np.int32)
            for n in np.unique(col["rest"][row[is_rest]]):
                mine = np.flatnonzero(is_rest & (col["rest"][row] == n))
                rank = col["nth"][row[mine]]
                first, window, per, at, level = table[n][:, np.searchsorted(table[n][0], rank, "right") - 1]
                sequence[mine] = window + (rank - first) // per
                offset[mine] = at + (rank - first) % per * n
                size[mine] = n
                tier[mine] = level
            sums = batch.column("sums").flatten()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row)), pa.array(nth * length), pa.array(size), sums, pa.array(col["n_tokens"][row]),
                 pa.array(sequence), pa.array(offset), pa.array(tier), pa.array(sequence % steps)],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step"],
            )

    return ranked(cut, length).mapInArrow(place, PIECES)
