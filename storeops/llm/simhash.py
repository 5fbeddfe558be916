"""Near-duplicate documents by SimHash fingerprints in BK-trees.

A fingerprint holds, bit by bit, the majority of the 64-bit hashes of a document's shingles.  Two fingerprints that differ
in at most two of 64 bits agree in two of four blocks of 16 bits, so each distinct fingerprint goes to the shards of its six
pairs of blocks.  A shard builds a BK-tree of its fingerprints: the children of a node are keyed by their Hamming distance to
it, and a search of radius r at distance d from a node follows only the edges d - r to d + r.  Shards of more than CROWDED
fingerprints are parted once more by two of four blocks of 8 of the bits that are still free; 16 bits stay free there, which
bounds a tree by 65,536 nodes whatever the size of the corpus.  A shard reports the links that join its components, which
are fewer than its fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeops.llm.common import store
from storeops.llm.graph import components
from storeops.llm.rolling import text_chunks

SHINGLE = 3
SEED = 42
RADIUS = 2  # two of four blocks agree for every radius up to 2
CROWDED = 4096  # fingerprints of a shard before it is parted once more
FRONTIER = 1 << 20  # (query, node) visits held at once
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: bytes, k: int = SHINGLE) -> np.ndarray:
    """XXH64 of each run of k words joined by spaces, repeats included; fewer words are one run, none give nothing."""
    words = text.translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= k:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a:b], SEED) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())], np.uint64)


def majority(hashes: list[np.ndarray]) -> np.ndarray:
    """One fingerprint per array: a bit is 1 if over half of the hashes have it; zero for an empty array.

    Bits are counted eight at a time in the bytes of a word, over at most 255 hashes before the bytes are added up.
    """
    sizes = np.array([len(h) for h in hashes], np.int64)
    out = np.zeros(len(hashes), np.uint64)
    if not sizes.sum():
        return out
    values = np.concatenate(hashes)
    begin = np.cumsum(sizes) - sizes
    cuts = np.concatenate([np.arange(b, b + n, 255) for b, n in zip(begin, sizes)])
    owner = np.repeat(np.arange(len(hashes)), -(-sizes // 255))
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    who = owner[first]
    for shift in range(8):
        lanes = np.add.reduceat((values >> np.uint64(shift)) & _LANES, cuts)
        ones = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first)  # lane j counts bit 8 j + shift
        for lane in range(8):
            out[who] |= (2 * ones[:, lane] > sizes[who]).astype(np.uint64) << np.uint64(8 * lane + shift)
    return out


def fingerprints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, texts in text_chunks(batch):
                fp = majority([shingle_hashes(t, k) for t in texts])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, end - first), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long")


class BKTrees:
    """One BK-tree per group of consecutive rows, built and searched for all groups together, level by level.

    ``parent`` and ``edge`` tell where a row hangs; ``order`` lists the children of each node by edge.
    """

    def __init__(self, fps: np.ndarray, groups: np.ndarray):
        self.fps, n = fps, len(fps)
        roots = np.flatnonzero(np.diff(groups, prepend=groups[:1] - 1)) if n else np.zeros(0, np.int64)
        self.root = roots[np.searchsorted(roots, np.arange(n), "right") - 1] if n else roots
        self.parent, self.edge = np.full(n, -1), np.zeros(n, np.int64)
        at = self.root.copy()  # the node each waiting row stands at
        waiting = np.flatnonzero(at != np.arange(n))
        while len(waiting):
            d = np.bitwise_count(fps[waiting] ^ fps[at[waiting]]).astype(np.int64)
            _, first, which = np.unique(at[waiting] * 65 + d, return_index=True, return_inverse=True)
            child = waiting[first]  # the first row at this node and distance becomes the child, the others go on to it
            self.parent[child], self.edge[child] = at[child], d[first]
            at[waiting] = child[which]
            waiting = waiting[at[waiting] != waiting]
        key = np.where(self.parent >= 0, self.parent * 65 + self.edge, -1)
        self.order = np.argsort(key, kind="stable")
        self.keys = key[self.order]

    def within(self, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row, node) pairs of one group with row < node and at most ``radius`` differing bits."""
        n = len(self.fps)
        waiting = [(np.arange(a, min(a + FRONTIER // 16, n)), self.root[a : a + FRONTIER // 16]) for a in range(0, n, FRONTIER // 16)]
        while waiting:
            row, node = waiting.pop()
            if len(row) > FRONTIER:
                waiting += [(row[FRONTIER:], node[FRONTIER:])]
                row, node = row[:FRONTIER], node[:FRONTIER]
            d = np.bitwise_count(self.fps[row] ^ self.fps[node]).astype(np.int64)
            hit = (d <= radius) & (row < node)
            if hit.any():
                yield row[hit], node[hit]
            low = np.searchsorted(self.keys, node * 65 + np.maximum(d - radius, 0))
            high = np.searchsorted(self.keys, node * 65 + np.minimum(d + radius, 64), "right")
            many = high - low
            total = int(many.sum())
            if total:
                step = np.arange(total) - np.repeat(np.cumsum(many) - many, many)
                waiting.append((np.repeat(row, many), self.order[np.repeat(low, many) + step]))


def joining(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[list[int], list[int]]:
    """Of the pairs of 0 … n - 1 those that join two components so far."""
    root = list(range(n))
    left, right = [], []
    for a, b in pairs:
        for x, y in zip(a.tolist(), b.tolist()):
            p, q = x, y
            while root[p] != p:
                root[p] = root[root[p]]
                p = root[p]
            while root[q] != q:
                root[q] = root[root[q]]
                q = root[q]
            if p != q:
                root[q] = p
                left.append(x)
                right.append(y)
    return left, right


_PAIRS = list(combinations(range(4), 2))


def _blocks(width: int, bits: Column, pair: tuple[int, int]) -> Column:
    """The two blocks of a pair, side by side."""
    one, two = (F.shiftrightunsigned(bits, width * i).bitwiseAND(F.lit((1 << width) - 1)) for i in pair)
    return F.shiftleft(one, width).bitwiseOR(two)


def shards(nodes: DataFrame) -> DataFrame:
    """shard, fp, doc for the six shards of each fingerprint."""
    keys = [F.lit(i << 32).bitwiseOR(_blocks(16, F.col("fp"), pair)) for i, pair in enumerate(_PAIRS)]
    return nodes.select(F.explode(F.array(*keys)).alias("shard"), "fp", "doc")


def parted(crowded: DataFrame) -> DataFrame:
    """Rows of crowded shards dealt to six smaller shards each, by the 32 bits that are free in the shard."""
    free = F.lit(None).cast("long")
    for i, pair in enumerate(_PAIRS):
        others = tuple(j for j in range(4) if j not in pair)
        free = F.when(F.shiftrightunsigned("shard", 32) == i, _blocks(16, F.col("fp"), others)).otherwise(free)
    keys = [F.shiftleft(F.col("shard"), 19).bitwiseOR(F.lit(i << 16)).bitwiseOR(_blocks(8, free, pair)) for i, pair in enumerate(_PAIRS)]
    # six tags below 2^3, 32 and 16 bits of blocks: 54 bits, with the top bit apart from the shards that stay whole
    return crowded.select(F.explode(F.array(*keys)).alias("key"), "fp", "doc").select((-F.col("key") - 1).alias("shard"), "fp", "doc")


def tree_links(members: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links between the fingerprints (fp, doc) of each shard that join its components."""

    def compare(shard: np.ndarray, fp: np.ndarray, doc: np.ndarray) -> pa.RecordBatch:
        left, right = joining(len(fp), BKTrees(fp.view(np.uint64), shard).within(radius))
        cols = [doc[left], fp[left], doc[right], fp[right]]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_a", "fp_a", "doc_b", "fp_b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.zeros(0, np.int64)] * 3  # rows of the last shard, which may go on in the next batch
        for batch in batches:
            cols = [np.concatenate([r, batch.column(c).to_numpy()]) for r, c in zip(rest, ("shard", "fp", "doc"))]
            last = np.searchsorted(cols[0], cols[0][-1]) if len(cols[0]) else 0
            if last:
                yield compare(*[c[:last] for c in cols])
            rest = [c[last:] for c in cols]
        yield compare(*rest)

    dealt = members.repartition("shard").sortWithinPartitions("shard", "fp")
    return dealt.mapInArrow(run, "doc_a long, fp_a long, doc_b long, fp_b long").distinct()


def near_duplicates(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint, component_id for every row of ``docs`` (doc_id, text).

    Null, empty and wordless texts have fingerprint zero and link like any other.  Rows are linked by their own fingerprints,
    also rows that repeat an id; ties of equal fingerprints need no tree.  A row without id links with nothing and has no
    component.  Very long texts count whole, one at a time.  An empty table gives an empty result; other columns are not
    looked at.
    """
    rows = store(fingerprints(docs, k), "fingerprints")
    nodes = store(rows.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").cast("long").alias("doc")), "fingerprint_nodes")
    placed = shards(nodes)
    crowded = store(placed.groupBy("shard").count().where(F.col("count") > CROWDED).select("shard"), "crowded_shards")
    if crowded.head(1):  # at most 6 / CROWDED of the fingerprints; a hot shard is a skewed join, which AQE parts
        placed = placed.join(crowded, "shard", "left_anti").unionByName(parted(placed.join(crowded, "shard")))
    links = store(tree_links(placed), "fingerprint_links")
    end = lambda c: F.struct(F.col(f"doc_{c}").alias("doc"), F.col(f"fp_{c}").alias("fp"))
    groups = components(links.select(end("a").alias("a"), end("b").alias("b")))  # nodes compare by doc first
    found = groups.select(F.col("node.fp").alias("fp"), F.col("component.doc").alias("least"))
    named = nodes.join(found, "fp", "left").select("fp", F.coalesce("least", "doc").alias("component"))
    return rows.join(named, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id"),
    )
