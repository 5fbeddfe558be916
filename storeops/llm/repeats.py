"""Strings of fixed length that also start in an earlier document, for words and for bytes alike.

Every window of ``width`` units has an anchor: its leftmost run of ``k`` units with the least hash.  Equal windows have
equal anchors, so only texts around an anchor that several documents share need to be compared; the comparison itself is
the caller's.  Consecutive windows with one anchor form a segment.

1. Anchors are packed by hash bucket, each batch sending four bytes and a few more per anchor and document, and a bucket
   tells which occur in several documents (``shared_anchors``).
2. The segments at shared anchors are cut from the texts; equal ones are merged, keeping the smallest doc_id.
3. The caller's ``match`` gives each distinct segment, window by window, the smallest doc_id that holds the window; runs
   of windows with one answer travel as one.  Segments at an anchor too crowded for one shard are cut into their windows,
   which are dealt to as many shards as it takes by their own hash; equal windows meet there.
4. Windows whose smallest doc_id is below the document's own cover the units to remove.

Exact copies of a whole text are told by their checksum first: all but the first lose everything if they hold a window,
and take no part in the rest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeops.functions.ranks import ranked
from storeops.llm.common import store, store_small, whole
from storeops.llm.rolling import Prefix, Words, mix, runs, text_chunks

BUCKET_BYTES = 8 << 20  # text per anchor bucket
SHARD_UNITS = 1 << 16  # units compared at once, where anchors are less crowded
CROWDED_BYTES = 1 << 19  # bodies at one anchor compared as one; a larger group is compared window by window


@dataclass(frozen=True)
class Unit:
    """How texts fall into units: ``of`` gives unit values, first unit of each text, and the hashes of runs of k units."""

    width: int
    k: int
    of: Callable[[list[bytes], int], tuple[np.ndarray, np.ndarray, np.ndarray]]


def word_units(texts: list[bytes], k: int):
    w = Words(texts)
    return w.hash.view(np.int64), w.first, runs(w.hash, k)


def byte_units(texts: list[bytes], k: int):
    buf = np.frombuffer(b"".join(texts), np.uint8)
    first = np.cumsum([0] + [len(t) for t in texts])
    return buf, first, Prefix(buf).every(k)


WORDS = Unit(13, 5, word_units)
BYTES = Unit(50, 20, byte_units)


def segments(unit: Unit, first: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor hash, text, first window and number of windows of each segment; windows are counted over all texts."""
    w = unit.width - unit.k + 1
    n = len(grams) - w + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none, none, none
    least, at, span = grams, np.arange(len(grams), dtype=np.int32 if len(grams) < 1 << 31 else np.int64), 1

    def better(a: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        left, right = slice(0, size), slice(a, a + size)
        return np.minimum(least[left], least[right]), np.where(least[right] < least[left], at[right], at[left])

    while 2 * span <= w:
        least, at = better(span, len(least) - span)
        span *= 2
    if span < w:
        least, at = better(w - span, n)
    size = np.diff(first)
    text = np.repeat(np.arange(len(size)), size)[:n]
    valid = np.arange(n) + unit.width <= np.repeat(first[1:], size)[:n]
    starts = np.ones(n, bool)
    starts[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1]) | ~valid[:-1]
    starts &= valid
    begin = np.flatnonzero(starts)
    if not len(begin):
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none, none, none
    count = np.add.reduceat(valid.astype(np.int64), begin)
    return mix(least[begin] + np.uint64(77)), text[begin], begin, count


def anchor_keys(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each anchor, then 32 more bits of it; buckets hold equal amounts of text, so chance hits stay as rare at any size."""
    n = np.uint64(buckets)
    return ((h % n) << np.uint64(32) | (h // n) & np.uint64(0xFFFFFFFF)).view(np.int64)


def several(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, ...]:
    """Places of entries alone at their key; then key, doc and whether it is the first of its key, for the distinct others."""
    order = np.argsort(key)
    multi = np.zeros(len(key), bool)
    same = key[order[1:]] == key[order[:-1]]
    multi[1:] |= same
    multi[:-1] |= same
    alone, order = order[~multi], order[multi]
    order = order[np.lexsort((doc[order], key[order]))]
    key, doc = key[order], doc[order]
    first, new = np.ones(len(key), bool), np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    new[1:] = first[1:] | (doc[1:] != doc[:-1])
    return alone, key[new], doc[new], first[new]


def batch_anchors(batch: pa.RecordBatch, unit: Unit, buckets: int) -> tuple[np.ndarray, ...]:
    """key, doc, known, first: each anchor of a batch once per document; ``known`` if several documents of the batch have it."""
    parts, ids = [(np.zeros(0, np.int64), np.zeros(0, np.int64))], batch.column("doc_id").to_numpy()
    for a, b, texts in text_chunks(batch):
        _, first, grams = unit.of(texts, unit.k)
        h, text, _, _ = segments(unit, first, grams)
        parts.append((anchor_keys(h, buckets), ids[a:b][text]))
    key, doc = (np.concatenate(x) for x in zip(*parts))
    alone, k, d, lead = several(key, doc)
    run = np.cumsum(lead) - 1
    known = np.bincount(run)[run] > 1 if len(run) else np.zeros(0, bool)
    more = np.ones(len(alone), bool)
    return np.concatenate([key[alone], k]), np.concatenate([doc[alone], d]), np.concatenate([~more, known]), np.concatenate([more, lead])


def planes(sorted_ids: np.ndarray) -> bytes:
    """Ascending ids as differences, byte by byte: mostly zeros, which the shuffle's compression folds."""
    return np.diff(sorted_ids, prepend=0).astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()


def from_planes(raw: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<i8").reshape(-1))


PIECE = 1 << 14  # entries of anchors known to be shared that travel in one row


def shared_anchors(texts: DataFrame, unit: Unit, buckets: int) -> DataFrame:
    """(doc, h): anchor keys that occur in several documents, with the documents to compare; texts: doc_id, text.

    Of anchors that several documents of a batch share, one entry goes to the bucket, to tell the other batches; all of
    them pass through in pieces spread over the buckets, so a frequent anchor gathers no more than one entry per batch.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, doc, known, lead = batch_anchors(batch, unit, buckets)
            rows: list[tuple[int, bytes, bytes, bytes | None]] = []
            order = np.flatnonzero(known)
            order = order[np.argsort(doc[order], kind="stable")]
            for at in range(0, len(order), PIECE):
                part = order[at : at + PIECE]
                rows.append(((int(key[part[0]]) & 0xFFFFFFFF) % buckets, key[part].tobytes(), planes(doc[part]), None))
            order = np.flatnonzero(~known | lead)
            order = order[np.lexsort((doc[order], key[order] >> 32))]
            bucket = key[order] >> 32
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
            for a, b in zip(cuts, cuts[1:] + [len(order)]):
                part = order[a:b]
                rows.append((int(bucket[a]), (key[part] & 0xFFFFFFFF).astype("<u4").tobytes(), planes(doc[part]), known[part].tobytes()))
            for at in range(0, len(rows), 1000):
                part = list(zip(*rows[at : at + 1000]))
                yield pa.RecordBatch.from_arrays([pa.array(part[0], pa.int64()), *[pa.array(x, pa.binary()) for x in part[1:]]], ["bucket", "h", "doc", "known"])

    def meet(bucket: int, parts: list[tuple[bytes, bytes, bytes]]) -> pa.RecordBatch:
        key = np.frombuffer(b"".join(p[0] for p in parts), "<u4") + np.int64(bucket << 32)
        doc = np.concatenate([from_planes(p[1]) for p in parts])
        known = np.frombuffer(b"".join(p[2] for p in parts), bool)
        told = np.unique(key[known])  # shared already: their other entries count even if alone here
        alone, k, d, lead = several(key[~known], doc[~known])
        alone = np.flatnonzero(~known)[alone]
        alone = alone[np.isin(key[alone], told)]
        run = np.cumsum(lead) - 1
        take = (np.bincount(run)[run] > 1) | np.isin(k, told) if len(run) else lead
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([doc[alone], d[take]])), pa.array(np.concatenate([key[alone], k[take]]))], ["doc", "h"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for bucket, h, doc, known in zip(*[batch.column(c).to_pylist() for c in ("bucket", "h", "doc", "known")]):
                if bucket != now and held:
                    yield meet(now, held)
                    held = []
                now = bucket
                if known is None:
                    yield pa.RecordBatch.from_arrays([pa.array(from_planes(doc)), pa.array(np.frombuffer(h, np.int64))], ["doc", "h"])
                else:
                    held.append((h, doc, known))
        if held:
            yield meet(now, held)

    packed = texts.mapInArrow(pack, "bucket long, h binary, doc binary, known binary")
    return packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(gather, "doc long, h long")


def cut_segments(texts: DataFrame, wanted: DataFrame, unit: Unit, buckets: int) -> DataFrame:
    """(h, c, doc, start, body, many) for every segment of a document at one of its shared anchors.

    h is the anchor's key; c tells bodies apart; a body comes with the smallest document of each batch that has it,
    ``many`` telling whether the batch has it again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists, found = batch.column("doc_id").to_numpy(), batch.column("hs"), []
            for a, b, part in text_chunks(batch):
                units, first, grams = unit.of(part, unit.k)
                h, text, begin, count = segments(unit, first, grams)
                h = anchor_keys(h, buckets)
                mine, of = lists.slice(a, b - a), np.repeat(np.arange(b - a), lists.slice(a, b - a).value_lengths().to_numpy())
                # a key and its text make one value; a chance hit only adds a segment to compare
                take = np.isin(mix(h.view(np.uint64)) + text.astype(np.uint64), mix(mine.flatten().to_numpy().view(np.uint64)) + of.astype(np.uint64))
                h, text, begin, count = h[take], text[take], begin[take], count[take]
                end = begin + count + unit.width - 1
                prefix = Prefix(units.view(np.uint8))
                c = prefix.of(begin * units.itemsize, end * units.itemsize)
                raw, size = units.tobytes(), units.itemsize
                bodies = [raw[x * size : y * size] for x, y in zip(begin.tolist(), end.tolist())]
                found.append((h, c, ids[a:b][text], begin - first[text], bodies))
            if not found:
                continue
            h, c, doc, start = (np.concatenate(x) for x in list(zip(*found))[:4])
            # equal segments of a batch send their body once, with the smallest document
            key = h.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + c
            order = np.lexsort((doc, key))
            again = np.zeros(len(h), bool)
            again[order[1:]] = key[order[1:]] == key[order[:-1]]
            many = np.zeros(len(h), bool)
            many[order[:-1]] = again[order[1:]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(h), pa.array(c.view(np.int64)), pa.array(doc), pa.array(start.astype(np.int64)), pa.array([x for f in found for x in f[4]], pa.binary(), mask=again), pa.array(many)],
                ["h", "c", "doc", "start", "body", "many"],
            )

    listed = wanted.groupBy("doc").agg(F.collect_set("h").alias("hs"))
    return texts.join(listed, texts["doc_id"] == listed["doc"]).select("doc_id", "text", "hs").mapInArrow(
        run, "h long, c long, doc long, start long, body binary, many boolean"
    )


Match = Callable[[list[bytes], np.ndarray], list[np.ndarray]]


def low_runs(mins: Sequence[np.ndarray]) -> pa.Array:
    """Runs of equal values of each array, as lists of (at, n, low)."""
    first = np.cumsum([0] + [len(m) for m in mins])
    low = np.concatenate(mins)
    new = np.ones(len(low), bool)
    new[1:] = low[1:] != low[:-1]
    new[first[:-1][first[:-1] < len(low)]] = True
    begin = np.flatnonzero(new)
    cuts = np.searchsorted(begin, first)
    at = begin - np.repeat(first[:-1], np.diff(cuts))
    n = np.diff(np.append(begin, len(low)))
    parts = [pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(low[begin])]
    return pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.StructArray.from_arrays(parts, ["at", "n", "low"]))


def matched(cut: DataFrame, match: Match, unit: Unit, unit_bytes: int) -> DataFrame:
    """(h, c, runs): for each distinct segment that may cover words or bytes to remove, its runs of windows (at, n) with one smallest doc_id (low); anchors are dealt in shards."""

    def compared(part: pa.Table) -> pa.RecordBatch:
        """The runs of whole anchors (h, doc, body, many), ordered."""
        body = part["body"].combine_chunks()
        size = pc.binary_length(body).to_numpy().astype(np.int64)
        end = np.cumsum(size)
        c = Prefix(np.frombuffer(b"".join(body.to_pylist()), np.uint8)).of(end - size, end).view(np.int64)  # as cut_segments and cut_windows have it
        order = np.lexsort((c, part["h"].to_numpy()))  # of equal segments, the smallest document stays first
        h, doc, many = (part[x].to_numpy()[order] for x in ("h", "doc", "many"))
        c, n = c[order], size[order] // unit_bytes - unit.width + 1
        lead = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (c[1:] != c[:-1])))
        # the same segment from another batch tells that several documents have it
        many = np.logical_or.reduceat(many, lead) | (np.diff(np.append(lead, len(h))) > 1)
        h, c, doc, n = h[lead], c[lead], doc[lead], n[lead]
        edge = np.concatenate([[True], h[1:] != h[:-1], [True]])
        # a segment alone at its anchor meets no other text: the first document that has it has all its windows
        alone = edge[1:] & edge[:-1]
        sure = np.flatnonzero(alone & many)
        whole_runs = pa.StructArray.from_arrays([pa.array(np.zeros(len(sure), np.int32)), pa.array(n[sure].astype(np.int32)), pa.array(doc[sure])], ["at", "n", "low"])
        places, lists = [sure], [pa.ListArray.from_arrays(pa.array(np.arange(len(sure) + 1, dtype=np.int32)), whole_runs)]
        rest = np.flatnonzero(~alone)
        if len(rest):
            bodies = body.take(pa.array(order[lead[rest]])).to_pylist()
            held = np.cumsum(n[rest] + unit.width - 1)
            first = np.flatnonzero(edge[:-1][rest])  # a shard ends where an anchor ends
            cuts = [0, *np.unique(first[np.minimum(np.searchsorted(held[first], np.arange(SHARD_UNITS, held[-1], SHARD_UNITS)), len(first) - 1)]).tolist(), len(rest)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                mins = match(bodies[a:b], doc[rest[a:b]])
                # else its only document is the first to have each of its windows
                told = [i for i, x in enumerate(mins) if many[rest[a + i]] or (x < doc[rest[a + i]]).any()]
                if told:
                    places.append(rest[a:b][told])
                    lists.append(low_runs([mins[i] for i in told]))
        at = np.concatenate(places)
        return pa.RecordBatch.from_arrays([pa.array(h[at]), pa.array(c[at]), pa.concat_arrays(lists)], ["h", "c", "runs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # what may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            h = batch.column("h").to_numpy()
            last = int(np.searchsorted(h, h[-1]))  # where the last anchor begins
            if held and (last or held[-1].column("h")[0].as_py() != h[0]):
                held.append(batch.slice(0, last))
                yield compared(pa.Table.from_batches(held))
                held = []
            elif last:
                yield compared(pa.Table.from_batches([batch.slice(0, last)]))
            held.append(batch.slice(last))
        if held:
            yield compared(pa.Table.from_batches(held))

    # c follows from the body and is not moved
    bodies = cut.where("body is not null").select("h", "doc", "body", "many")
    return bodies.repartition("h").sortWithinPartitions("h", "doc").mapInArrow(run, "h long, c long, runs array<struct<at:int,n:int,low:bigint>>")


def crowded_anchors(cut: DataFrame, unit: Unit, unit_bytes: int) -> DataFrame:
    """(h, shards): anchors whose segments hold more than CROWDED_BYTES, with the shards that their windows need."""
    size = F.octet_length("body").cast("long")
    per_anchor = cut.where("body is not null").groupBy("h").agg(F.sum(size).alias("size"), F.sum(size / unit_bytes - (unit.width - 1)).alias("windows"))
    return per_anchor.where(F.col("size") > CROWDED_BYTES).select("h", F.ceil(F.col("windows") * unit.width * unit_bytes / CROWDED_BYTES).cast("long").alias("shards"))


def cut_windows(crowded: DataFrame, unit: Unit, unit_bytes: int) -> DataFrame:
    """(h, c, doc, body, many, at): the windows of segments (h, c, doc, body, many, shards) as segments of their own.

    h is the shard; equal windows of a batch travel once, with the smallest document and the places (h, c, at) they have
    in the segments.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            bodies, (h, c, doc, shards) = batch.column("body").to_pylist(), (batch.column(x).to_numpy() for x in ("h", "c", "doc", "shards"))
            raw, size = b"".join(bodies), np.array([len(x) for x in bodies])
            n = size // unit_bytes - unit.width + 1
            of = np.repeat(np.arange(len(n)), n)
            at = np.arange(len(of)) - (np.cumsum(n) - n)[of]
            begin = (np.cumsum(size) - size)[of] + at * unit_bytes
            w = Prefix(np.frombuffer(raw, np.uint8)).of(begin, begin + unit.width * unit_bytes)
            shard = mix(h.view(np.uint64)[of] ^ mix(w % shards.view(np.uint64)[of] + np.uint64(1)))
            order = np.lexsort((doc[of], w, shard))
            new = np.ones(len(order), bool)
            new[1:] = (shard[order[1:]] != shard[order[:-1]]) | (w[order[1:]] != w[order[:-1]])
            cuts = np.flatnonzero(new)
            lead = order[cuts]
            many = np.logical_or.reduceat(batch.column("many").to_numpy(zero_copy_only=False)[of[order]], cuts) | (np.diff(np.append(cuts, len(order))) > 1)
            places = pa.StructArray.from_arrays([pa.array(h[of[order]]), pa.array(c[of[order]]), pa.array(at[order].astype(np.int32))], ["h", "c", "at"])
            wide = unit.width * unit_bytes
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard[lead].view(np.int64)), pa.array(w[lead].view(np.int64)), pa.array(doc[of[lead]]), pa.array([raw[x : x + wide] for x in begin[lead].tolist()], pa.binary()),
                 pa.array(many), pa.ListArray.from_arrays(pa.array(np.append(cuts, len(order)).astype(np.int32)), places)],
                ["h", "c", "doc", "body", "many", "at"],
            )

    return crowded.select("h", "c", "doc", "body", "many", "shards").mapInArrow(
        run, "h long, c long, doc long, body binary, many boolean, at array<struct<h:bigint,c:bigint,at:int>>"
    )


def matched_everywhere(cut: DataFrame, match: Match, unit: Unit) -> DataFrame:
    """As ``matched``, with crowded anchors dealt window by window, so no shard grows with the corpus."""
    unit_bytes = 8 if unit is WORDS else 1
    crowded = store(crowded_anchors(cut, unit, unit_bytes), "crowded_anchors")
    if crowded.isEmpty():
        return matched(cut, match, unit, unit_bytes)
    windows = cut_windows(cut.where("body is not null").join(crowded, "h"), unit, unit_bytes)
    lows = matched(windows, match, unit, unit_bytes).select("h", "c", F.get("runs", F.lit(0))["low"].alias("low"))
    placed = windows.select("h", "c", "at").join(lows, ["h", "c"]).select(F.explode("at").alias("x"), "low")
    per_segment = placed.groupBy(F.col("x.h").alias("h"), F.col("x.c").alias("c")).agg(
        F.collect_set(F.struct(F.col("x.at").alias("at"), F.lit(1).alias("n"), "low")).alias("runs")
    )
    return matched(cut.join(crowded, "h", "left_anti"), match, unit, unit_bytes).unionByName(per_segment)


PRINT = ("p", "q", "n")  # two checksums and the size of a text


def numbered_documents(prints: DataFrame) -> DataFrame | None:
    """doc_id, p, q, n, doc, first: numbers in the order of doc_id for documents of which some share an id, and the first
    number of the id; None where every id has one text."""
    ends = prints.groupBy("doc_id").agg(F.min(F.struct(*PRINT)).alias("a"), F.max(F.struct(*PRINT)).alias("b"))
    if not ends.where("a <> b").head(1):
        return None
    known = store(prints.distinct(), "documents")
    numbers = store(ranked(known, [], [F.col(c) for c in ("doc_id", *PRINT)], "doc").withColumn("doc", F.col("doc").cast("long")), "document_numbers")
    return numbers.join(numbers.groupBy("doc_id").agg(F.min("doc").alias("first")), "doc_id")


def removals(docs: DataFrame, unit: Unit, match: Match, extra: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` columns doc_id, text (null read as empty) and ``extra`` (given as x_0, x_1 and so on), with ``copy`` (an exact copy of an earlier text) and ``spans``, the merged unit ranges to remove.

    Null and empty texts have no windows.  A row without id has no smaller and no larger one, so it is neither compared
    nor cut.  Rows that repeat an id and text are one document: each keeps what the first keeps.  Rows of one id with
    different texts are different documents, none of them smaller than the other: each loses what smaller ids hold of it
    and nothing else.  A long text is compared whole; an empty table gives an empty result; columns that are not named are
    not looked at.
    """
    more = [F.col(c).alias(f"x_{i}") for i, c in enumerate(extra)]
    of = (F.xxhash64("text").alias("p"), F.crc32(F.col("text").cast("binary")).alias("q"), F.octet_length("text").alias("n"))
    carried = docs.select("doc_id", whole("text").alias("text"), *more)
    base = carried.select("doc_id", "text").where("doc_id is not null")
    prints = store(base.select("doc_id", *of), "prints")
    numbers = numbered_documents(prints)
    if numbers is not None:  # from here on, doc_id is the number of a document
        base = base.select("doc_id", "text", *of).join(numbers, ["doc_id", *PRINT]).select(F.col("doc").alias("doc_id"), "text")
        prints = numbers.select(F.col("doc").alias("doc_id"), *PRINT)
    firsts = prints.groupBy(*PRINT).agg(F.min("doc_id").alias("lead"), F.max("doc_id").alias("most")).where("lead <> most")
    copies = store(prints.join(firsts, list(PRINT)).where("doc_id > lead").select("doc_id").distinct(), "copies")
    total = prints.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))
    # sorted, so that a repeated task packs the same batches again
    texts = base.join(copies, "doc_id", "left_anti").sortWithinPartitions("doc_id")
    wanted = shared_anchors(texts, unit, buckets)
    cut = store_small(cut_segments(base, wanted, unit, buckets), "segments")
    runs_at = matched_everywhere(cut, match, unit)
    # runs of windows that start in an earlier document, each as one number: place of the first, then length in ten bits
    code = lambda x: F.shiftleft(F.col("start") + x["at"], RUN_BITS) + x["n"]
    places, own = cut.select("h", "c", "doc", "start"), F.col("doc")
    if numbers is not None:
        places, own = places.join(numbers.select("doc", "first"), "doc"), F.col("first")
    hit = places.join(runs_at, ["h", "c"]).select(
        "doc", F.transform(F.filter("runs", lambda x: x["low"] < own), code).alias("at")
    ).where(F.size("at") > 0)
    flat = hit.groupBy("doc").agg(F.flatten(F.collect_list("at")).alias("at"))
    state = flat.join(copies.select(F.col("doc_id").alias("doc"), F.lit(True).alias("copy")), "doc", "full")
    found = ["doc_id", "text", *[f"x_{i}" for i in range(len(extra))], F.coalesce("copy", F.lit(False)).alias("copy"), "at"]
    if numbers is None:
        return carried.join(state, carried["doc_id"] == state["doc"], "left").select(*found)
    named = numbers.join(state, "doc").select("doc_id", *PRINT, "copy", "at")
    return carried.select("*", *of).join(named, ["doc_id", *PRINT], "left").select(*found)


RUN_BITS = 10  # a segment has at most width - k + 1 windows


def spans(at: list[int] | None, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the merged ranges that these runs of windows cover."""
    if not at:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = np.sort(np.array(at, np.int64))
    begin = code >> RUN_BITS
    end = np.maximum.accumulate(begin + (code & ((1 << RUN_BITS) - 1)) - 1 + width)
    cut = np.flatnonzero(begin[1:] > end[:-1])
    return begin[np.append(0, cut + 1)], end[np.append(cut, len(end) - 1)]
