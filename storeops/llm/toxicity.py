"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents and unlabelled documents (their labels unused) train a logistic model on hashed words and word
beginnings; the risk of the negative class is corrected by the class prior and kept from turning negative.  The model is
fitted in numpy on a bounded sample; every whole text is scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeops.llm.rolling import Words, fold_unique, text_chunks

MAX_POSITIVE = 2500  # sampled toxic documents
MAX_UNLABELLED = 7500  # sampled documents of unknown class
BUCKETS = 1 << 20
STARTS = (4, 5, 6)  # lengths of the word beginnings, in bytes
N_FEATURES = 1200
MIN_SEEN, MIN_LIFT = 6, 2.5  # a feature occurs in so many toxic samples, and so many times as often as in unlabelled ones
ROUNDS, RATE, DECAY = 300, 0.05, 1e-3


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def hashed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (bucket, text) pairs and the number of words of each text."""
    w = Words(texts, lower=True)
    values, owner = [w.hash], [w.doc]
    for n in STARTS:
        long = w.end - w.start >= n
        values.append(w.prefix.of(w.start[long], w.start[long] + n) + np.uint64(n))
        owner.append(w.doc[long])
    bucket = (np.concatenate(values) >> np.uint64(44)).astype(np.int32)
    b, o = fold_unique(bucket, np.concatenate(owner))
    return b, o, np.diff(w.first)


def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, texts in text_chunks(batch):
            bucket, owner, n = hashed(texts)
            ends = np.searchsorted(owner, np.arange(len(texts) + 1))
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(bucket))
            yield pa.RecordBatch.from_arrays([batch.column("positive").slice(first, end - first), lists, pa.array(n.astype(np.int64))], ["positive", "buckets", "n_words"])


class Sample:
    """A 0/1 matrix as (row, slot) pairs, beside one dense column; products by counting, so nothing of rows x slots is built."""

    def __init__(self, row: np.ndarray, slot: np.ndarray, dense: np.ndarray, slots: int):
        self.row, self.slot, self.dense, self.slots = row, slot, dense, slots

    def __len__(self) -> int:
        return len(self.dense)

    def part(self, rows: np.ndarray) -> Sample:
        """The rows of a mask."""
        at, take = np.cumsum(rows) - 1, rows[self.row]
        return Sample(at[self.row[take]].astype(np.int32), self.slot[take], self.dense[rows], self.slots)

    def times(self, w: np.ndarray) -> np.ndarray:
        """Row scores under weights (slots, dense column, bias)."""
        return np.bincount(self.row, w[self.slot], len(self)) + self.dense * w[-2] + w[-1]

    def summed(self, v: np.ndarray) -> np.ndarray:
        """Sum of rows weighted by ``v``, in the order of the weights."""
        return np.concatenate([np.bincount(self.slot, v[self.row], self.slots), [self.dense @ v, v.sum()]])


def risk(p: Sample, u: Sample, w: np.ndarray, prior: float) -> tuple[float, float, np.ndarray]:
    """Risk of calling positives negative, corrected risk of the negative class, and the gradient to follow.

    The loss of calling z positive is 1 - s(z), of calling it negative s(z); both have slope s (1 - s).  The risk of the
    negative class is that of the unlabelled rows without the positives' share; where it turns negative, it is driven up.
    """
    sp, su = 1 / (1 + np.exp(-p.times(w))), 1 / (1 + np.exp(-u.times(w)))
    slope_p, slope_u = p.summed(sp * (1 - sp)) / max(len(p), 1), u.summed(su * (1 - su)) / max(len(u), 1)
    negative = (su.mean() if len(u) else 0.0) - prior * (sp.mean() if len(p) else 0.0)
    missed = prior * (1 - sp.mean() if len(p) else 0.0)
    return missed, negative, -prior * slope_p + slope_u - prior * slope_p if negative >= 0 else prior * slope_p - slope_u


def nnpu(x: Sample, positive: np.ndarray, prior: float, rounds: int = ROUNDS) -> np.ndarray:
    """Weights (dense column and bias last) minimising the non-negative risk with the sigmoid loss, by Adam over the whole sample."""
    p, u = x.part(positive), x.part(~positive)
    w = np.zeros(x.slots + 2)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        grad = risk(p, u, w, prior)[2] + DECAY * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w = w - RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


class Model:
    """Chosen buckets and their weights; of fixed size."""

    def __init__(self, chosen: np.ndarray, weights: np.ndarray):
        self.chosen, self.weights = chosen.astype(np.int32), weights.astype(np.float64)

    def score(self, texts: list[bytes]) -> np.ndarray:
        bucket, owner, n = hashed(texts)
        slot = np.searchsorted(self.chosen, bucket)
        slot[slot == len(self.chosen)] = 0
        known = self.chosen[slot] == bucket if len(self.chosen) else np.zeros(len(bucket), bool)
        z = np.bincount(owner[known], self.weights[slot[known]], len(texts)).astype(np.float64)
        z += self.weights[-2] * np.log1p(n) + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> Model:
    """Train on rows outside the held-out fold.  The class prior is the toxic share of their labels."""
    # a label that is given twice counts once
    known = labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = known.agg(F.avg("toxic")).first()[0] or 0.0
    prior = min(max(share, 1e-3), 0.9)
    by_hash = F.xxhash64(F.col("doc_id"), F.lit(11))
    toxic = known.where("toxic = 1").select("doc_id").orderBy(by_hash, "doc_id").limit(max_positive)
    others = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id").orderBy(by_hash, "doc_id").limit(max_unlabelled)
    sample = toxic.withColumn("positive", F.lit(True)).union(others.withColumn("positive", F.lit(False)))
    # at most max_positive + max_unlabelled ids
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("positive", "text")
    got = rows.mapInArrow(features, "positive boolean, buckets array<int>, n_words long").toArrow().combine_chunks()
    if not got.num_rows:
        return Model(np.zeros(0), np.array([0.0, np.log(prior / (1 - prior))]))
    positive = got["positive"].to_numpy(zero_copy_only=False).astype(bool)
    n_words = got["n_words"].to_numpy()
    lists = got["buckets"].combine_chunks()
    bucket = lists.flatten().to_numpy()
    owner = np.repeat(np.arange(len(positive), dtype=np.int32), np.diff(lists.offsets.to_numpy()))
    n_pos, n_unl = max(positive.sum(), 1), max((~positive).sum(), 1)
    chosen = choose(bucket, positive[owner], n_pos, n_unl)
    if not len(chosen):
        return Model(chosen, nnpu(Sample(owner[:0], owner[:0], np.log1p(n_words), 0), positive, prior))
    slot = np.minimum(np.searchsorted(chosen, bucket), len(chosen) - 1).astype(np.int32)
    hit = chosen[slot] == bucket
    sample = Sample(owner[hit], slot[hit], np.log1p(n_words), len(chosen))
    del got, lists, bucket, owner, slot, hit
    return Model(chosen, nnpu(sample, positive, prior))


def choose(bucket: np.ndarray, positive: np.ndarray, n_pos: int, n_unl: int) -> np.ndarray:
    """The buckets that set toxic samples apart best, ascending; (bucket, positive) pairs are distinct per document."""
    count = lambda values: np.unique(values, return_counts=True)
    held, in_pos = count(bucket[positive])
    held, in_pos = held[in_pos >= MIN_SEEN], in_pos[in_pos >= MIN_SEEN]
    if not len(held):
        return np.zeros(0, np.int32)
    others = bucket[~positive]
    at = np.minimum(np.searchsorted(held, others), len(held) - 1)
    in_unl = np.bincount(at[held[at] == others], minlength=len(held))
    a, b = in_pos / n_pos, (in_unl + 0.5) / n_unl
    strength = np.where(a >= MIN_LIFT * b, (a - b) / np.sqrt(b / n_pos), 0)
    best = np.argsort(-strength, kind="stable")[:N_FEATURES]
    return np.sort(held[best[strength[best] > 0]]).astype(np.int32)


def score(docs: DataFrame, model: Model, keep: list[str] | None = None, name: str = "score") -> DataFrame:
    """``keep`` columns of ``docs`` (doc_id by default) and the score under ``name``.

    Every row is scored by its whole text alone, so repeated rows agree; a null or empty text has no features and scores
    by bias.  Choose ``name`` apart from the kept columns.
    """
    keep = keep or ["doc_id"]
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep] + [f"`{name}` double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, texts in text_chunks(batch):
                part = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], pa.array(model.score(texts))], [*keep, name])

    wanted = list(dict.fromkeys([*keep, "text"]))
    return docs.select(*wanted).mapInArrow(run, schema)
