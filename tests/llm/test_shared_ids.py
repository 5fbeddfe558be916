"""Rows that share an id, repeated rows and clashing columns: nothing is lost by another row's fate."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from storeops.llm import bwt, mixing, neardup, sharding, substrings, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(rng, n):
    return " ".join(f"w{x}" for x in rng.integers(0, 4000, n))


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(12)
    return {c: prose(rng, 40) for c in "ABCD"}


@pytest.fixture(scope="module")
def shared(spark, texts):
    """(2, B) has no smaller document that holds B; (3, B) has."""
    rows = [(1, "A"), (2, "A"), (2, "B"), (3, "B"), (3, "C"), (3, "C"), (4, "D"), (4, "CD")]
    rows = [(i, " ".join(texts[c] for c in names)) for i, names in rows]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rows


def brute_words(rows, width=13):
    windows = [{tuple(t.split()[i : i + width]) for i in range(len(t.split()) - width + 1)} for _, t in rows]
    out = Counter()
    for i, t in rows:
        w = t.split()
        gone = set()
        for at in range(len(w) - width + 1):
            if any(j < i and tuple(w[at : at + width]) in s for (j, _), s in zip(rows, windows)):
                gone.update(range(at, at + width))
        out[(i, " ".join(x for n, x in enumerate(w) if n not in gone))] += 1
    return out


def test_passages_of_rows_that_share_an_id(shared):
    docs, rows = shared
    assert Counter((r.doc_id, r.kept) for r in substrings.remove_passages(docs).collect()) == brute_words(rows)


def test_strings_of_rows_that_share_an_id(shared):
    docs, rows = shared
    want = Counter()
    for i, t in rows:
        gone = np.zeros(len(t), bool)
        for at in range(len(t) - 49):
            if any(j < i and t[at : at + 50] in other for j, other in rows):
                gone[at : at + 50] = True
        kept = "".join(c for c, g in zip(t, gone) if not g)
        want[(i, len(kept), hashlib.sha256(kept.encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_bytes - r.n_removed, r.kept_sha256) for r in bwt.remove_strings(docs).collect()) == want


def test_near_duplicates_of_rows_that_share_an_id(shared, spark, texts):
    docs, rows = shared
    got = Counter((r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(docs).collect())
    assert got == Counter([(1, 1, True), (2, 1, False), (2, 2, True), (3, 2, False), (3, 3, True), (3, 3, True), (4, 4, True), (4, 4, True)])
    # two sets that begin with one id, each with a near copy of its own
    near = {c: texts[c] + " end" for c in "AB"}
    more = spark.createDataFrame([(5, texts["A"]), (5, texts["B"]), (6, near["A"]), (7, near["B"]), (8, texts["C"])], "doc_id long, text string")
    assert Counter((r.doc_id, r.component_id) for r in neardup.near_duplicates(more).collect()) == Counter([(5, 5), (5, 5), (6, 5), (7, 5), (8, 8)])


def test_pipeline_keeps_the_text_that_stays(shared, spark, texts):
    docs = shared[0].select("*", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"))
    once = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    want = [(1, texts["A"]), (2, texts["B"]), (3, texts["C"]), (3, texts["C"]), (4, texts["D"]), (4, texts["C"] + " " + texts["D"])]
    assert Counter((r.doc_id, r.text) for r in once.collect()) == Counter(want)
    cut = corpus_pipeline.drop_repeated_passages(spark, docs, "")
    assert (2, texts["B"]) in {(r.doc_id, r.text) for r in cut.collect()}


def test_few_and_many_wanted_nodes_give_the_same_groups(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = prose(rng, 200).split()
    rows = [(i, " ".join(base[: 200 - i % 7] + [f"x{i % 3}"])) for i in range(40)] + [(100 + i, prose(rng, 90)) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = Counter(map(tuple, neardup.near_duplicates(docs).collect()))
    monkeypatch.setattr(neardup, "SENT_NODES", 0)
    assert Counter(map(tuple, neardup.near_duplicates(docs).collect())) == want


def test_shards_share_a_row_that_repeats(spark):
    """One row 3,000 times beside 2,000 others: sizes stay near equal."""
    rows = [(1, "the same row over and over")] * 3000 + [(i, f"text number {i}") for i in range(10, 2010)]
    got = sharding.shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), 8)
    sizes = [r.b for r in got.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 8 and max(sizes) <= 1.2 * min(sizes)
    slots = defaultdict(list)
    for r in got.collect():
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_mix_takes_any_column_names(spark):
    rows = [(i, f"word number {i}", "ab"[i % 2], i, i, i, i) for i in range(200)]
    plain = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, source string")
    odd = spark.createDataFrame(rows, "doc_id long, text string, source string, _rate int, rate int, copy int, of int")
    got = mixing.mix(odd)
    assert got.columns == odd.columns
    assert Counter(r.doc_id for r in got.collect()) == Counter(r.doc_id for r in mixing.mix(plain).collect())
    assert all((r._rate, r.rate, r.copy, r.of) == (r.doc_id,) * 4 for r in got.collect())


def dense(sample):
    x = np.zeros((len(sample), sample.slots + 2))
    x[sample.row, sample.slot] = 1
    x[:, -2], x[:, -1] = sample.dense, 1
    return x


def test_risk_and_its_gradient_equal_the_definition():
    rng = np.random.default_rng(8)
    make = lambda n: toxicity.Sample(*np.nonzero(rng.random((n, 6)) < 0.4), rng.random(n), 6)
    p, u, w = make(30), make(50), rng.normal(size=8)
    p.dense += 3
    w[-2] = 1.0  # positives score higher than unlabelled rows
    sigmoid = lambda z: 1 / (1 + np.exp(-z))
    for prior in (0.05, 0.9):  # the corrected risk of the negative class is positive, then negative
        def parts(w, prior=prior):
            sp, su = sigmoid(dense(p) @ w), sigmoid(dense(u) @ w)
            return prior * (1 - sp).mean(), su.mean() - prior * sp.mean()

        missed, negative, grad = toxicity.risk(p, u, w, prior)
        assert (missed, negative) == pytest.approx(parts(w))
        steps = np.eye(8) * 1e-6
        aim = (lambda w: sum(parts(w))) if negative >= 0 else (lambda w: -parts(w)[1])
        assert grad == pytest.approx([(aim(w + s) - aim(w - s)) / 2e-6 for s in steps], abs=1e-6)
    assert parts(w)[1] < 0


def test_parts_of_a_sample_are_its_rows():
    rng = np.random.default_rng(8)
    sample = toxicity.Sample(*np.nonzero(rng.random((40, 5)) < 0.3), rng.random(40), 5)
    mask = rng.random(40) < 0.5
    assert (dense(sample.part(mask)) == dense(sample)[mask]).all()


def test_a_label_given_twice_counts_once(spark):
    docs = spark.createDataFrame([(i, ("vile rotten slur " if i % 4 == 0 else "kind plain word ") * 3 + f"t{i}") for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int")
    once = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    twice = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.fit(docs, labels.union(labels.where("toxic = 1")))).collect()}
    assert once == pytest.approx(twice) and min(once[i] for i in range(0, 200, 4)) > max(once[i] for i in range(200) if i % 4)
