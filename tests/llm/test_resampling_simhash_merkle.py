"""Importance resampling, SimHash groups and the Merkle manifest against brute force, on awkward rows and on the smallest fixture."""

import math
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from storeops.functions import ranks
from storeops.llm import merkle, resampling, simhash
from storeops.llm.queries import ORACLE_SQL, QUERIES
from tests.compare import compare
from tests.llm.test_llm import LOWER, SCHEMA, WORD, awkward

ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(awkward(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def real(spark, data_dir):
    return spark.read.parquet(f"{data_dir}/documents.parquet")


@pytest.fixture(scope="module")
def target(spark, data_dir):
    return spark.read.parquet(f"{data_dir}/benchmark.parquet")


@pytest.mark.parametrize("name", ["op11_importance_resampling", "op13_merkle_manifest"])
def test_oracle(spark, duck, data_dir, name):
    assert compare(QUERIES[name](spark, data_dir), duck, ORACLE_SQL[name]) is None


# ---- op11 --------------------------------------------------------------------


def brute_resample(rows, targets, s):
    def features(text):
        w = ALNUM.findall((text or "").translate(LOWER))
        return len(w), [" ".join(w[i : i + k]) for k in range(1, s.n + 1) for i in range(len(w) - k + 1)]

    bucket = lambda f: zlib.crc32(f.encode()) % s.buckets
    held = [(i, *features(t)) for i, t in rows]
    have, want = Counter(), Counter()
    for _, _, fs in held:
        have.update(map(bucket, fs))
    for t in targets:
        want.update(map(bucket, features(t)[1]))
    big_s, big_t = sum(have.values()), sum(want.values())
    gain = lambda b: math.floor(1000 * math.log((want[b] + 1) * (big_s + s.buckets) / ((have[b] + 1) * (big_t + s.buckets))))
    out, able = [], []
    for i, n, fs in held:
        weight = sum(gain(bucket(f)) for f in fs)
        score = None
        if i is not None:
            h = int(sha256(f"{s.seed}:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(fs), weight, score, None])
        if n >= s.min_words and i is not None:
            able.append(out[-1])
    for rank, row in enumerate(sorted(able, key=lambda r: (-r[3], r[0], r[1]))[: s.percent * len(able) // 100], 1):
        row[4] = rank
    return Counter(map(tuple, out))


@pytest.mark.parametrize("settings", [resampling.Settings(), resampling.Settings(n=3, buckets=97, percent=40, min_words=2), resampling.Settings(percent=0)])
@pytest.mark.parametrize("which", ["odd", "real"])
def test_resampling(request, target, settings, which):
    docs = request.getfixturevalue(which)
    got = resampling.resample(docs, target, settings)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    want = brute_resample([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], [r.text for r in target.collect()], settings)
    assert Counter(map(tuple, got.collect())) == want


def test_resampling_sorts_by_ranges(spark, real, target, monkeypatch):
    """Half of all rows are one row repeated; the ranks stay gapless and are the same."""
    docs = real.select("doc_id", "text").unionByName(real.where("doc_id = 3").select("doc_id", "text", F.explode(F.sequence(F.lit(1), F.lit(150)))).drop("col"))
    s = resampling.Settings(percent=90)
    want = Counter(map(tuple, resampling.resample(docs, target, s).collect()))
    monkeypatch.setattr(ranks, "SPLIT_ROWS", 40)
    assert Counter(map(tuple, resampling.resample(docs, target, s).collect())) == want


def test_resampling_prefers_the_target(real, target, spark):
    """Documents made of target passages are drawn before others, repeated rows have neighbouring ranks."""
    passages = target.select((F.col("item_id") + 10_000_000).alias("doc_id"), "text").limit(10)
    docs = real.select("doc_id", "text").unionByName(passages)
    got = resampling.resample(docs, target).where("rank is not null")
    assert got.where("doc_id >= 10000000").count() >= 8


def test_resampling_of_nothing(none, target, odd):
    assert resampling.resample(none, target).collect() == []
    assert resampling.resample(odd, none).count() == odd.count()


# ---- op12 --------------------------------------------------------------------


def brute_fingerprint(text):
    w = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] * bool(w)
    ones = Counter(b for s in shingles for b in range(64) if xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1)
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def brute_groups(fps, radius=2):
    """Smallest id reachable over fingerprints (id, fp), for every fp."""
    parent = {f: f for _, f in fps}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    all_ = np.array(sorted(parent), np.uint64)
    for f in all_:
        for g in all_[np.bitwise_count(all_ ^ f) <= radius]:
            a, b = top(int(f)), top(int(g))
            if a != b:
                parent[max(a, b)] = min(a, b)
    least = defaultdict(lambda: 1 << 62)
    for i, f in fps:
        least[top(f)] = min(least[top(f)], i)
    return {f: least[top(f)] for f in parent}


@pytest.mark.parametrize("crowded", [4096, 1])
@pytest.mark.parametrize("which", ["odd", "real"])
def test_simhash(request, which, crowded, monkeypatch):
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    docs = request.getfixturevalue(which)
    rows = [(r.doc_id, brute_fingerprint(r.text)) for r in docs.select("doc_id", "text").collect()]
    group = brute_groups([r for r in rows if r[0] is not None])
    want = Counter((i, f"{f:016x}", group[f] if i is not None else None) for i, f in rows)
    got = simhash.near_duplicates(docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert Counter(map(tuple, got.collect())) == want


def test_shards_hold_every_link(spark, monkeypatch):
    """Chains and dense clouds of fingerprints, in shards that are parted and in whole ones."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 3, dtype=np.uint64)
    cloud = [int(base[0]) ^ int(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), replace=False))) for _ in range(500)]
    chain, last = [], int(base[1])
    for _ in range(60):
        last ^= (1 << int(rng.integers(0, 64))) | (1 << int(rng.integers(0, 64)))
        chain.append(last)
    fps = sorted(set(cloud + chain + [int(x) for x in rng.integers(0, 1 << 63, 300, dtype=np.uint64)]))
    want = brute_groups(list(enumerate(fps)))
    rows = [(i, int(np.uint64(f).view(np.int64))) for i, f in enumerate(fps)]
    nodes = spark.createDataFrame(rows, "doc long, fp long")
    placed = simhash.shards(nodes)
    for members in (placed, simhash.parted(placed)):
        links = simhash.tree_links(members).collect()
        parent = {f: f for f in fps}

        def top(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for link in links:
            a, b = (int(np.int64(x).view(np.uint64)) for x in (link.fp_a, link.fp_b))
            assert (a ^ b).bit_count() <= 2
            parent[top(a)] = top(b)
        least = {}
        for i, f in enumerate(fps):
            least.setdefault(top(f), i)
        assert {f: least[top(f)] for f in fps} == want
    sizes = simhash.parted(placed).groupBy("shard").count().agg(F.max("count")).first()[0]
    assert sizes < placed.groupBy("shard").count().agg(F.max("count")).first()[0]


def test_bk_tree_follows_edges():
    """Children hang at their distance to the parent, and the search visits fewer nodes than there are."""
    rng = np.random.default_rng(6)
    fps = np.unique(rng.integers(0, 1 << 63, 4000, dtype=np.uint64))
    near = fps[:50] ^ np.uint64(5)
    fps = np.unique(np.concatenate([fps, near]))
    trees = simhash.BKTrees(fps, np.zeros(len(fps), np.int64))
    inner = np.flatnonzero(trees.parent >= 0)
    assert len(inner) == len(fps) - 1
    assert (np.bitwise_count(fps[inner] ^ fps[trees.parent[inner]]) == trees.edge[inner]).all()
    assert len(np.unique(trees.parent[inner] * 65 + trees.edge[inner])) == len(inner)
    found = sorted((int(a), int(b)) for x, y in trees.within(2) for a, b in zip(x, y))
    want = [(a, int(b)) for a in range(len(fps)) for b in np.flatnonzero(np.bitwise_count(fps ^ fps[a]) <= 2) if b > a]
    assert found == want and len(found) >= 50


def test_simhash_of_a_long_text_and_of_nothing(spark, none):
    text = " ".join(f"w{i % 5003}" for i in range(120_000))
    docs = spark.createDataFrame([(1, text), (2, text + " end"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    assert got[1].fingerprint == f"{brute_fingerprint(text):016x}"
    assert (got[1].component_id, got[2].component_id, got[3].component_id) == (1, 1, 3)
    assert simhash.near_duplicates(none).collect() == []


# ---- op13 --------------------------------------------------------------------


def brute_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text); the definition, run by run."""
    digest = lambda xs: sha256("".join(xs).encode()).hexdigest()
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, t: digest([field(r[0]), field(r[1]), field(r[2]), field(r[3]), field(t)])

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([digest(out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
        return out

    sources = defaultdict(list)
    for r in rows:
        sources[r[1]].append((-1 if r[0] is None else r[0], leaf(r, r[4]), r))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        sources[s].sort(key=lambda x: x[:2])
        trees[s] = levels([x[1] for x in sources[s]])
    upper = levels([trees[s][-1][0] for s in order])
    root = upper[-1][0] if order else None
    out = Counter()
    for n, s in enumerate(order):
        for at, (_, node, r) in enumerate(sources[s]):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            folded, proof = leaf(r, None if r[4] is None else r[4].translate(LOWER)) if tampered else node, []
            for tree, i in ((trees[s], at), (upper, n)):
                for level in tree[:-1]:
                    run = level[i - i % 16 : i - i % 16 + 16]
                    here = i % 16
                    proof += run[:here] + run[here + 1 :]
                    folded = digest(run[:here] + [folded] + run[here + 1 :])
                    i //= 16
            out[(r[0], node, trees[s][-1][0], root, digest(proof), folded, folded == root)] += 1
    return out


def fields(docs):
    return [tuple(r) for r in docs.select(*merkle.FIELDS).collect()]


@pytest.mark.parametrize("which", ["odd", "real"])
def test_manifest(request, which):
    docs = request.getfixturevalue(which)
    got = merkle.manifest(docs)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(map(tuple, got.collect())) == brute_manifest(fields(docs))


@pytest.mark.parametrize("sizes", [[1], [16, 17], [4096, 4097, 1], [8200] + [1] * 20])
def test_manifest_of_sources_at_block_borders(spark, sizes):
    rows = [(n * 10_000 + i, f"s{n}", None, i, f"Text {i}") for n, size in enumerate(sizes) for i in range(size)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(7)
    assert Counter(map(tuple, merkle.manifest(docs).collect())) == brute_manifest(rows)


def test_manifest_with_many_sources(spark):
    rows = [(i, f"s{i % 4500}", "en", i, "A") for i in range(4600)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(7)
    assert Counter(map(tuple, merkle.manifest(docs).collect())) == brute_manifest(rows)


def test_manifest_of_a_hot_source_and_of_nothing(spark, none, monkeypatch):
    """Positions are given by ranges; a repeated row keeps a place per copy."""
    monkeypatch.setattr(ranks, "SPLIT_ROWS", 300)
    rows = [(i if i % 3 else 1, "hot" if i % 5 else None, "en", 1, "Same" if not i % 3 else f"Row {i}") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    assert Counter(map(tuple, merkle.manifest(docs).collect())) == brute_manifest(rows)
    assert merkle.manifest(none).collect() == []


def test_a_version_copies_only_its_path():
    nodes = [merkle.joined([str(i)]) for i in range(600)]
    block = merkle.Block(0, list(nodes))
    before = [list(level) for level in block.levels]
    version = merkle.Version(block.siblings(37), "f" * 64)
    assert len(version.copied) == len(block.levels) == 4  # the leaf and one ancestor a level
    assert block.levels == before
    changed = merkle.Block(0, nodes[:37] + ["f" * 64] + nodes[38:])
    assert version.copied == [level[i] for level, i in zip(changed.levels, (37, 2, 0, 0))]
    assert sum(a != b for one, two in zip(changed.levels, block.levels) for a, b in zip(one, two)) == 4
