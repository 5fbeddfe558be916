"""Text operators against brute force, on awkward rows and on the smallest fixture."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from storeops.llm import bwt, licenses, mixing, neardup, packing, quality, repeats, rolling, sharding, substrings, topk, toxicity
from storeops.llm.graph import components
from storeops.llm.queries import ORACLE_SQL, QUERIES, rank_file
from tests.compare import compare

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, size long, score double, hash long"


def awkward() -> list[tuple]:
    rng = np.random.default_rng(4)
    vocab = ["".join(rng.choice(list("abcdefghijé"), 5)) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(vocab, n))
    passage, base = prose(30), prose(200)
    near = base.split(" ")
    near[100] = "changed"
    texts = [
        None, "", " \n\t ", "one", "Two words", base, base, base.upper().lower(), " ".join(near), prose(40) + " " + passage + "\n" + prose(40),
        passage + " " + prose(20), prose(20) + "\n" + passage, "a a a a a a a a a a a a a a a a", "x\ny\nx\n\n \nx", "Released under the MIT License. mit license",
        "Licensed under CC BY-NC 4.0.", "GNU General\nPublic, License", prose(6000), "### $$$ %%% &&& " * 30, "émoji \U0001f600 \x00 nul", None,
    ]
    return [(i, t, ["en", "fr", None, "xx"][i % 4], [None, "a", "b", "c"][i % 4], 0, 9, 9, 9.0, 9) for i, t in enumerate(texts)] + [(5, base, "fr", "a", 0, 9, 9, 9.0, 9), (None, passage, "en", "b", 0, 9, 9, 9.0, 9)]


@pytest.fixture(scope="module")
def rows():
    return awkward()


@pytest.fixture(scope="module")
def odd(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def real(spark, data_dir):
    return spark.read.parquet(f"{data_dir}/documents.parquet")


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


@pytest.mark.parametrize("which", ["odd", "real"])
def test_sharding(which, request):
    docs = request.getfixturevalue(which)
    got = sharding.shard_by_bytes(docs, 8).collect()
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in pairs(docs))
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    if which == "real":
        sizes = Counter()
        for r in got:
            sizes[r.shard] += r.size
        assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r.size for r in got)


def test_sharding_splits_a_heavy_text(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("same text again").alias("text"))
    assert sorted(r["count"] for r in sharding.shard_by_bytes(docs, 4).groupBy("shard").count().collect())[0] >= 80


def brute_near(rows, k=4):
    sets, parent = {}, {}
    for i, t in rows:
        if i is None:
            continue
        w = WORD.findall((t or "").translate(LOWER))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
        parent[i] = i
    held = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            held[x].append(i)
    common = Counter((min(a, b), max(a, b)) for x in held.values() for n, a in enumerate(x) for b in x[:n])

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            a, b = top(a), top(b)
            parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), top(i), top(i) == i) for i in sets}


@pytest.mark.parametrize("which", ["odd", "real"])
def test_near_duplicates(which, request):
    docs = request.getfixturevalue(which)
    got = neardup.near_duplicates(docs).collect()
    want = brute_near(pairs(docs))
    assert len(got) == docs.count()
    assert all((r.n_shingles, r.component_id, r.kept) == want[r.doc_id] for r in got if r.doc_id is not None)
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)


def test_near_duplicate_chain_beyond_the_first_of_a_band(spark):
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(base[:n] + [f"x{i}_{j}" for j in range(120 - n)])) for i, n in enumerate([120, 112, 113, 60, 119, 61])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_near(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(docs).collect()} == want


def test_large_group_of_near_copies_by_blocks(spark, monkeypatch):
    """Copies with edits of their own: most pairs are no links, and some copies reach the group over others only."""
    monkeypatch.setattr(neardup, "BLOCK", 16)
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(220):
        text = list(base)
        for at in rng.integers(0, 150, rng.integers(1, 9)):
            text[at] = f"x{at}_{rng.integers(0, 3)}"
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_near(rows)
    assert 1 < len({c for _, c, _ in want.values()})
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(docs).collect()} == want


def test_links_across_components_of_a_band(spark):
    """Two families of alike sets in common bands: only true links come out."""
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 1 << 60, 400, dtype=np.uint64)) for _ in range(2)]
    parts = []
    for i in range(30):
        parts.append(np.unique(np.append(sets[i % 2][rng.random(len(sets[i % 2])) > 0.02], np.uint64(i))))
    starts = np.cumsum([0] + [len(p) for p in parts])[:-1]
    regs = neardup.registers(np.concatenate(parts), starts)
    keys = neardup.band_keys(regs).view(np.int64)
    rows = [
        (int(keys[i, b]), i, len(parts[i]), regs[i].tobytes(), parts[i].view(np.int64).tolist())
        for i in range(30) for b in range(keys.shape[1]) if (keys[:, b] == keys[i, b]).sum() > 1
    ]
    nodes = spark.createDataFrame(rows, "band long, node long, n long, regs binary, items array<long>")
    none = spark.createDataFrame([], "node long, component long")
    placed = neardup.mixed_bands(nodes.select("band", "node"), none).join(nodes, ["band", "node"])
    links = [(r.a, r.b) for r in neardup.across(placed, 80, exact=True).collect()]
    assert links and all(a < b and a % 2 == b % 2 for a, b in links)
    for a, b in links:
        common = len(np.intersect1d(parts[a], parts[b]))
        assert 100 * common >= 80 * (len(parts[a]) + len(parts[b]) - common)


def test_similarity_estimate():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 63, 1500, dtype=np.uint64)
    a, b = pool[:1000], pool[100:1100]
    r = neardup.registers(np.concatenate([a, b]), np.array([0, 1000]))
    est = neardup.similarity(r[:1], r[1:], np.array([1000.0]), np.array([1000.0]))[0]
    assert abs(est - 900 / 1100) < 0.2
    merged = neardup.registers(np.concatenate([a, b]), np.array([0]))
    assert (merged == r.max(0)).all()


def test_components_of_a_long_path(spark):
    edges = spark.range(1, 60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {tuple(r) for r in components(edges).collect()} == {(i, 1) for i in range(1, 61)}


def brute_quality(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    grams = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    n = Counter(grams)
    repeat = len({p for k, g in enumerate(grams) if n[g] > 1 for p in range(k, k + 5)})
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), repeat, len(w) < 10 or 100 * repeat > 20 * len(w))


@pytest.mark.parametrize("which", ["odd", "real"])
def test_quality(which, request):
    docs = request.getfixturevalue(which)
    got = quality.judge(docs).collect()
    text = dict(pairs(docs))
    assert len(got) == docs.count()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_quality(text[r.doc_id])
        assert not (r.base_failed and r.kept)
    if which == "real":
        assert sum(r.kept for r in got) > 0.7 * len(got)


def test_distance_of_histograms(spark):
    df = spark.createDataFrame([([1, 1, 0], [1, 1, 0]), ([1, 0, 0], [0, 1, 0]), ([0, 0, 0], [1, 0, 0])], "a array<long>, b array<long>")
    assert [round(r[0], 6) for r in df.select(quality.distance(F.col("a"), F.col("b"))).collect()] == [0.0, 1.0, 0.0]


def test_toxicity_on_held_out_labels(spark):
    rng = np.random.default_rng(7)
    vocab = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(500)]
    texts, labels = [], []
    for i in range(1500):
        bad = rng.random() < 0.2
        texts.append((i, " ".join([*rng.choice(vocab, 60), *(rng.choice(["zzidiot", "zzmoron"], 3) if bad else [])])))
        labels.append((i, int(bad)))
    texts += [(5000, None), (5001, ""), (None, "zzidiot")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    known = spark.createDataFrame([*labels, (None, 1), (9999, None)], "doc_id long, toxic int")
    got = by_id(toxicity.score(docs, toxicity.fit(docs, known)))
    held = {r.doc_id for r in docs.where(toxicity.held_out(F.col("doc_id"))).collect()}
    right = [(got[i].score >= 0.5) == bool(y) for i, y in labels if i in held]
    assert len(right) > 200 and np.mean(right) > 0.95
    assert got[5000].score == got[5001].score and all(0 <= r.score <= 1 for r in got.values())


def test_toxicity_without_documents(none, spark):
    model = toxicity.fit(none, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score(none, model).count() == 0


def brute_removal(rows, units, width, join):
    seen, out = set(), {}
    for i, t in sorted(((i, t) for i, t in rows if i is not None), key=lambda r: r[0]):
        if i in out:
            continue
        u = units(t or "")
        own = [u[k : k + width] if isinstance(u, bytes) else tuple(u[k : k + width]) for k in range(len(u) - width + 1)]
        cut = np.zeros(len(u), bool)
        for k, x in enumerate(own):
            if x in seen:
                cut[k : k + width] = True
        seen.update(own)
        spans = int(np.sum(np.diff(np.concatenate([[0], cut.astype(int)])) == 1))
        out[i] = (len(u), int(cut.sum()), spans, hashlib.sha256(join([u[k : k + 1] if isinstance(u, bytes) else u[k] for k in np.flatnonzero(~cut)])).hexdigest())
    return out


@pytest.mark.parametrize("which", ["odd", "real"])
def test_passages(which, request):
    docs = request.getfixturevalue(which)
    got = substrings.digest(substrings.remove_passages(docs)).collect()
    want = brute_removal(pairs(docs), WORD.findall, 13, lambda x: " ".join(x).encode())
    assert len(got) == docs.count()
    assert all((r.n_words, r.n_removed, r.kept_sha256) == (want[r.doc_id][0], want[r.doc_id][1], want[r.doc_id][3]) for r in got if r.doc_id is not None)


@pytest.mark.parametrize("which", ["odd", "real"])
def test_byte_strings(which, request):
    docs = request.getfixturevalue(which)
    got = bwt.remove_strings(docs).collect()
    want = brute_removal(pairs(docs), str.encode, 50, b"".join)
    assert len(got) == docs.count()
    assert all((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id] for r in got if r.doc_id is not None)


@pytest.mark.parametrize("which", ["words", "bytes"])
def test_anchor_with_many_contexts(spark, which):
    """A phrase that anchors other text in every document: right results, and no comparison grows with their number."""
    rng = np.random.default_rng(6)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    make = lambda n, size: ["".join(x) for x in rng.choice(letters, (n, size))]
    if which == "words":
        unit, match, side, glue, count = repeats.WORDS, substrings.match, 8, " ", 10_000
        phrases, pool = [" ".join(make(5, 4)) for _ in range(20_000)], [" ".join(make(side, 4)) for _ in range(600)]
    else:
        unit, match, side, glue, count = repeats.BYTES, bwt.match, 30, "", 18_000
        phrases, pool = make(20_000, 20), make(300, side)
    hashes = [unit.of([x.encode()], unit.k)[2][0] for x in phrases]
    phrase = phrases[int(np.argmin(hashes))]
    rows = [(i, glue.join([pool[a], phrase, pool[b]])) for i, (a, b) in enumerate(rng.integers(0, len(pool), (count, 2)).tolist())]
    limit = 1 << 20

    def bounded(bodies, docs):
        assert sum(map(len, bodies)) <= limit
        return match(bodies, docs)

    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.copy, repeats.spans(r["at"], unit.width)) for r in repeats.removals(docs, unit, bounded).collect()}
    want = brute_removal(rows, *((WORD.findall, 13, lambda x: " ".join(x).encode()) if which == "words" else (str.encode, 50, b"".join)))
    for i, (n, removed, _, _) in want.items():
        copy, (begin, end) = got[i]
        assert (n if copy else int((end - begin).sum())) == removed
    assert sum(removed > 0 for _, removed, _, _ in want.values()) > count / 2


def test_window_minima_of_both_matchers():
    rng = np.random.default_rng(3)
    words = [rng.integers(0, 3, n).astype(np.int64) for n in (40, 13, 25, 60)]
    docs = np.array([7, 3, 9, 5])
    first = {}
    for w, d in zip(words, docs):
        for k in range(len(w) - 12):
            x = tuple(w[k : k + 13])
            first[x] = min(first.get(x, d), d)
    for w, mins in zip(words, substrings.match([w.tobytes() for w in words], docs)):
        assert [first[tuple(w[k : k + 13])] for k in range(len(w) - 12)] == list(mins)
    bodies = [bytes(rng.integers(0, 2, n).astype(np.uint8)) for n in (70, 50, 300)] * 2
    docs = np.array([8, 2, 6, 4, 9, 1])
    first = {}
    for b, d in zip(bodies, docs):
        for k in range(len(b) - 49):
            first[b[k : k + 50]] = min(first.get(b[k : k + 50], d), d)
    for b, mins in zip(bodies, bwt.match(bodies, docs)):
        assert [first[b[k : k + 50]] for k in range(len(b) - 49)] == list(mins)


@pytest.mark.parametrize("length", [3, 4, 6])
def test_common_prefixes_of_merged_transforms(length):
    texts = [b"banana", b"ananas", b"bandana", b"ananas", b"b"]
    places, bwts, maps, at = [], [], [], 0
    for t in texts:
        order, b, lf = bwt.transform(np.append(np.frombuffer(t, np.uint8) + np.uint8(1), np.uint8(0)))
        places.append(order + at), bwts.append(b), maps.append(lf + at)
        at += len(t) + 1
    order, common = bwt.merged(np.concatenate(bwts), np.concatenate(maps), length)
    # rounds go on over the end of a text to the text before it in the same shard, which is itself here
    joined = [(t + b"\0") * 8 for t in texts]
    starts = np.cumsum([0] + [len(t) + 1 for t in texts])
    suffixes = []
    for p in np.concatenate(places)[order]:
        shard = int(np.searchsorted(starts, p, "right")) - 1
        suffixes.append(joined[shard][p - starts[shard] :][:length])
    assert suffixes == sorted(suffixes)
    for i in range(1, len(suffixes)):
        shared = next((k for k in range(length) if suffixes[i][k] != suffixes[i - 1][k]), length)
        assert common[i] == (length if shared == length else max(shared - (shared - length) % 2, 0))


@pytest.mark.parametrize("text", [b"", b"a", b"abababababababababab", b"x" * 40, bytes(range(1, 200)) * 2])
def test_suffix_array(text):
    text = np.concatenate([np.frombuffer(text, np.uint8), [0], np.frombuffer(text[3:], np.uint8), [0]]).astype(np.uint8)
    ends = np.flatnonzero(text == 0)
    key = lambda i: (text[i : ends[np.searchsorted(ends, i)] + 1].tobytes(), i)
    assert bwt.suffixes(text).tolist() == sorted(range(len(text)), key=key)


@pytest.mark.parametrize("k", [1, 5])
def test_top_k(spark, k):
    rng = np.random.default_rng(5)
    data = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(300)]
    data += [(1000 + i, [0.5] * 8) for i in range(40)] + [(2000, None), (2001, [float("nan")] * 8), (2050, [1.0, None] + [0.0] * 6), (None, [1.0] * 8), (3000, [1.0, 2.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in topk.top_k(df, F.col("id") % 50 == 0, k).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    valid = [(i, np.floor(np.array(v) * 256)) for i, v in data if i is not None and v and None not in v and np.isfinite(v).all()]
    for q, v in valid:
        if q % 50 == 0:
            best = sorted((-int(v @ w), i) for i, w in valid if i != q and len(w) == len(v))[:k]
            assert sorted(got.get(q, [])) == [(n, i, -s) for n, (s, i) in enumerate(best, 1)]


def test_mixing(odd, real, none):
    for docs in (odd, real):
        got = mixing.copies_per_document(docs).collect()
        assert len(got) == docs.count()
        size, target = {}, {}
        for r in got:
            size[r.source], target[r.source] = r.source_size, r.target
            assert 0 <= r.copies <= 2
        assert all(target[s] <= 2 * size[s] + 1e-6 for s in size)
        assert abs(sum(target.values()) - 1.5 * sum(size.values())) < 1e-6 * max(1, sum(size.values()))
        assert mixing.mix(docs).count() == sum(r.copies for r in got)
    assert mixing.copies_per_document(none).count() == 0 and mixing.mix(none).columns == none.columns


def brute_license(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    at, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        for k in range(len(w)):
            if w[k : k + len(p)] == p:
                at.append(k)
                labels.add(label)
    return (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels)))


@pytest.mark.parametrize("which", ["odd", "real"])
def test_licenses(which, request):
    docs = request.getfixturevalue(which)
    text, got = dict(pairs(docs)), licenses.scan(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_license(text[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
    if which == "odd":
        assert {r.doc_id: r.labels for r in got}[15] == "cc-by-nc"


def test_licenses_of_several_notices_and_of_long_prose(spark):
    """Every notice counts, however many stand in one text and whatever rare licence words its prose holds."""
    notice = {label: text for label, _, text in licenses.NOTICES}
    prose = "one may obtain modified source forms by redistribution under international terms creative commons granted hereby mozilla subject charge " * 40
    texts = {
        1: " ".join(text for _, _, text in licenses.TEMPLATES), 2: f"{notice['mit']} {notice['apache']} {notice['bsd']}",
        3: f"{prose}{notice['bsd']} {prose}", 4: " ".join([notice["mpl"]] * 300), 5: prose,
    }
    texts |= {100 + 10 * i + k: f"filler {text} filler" for i, (_, _, text) in enumerate(licenses.TEMPLATES) for k in range(5)}
    docs = spark.createDataFrame([*texts.items(), *[(1000 + i, f"plain words {i}") for i in range(900)]], "doc_id long, text string")
    got = by_id(licenses.scan(docs))
    every = ",".join(sorted({label for label, _, _ in licenses.TEMPLATES}))
    assert {i: got[i].labels for i in range(1, 6)} == {1: every, 2: "apache,bsd,mit", 3: "bsd", 4: "mpl", 5: ""}
    assert all(label in got[100 + 10 * i].labels.split(",") for i, (label, _, _) in enumerate(licenses.TEMPLATES))
    assert got[3].score == pytest.approx(1.0)


def brute_labels(texts, templates):
    """Labels and best cover per text by trying every shift of every template."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    tokens = {i: word.findall((x or "").translate(LOWER)) for i, x in texts.items()}
    vocab = {w for _, _, t in templates for w in t.split()} - set(licenses.PLAIN)
    seen = Counter(w for ws in tokens.values() for w in set(ws) & vocab)
    idf = {w: math.log((1 + len(texts)) / (1 + seen[w])) + 1e-9 for w in vocab}
    out = {}
    for i, ws in tokens.items():
        found, best = set(), 0.0
        for label, key, text in templates:
            t, k = text.split(), key.split()
            rare = sorted(set(t) & vocab, key=lambda w: (-idf[w], w))[: licenses.RARE_PER_TEMPLATE]
            offset = next(p for p in range(len(t)) if t[p : p + len(k)] == k)
            for shift in range(-len(t), len(ws)):
                if shift + offset < 0 or ws[shift + offset : shift + offset + len(k)] != k:
                    continue
                hit = {w for p, w in enumerate(t) if w in rare and 0 <= shift + p < len(ws) and ws[shift + p] == w}
                cover = sum(idf[w] for w in hit) / sum(idf[w] for w in rare)
                if cover >= licenses.MIN_COVER:
                    found.add(label)
                    best = max(best, cover)
        out[i] = (found, best)
    return out


def test_licenses_labels_and_score_against_every_shift(spark):
    """Whole notices, notices cut short or with words changed, key phrases alone, links, templates of the caller."""
    rng = random.Random(3)
    texts = {0: None, 1: "", 2: "LİCENSED UNDER THE APACHE LICENSE \u212a", 3: "See https://creativecommons.org/licenses/by-sa/4.0/ and CC BY NC."}
    for n, (_, key, text) in enumerate(licenses.TEMPLATES):
        ws = text.split()
        texts[10 + n] = f"Some prose, then {text.upper()}. More prose."
        texts[60 + n] = " ".join(w if rng.random() < 0.6 else "other" for w in ws)
        texts[110 + n] = f"{key} " * 3
        texts[160 + n] = f"{' '.join(ws[: len(ws) // 2])} {key} {' '.join(ws[len(ws) // 3 :])}"
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for templates in (licenses.TEMPLATES, [("own", "house rules apply", "the house rules apply to every guest of this place"), *licenses.NOTICES[:2]]):
        want = brute_labels(texts, templates)
        for r in licenses.scan(docs.withColumn("votes", F.lit(1)), templates).collect():
            base = set(filter(None, r.base_labels.split(",")))
            assert set(filter(None, r.labels.split(","))) == want[r.doc_id][0] | base
            assert r.score == pytest.approx(1.0 if base else want[r.doc_id][1])
    assert licenses.scan(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        licenses.scan(docs, [("bad", "not there", "some wording")])


@pytest.mark.parametrize("which", ["odd", "real"])
def test_packing(which, request):
    docs = request.getfixturevalue(which)
    encode = packing.encoder(rank_file()).encode_ordinary
    want = Counter()
    for i, t in pairs(docs):
        ids = np.array([*encode(t or ""), 1], "<u4")
        want.update((i, k, len(ids[k : k + 2048]), zlib.crc32(ids[k : k + 2048].tobytes()), len(ids)) for k in range(0, len(ids), 2048))
    got = packing.pack(docs, rank_file()).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    windows = defaultdict(list)
    for r in got:
        windows[r.sequence_id].append(r)
    for pieces in windows.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048


def test_short_tiers_are_packed_from_several_rests(spark):
    lengths = {250: 40, 6: 40, 300: 10, 212: 10, 700: 5, 200: 5, 124: 5, 1500: 3, 548: 3, 256: 2, 2048 + 90: 1}
    texts = [" ".join(["the"] * (n - 1)) for n, c in lengths.items() for _ in range(c)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    windows = defaultdict(list)
    for r in packing.pack(docs, rank_file()).collect():
        assert r.doc_tokens in lengths
        windows[r.sequence_id].append(r)
    by_tier = defaultdict(list)
    for pieces in windows.values():
        (tier,) = {r.tier for r in pieces}
        assert sorted(r.offset for r in pieces) == list(np.cumsum([0] + [r.length for r in sorted(pieces, key=lambda r: r.offset)])[:-1])
        by_tier[tier].append(sorted(r.length for r in pieces))
    assert sum(map(len, windows.values())) == len(texts) + 1
    assert all(sum(x) == tier for tier in (256, 512, 1024) for x in by_tier[tier])
    assert by_tier[256].count([6, 250]) == 40 and by_tier[256].count([256]) == 2 and by_tier[512].count([212, 300]) == 10 and by_tier[1024].count([124, 200, 700]) == 5
    assert by_tier[2048].count([548, 1500]) == 3


def test_same_ids_as_the_other_vocabulary_file():
    import public_tokenizers
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    other.encode_special_tokens = True
    for text in ["", "Hello  world\n\n naïve 12,5 \U0001f600", "a" * 500, "<|endoftext|> x", " \t\x00 "]:
        assert packing.encoder(rank_file()).encode_ordinary(text) == other.encode(text, add_special_tokens=False).ids


def test_word_hashes_match_words():
    texts = ["", "one  two\tthree", "é x", "one"]
    w = rolling.Words([t.encode() for t in texts])
    raw = w.buf.tobytes()
    assert [raw[a:b].decode() for a, b in zip(w.start, w.end)] == [x for t in texts for x in WORD.findall(t)]
    assert w.hash[0] == w.hash[-1] and len(set(w.hash.tolist())) == 5


def test_empty_tables(none):
    for df in (
        sharding.shard_by_bytes(none), neardup.near_duplicates(none), quality.judge(none), substrings.remove_passages(none), bwt.remove_strings(none),
        licenses.scan(none), packing.pack(none, rank_file()), topk.top_k(none.selectExpr("doc_id as vec_id", "array(1.0D) as embedding"), F.col("id") % 50 == 0),
    ):
        assert df.count() == 0


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_oracle(name, spark, duck, data_dir):
    assert compare(QUERIES[name](spark, data_dir), duck, ORACLE_SQL[name]) is None


def test_pipeline(spark, data_dir):
    import corpus_pipeline as p
    from storeops.llm.common import store, table

    docs, seen = table(spark, data_dir, "documents"), []
    for name, stage in p.STAGES:
        before, docs = docs, store(stage(spark, docs, data_dir), "stage")
        seen.append((before, docs))
    assert all(out.columns == p.COLUMNS for _, out in seen[:-1])
    near_in, near_out = seen[1]
    kept = {i for i, (_, _, k) in brute_near(pairs(near_in), 5).items() if k}
    assert {r.doc_id for r in near_out.select("doc_id").collect()} == kept
    cut_in, cut_out = seen[2]
    want = brute_removal(pairs(cut_in), WORD.findall, 13, lambda x: " ".join(x).encode())
    assert all(hashlib.sha256(" ".join(WORD.findall(t)).encode()).hexdigest() == want[i][3] for i, t in pairs(cut_out))
    assert {r.doc_id for r in seen[4][1].select("doc_id").collect()} == {r.doc_id for r in seen[3][1].select("doc_id").collect()}


def test_texts_leave_a_batch_chunk_by_chunk():
    """A batch of 24 chunks never has all its texts beside it; nulls are empty, and sizes are counted in bytes."""
    texts = ["é" * (rolling.CHUNK // 8)] * 96 + [None, "", "a\x00b"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    tracemalloc.start()
    got, at = 0, 0
    for first, end, part in rolling.text_chunks(batch):
        assert first == at and part == [(x or "").encode() for x in texts[first:end]] and (end - first == 1 or sum(map(len, part)) <= rolling.CHUNK)
        got, at = got + len(part), end
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == at == len(texts) and peak < 6 * rolling.CHUNK
