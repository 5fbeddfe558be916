"""Near-duplicate documents with SetSketch registers.

Registers hold exponentially spaced, truncated minima of a document's shingle hashes.  Documents that agree in a band of
four registers are candidates; the joint likelihood of the registers estimates their similarity, and what may reach the
threshold is verified on the full shingle sets.  Equal sets are one node from the start.  Inside a band every node is
first compared with the band's smallest; in bands that still hold several components, the nodes outside the largest one
are compared with a second member of it, and only those that stay apart meet all others, in blocks that give no more links
than they have members.  A large group of alike documents so costs a few comparisons per member.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeops.functions.ranks import ranked
from storeops.llm.common import store, whole
from storeops.llm.graph import components
from storeops.llm.rolling import Words, fold_unique, runs, text_chunks

M = 96  # registers
BAND = 4  # registers per band: at similarity 0.8 all 24 bands differ once in 300,000 pairs
B, A, Q = 1.001, 20.0, (1 << 16) - 2  # base, rate and limit of the registers
SHINGLE = 4
PERCENT = 80
MARGIN = 0.2  # an estimate may fall this far (about five deviations) below the threshold and still be verified
BLOCK = 256  # members of a band compared at once
SENT_NODES = 2_000_000  # ids and checksums (16 bytes each) that may be sent to every task
_rng = np.random.default_rng(2)
_XOR = _rng.integers(0, 1 << 63, M, dtype=np.uint64)
_ODD = _rng.integers(0, 1 << 62, M, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(texts: list[bytes], k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (shingle hash, text) pairs ordered by text; a text of fewer than k words is one shingle, without words none."""
    w = Words(texts, lower=True)
    n = np.diff(w.first)
    h = runs(w.hash, k)
    inside = w.doc[: len(h)] == w.doc[k - 1 :] if len(h) else np.zeros(0, bool)
    values, owner = [h[inside]], [w.doc[: len(h)][inside]]
    for i in np.flatnonzero((n > 0) & (n < k)):
        mine = w.hash[w.first[i] : w.first[i + 1]]
        values.append(runs(np.append(mine, np.uint64(len(mine))), len(mine) + 1))
        owner.append(np.array([i]))
    return fold_unique(np.concatenate(values), np.concatenate(owner))


def registers(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """SetSketch registers of non-empty sets, each beginning at one of ``starts``."""
    out = np.empty((len(starts), M), np.uint16)
    scratch = np.empty_like(values)
    for i in range(M):
        np.bitwise_xor(values, _XOR[i], out=scratch)
        np.multiply(scratch, _ODD[i], out=scratch)
        least = np.minimum.reduceat(scratch, starts)
        x = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / A
        out[:, i] = np.clip(np.floor(1 - np.log(x) / np.log(B)), 0, Q + 1)
    return out


def sketches(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """doc_id, p (checksum of the text), set size, two checksums of the set, registers (null for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, texts in text_chunks(batch):
                v, o = shingles(texts, k)
                at = np.searchsorted(o, np.arange(len(texts) + 1))
                n = np.diff(at)
                has = np.flatnonzero(n)
                one, two, regs = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64), [None] * len(n)
                if len(has):
                    one[has] = np.add.reduceat(v, at[has])
                    two[has] = np.add.reduceat((v ^ (v >> np.uint64(31))) * np.uint64(0xA24BAED4963EE407), at[has])
                    for i, r in zip(has, registers(v, at[has])):
                        regs[i] = r.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, end - first), batch.column("p").slice(first, end - first), pa.array(n.astype(np.int64)), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(regs, pa.binary())],
                    ["doc_id", "p", "n", "one", "two", "regs"],
                )

    return docs.select("doc_id", "text", text_print()).mapInArrow(run, "doc_id long, p long, n long, one long, two long, regs binary")


def text_print() -> Column:
    """p: what tells texts of rows with one id apart."""
    return F.xxhash64(whole()).alias("p")


def band_keys(regs: np.ndarray) -> np.ndarray:
    """The key of each band of each row of registers."""
    bands = np.ascontiguousarray(regs).view(np.uint64).reshape(len(regs), -1)
    bands = (bands + np.arange(bands.shape[1], dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return bands ^ (bands >> np.uint64(32)) ^ (np.arange(bands.shape[1], dtype=np.uint64) << np.uint64(58))


def band_rows(nodes: DataFrame) -> DataFrame:
    """(band, node, n) for each band of each node; n is its set size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                bands = band_keys(np.frombuffer(b"".join(batch.column("regs").to_pylist()), np.uint16).reshape(-1, M))
                owner = pa.array(np.repeat(np.arange(len(bands)), bands.shape[1]))
                yield pa.RecordBatch.from_arrays([pa.array(bands.reshape(-1).view(np.int64)), batch.column("node").take(owner), batch.column("n").take(owner)], ["band", "node", "n"])

    return nodes.select("node", "n", "regs").mapInArrow(run, "band long, node long, n long")


def similarity(ru: np.ndarray, rv: np.ndarray, nu: np.ndarray, nv: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs of register rows with known set sizes, on a grid of steps of 0.01."""
    more, less = (ru > rv).sum(1)[:, None], (ru < rv).sum(1)[:, None]
    u = (nu / (nu + nv))[:, None]
    v = 1 - u
    j = np.linspace(0, 1, 101)[None, :] * np.minimum(u / v, v / u)
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (B - 1) / B) / np.log(B)
    up, down = p(u - v * j), p(v - u * j)
    log = lambda x: np.log(np.maximum(x, 1e-12))
    fit = more * log(up) + less * log(down) + (M - more - less) * log(1 - up - down)
    return j[np.arange(len(ru)), fit.argmax(1)]


def likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose estimated similarity may reach the threshold."""
    least = percent / 100 - MARGIN
    side = lambda c: nodes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("regs").alias(f"r_{c}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                r = [np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint16).reshape(-1, M) for c in ("r_a", "r_b")]
                n = [part.column(c).to_numpy().astype(float) for c in ("n_a", "n_b")]
                yield part.select(["a", "b"]).filter(pa.array(similarity(*r, *n) >= least))

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "r_a", "r_b").mapInArrow(run, "a long, b long")


def across(members: DataFrame, percent: int, exact: bool) -> DataFrame:
    """Comparison of different components inside a band, by blocks.

    ``members``: band, lead (the band's largest component), blocks, others (blocks of all members and of those outside
    lead), node, component, n, regs, and items if ``exact``.  Members outside lead meet all members; a pair is looked at in
    its first common band only.  Gives the nodes with a likely partner (node), or the links (a, b) that join components
    of a block, which are fewer than its members.
    """
    least = percent / 100 - MARGIN
    spread = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), (F.col(n) - 1).cast("int")))
    carried = ["band", "node", "component", "n", "regs"] + ["items"] * exact
    asking = members.where("component <> lead").withColumns({"i": spread("others"), "asks": F.lit(True)}).withColumn("j", every("blocks"))
    asked = members.withColumns({"j": spread("blocks"), "asks": F.lit(False)}).withColumn("i", every("others"))
    placed = asking.select("i", "j", "asks", *carried).union(asked.select("i", "j", "asks", *carried))

    def compare(part: pa.Table) -> pa.RecordBatch | None:
        node, comp, n = part["node"].to_numpy(), part["component"].to_numpy(), part["n"].to_numpy().astype(float)
        asks = part["asks"].to_numpy()
        regs = np.frombuffer(b"".join(part["regs"].to_pylist()), np.uint16).reshape(-1, M)
        keys = band_keys(regs)
        here = int(np.flatnonzero(keys[0].view(np.int64) == part["band"][0].as_py())[0])
        sets = [x.values.to_numpy() for x in part["items"]] if exact else []
        root = {c: c for c in np.unique(comp).tolist()}  # components joined so far

        def top(c: int) -> int:
            while root[c] != c:
                c = root[c]
            return c

        right, found, links = np.flatnonzero(~asks), set(), []
        for x in np.flatnonzero(asks):
            y = right[comp[right] != comp[x]]
            y = y[(keys[y] == keys[x]).argmax(1) == here]
            y = y[(regs[y] == regs[x]).mean(1) >= least - 0.1]
            if not len(y):
                continue
            near = similarity(np.repeat(regs[x : x + 1], len(y), 0), regs[y], np.full(len(y), n[x]), n[y])
            y = y[np.argsort(-near, kind="stable")][: int((near >= least).sum())]
            if not exact:
                found.update(node[y].tolist() + [int(node[x])] * bool(len(y)))
                continue
            for z in y:
                if top(comp[x]) != top(comp[z]):
                    common = len(np.intersect1d(sets[x], sets[z], assume_unique=True))
                    if 100 * common >= percent * (len(sets[x]) + len(sets[z]) - common):
                        root[top(comp[x])] = top(comp[z])
                        links.append((min(node[x], node[z]), max(node[x], node[z])))
        if exact:
            return pa.RecordBatch.from_arrays([pa.array([p[i] for p in links], pa.int64()) for i in (0, 1)], ["a", "b"])
        return pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.int64())], ["node"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("band", "i", "j")])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if held and any(held[0].column(c)[0] != batch.column(c)[a] for c in ("band", "i", "j")):
                    yield compare(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(a, b - a))
        if held:
            yield compare(pa.Table.from_batches(held))

    return placed.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j").mapInArrow(run, "a long, b long" if exact else "node long").distinct()


def mixed_bands(members: DataFrame, groups: DataFrame) -> DataFrame:
    """``members`` (band, node) of bands that hold several components, with component, lead, center (a member of lead), blocks, others."""
    placed = members.join(groups, "node", "left").select("band", "node", F.coalesce("component", "node").alias("component"))
    parts = placed.groupBy("band", "component").agg(F.count("*").alias("rows"), F.min_by("node", F.xxhash64("band", "node")).alias("center"))
    bands = parts.groupBy("band").agg(F.max(F.struct("rows", "component", "center")).alias("most"), F.sum("rows").alias("rows"), F.count("*").alias("parts")).where("parts > 1")
    sized = bands.select(
        "band", F.col("most.component").alias("lead"), F.col("most.center").alias("center"),
        F.ceil(F.col("rows") / BLOCK).alias("blocks"), F.ceil((F.col("rows") - F.col("most.rows")) / BLOCK).alias("others"),
    )
    return placed.join(sized, "band")


def full_sets(docs: DataFrame, wanted: DataFrame, repeated: DataFrame, k: int) -> DataFrame:
    """node, shingle set of the wanted nodes (node, doc_id, p), once each.

    Few wanted nodes go to the texts; from SENT_NODES on, the texts are dealt by node instead.  Texts move only for nodes
    whose (doc_id, p) several rows have (``repeated``).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, texts in text_chunks(batch):
                v, o = shingles(texts, k)
                at = np.searchsorted(o, np.arange(len(texts) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(first, end - first), pa.ListArray.from_arrays(pa.array(at), pa.array(v.view(np.int64)))], ["node", "items"])

    few = wanted.count() <= SENT_NODES
    many = store(wanted.join(repeated, ["doc_id", "p"], "left_semi"), "repeated_nodes")
    several = bool(many.head(1))

    def sets(nodes: DataFrame, once: bool) -> DataFrame:
        texts = docs.select("doc_id", "text", text_print()).join(F.broadcast(nodes) if few else nodes, ["doc_id", "p"])
        texts = texts.select("node", "text") if once else texts.groupBy("node").agg(F.first("text").alias("text"))
        return texts.mapInArrow(run, "node long, items array<long>")

    if not several:
        return sets(wanted, True)
    return sets(wanted.join(many.select("node"), "node", "left_anti"), True).union(sets(many, False))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (stored) with 100 * common >= percent * united elements.

    Up to SENT_NODES pairs go to the sets, so a set moves once for each pair it is b of, and once as a.
    """
    few = pairs.count() <= SENT_NODES
    sent = lambda df: F.broadcast(df) if few else df
    right = sets.join(sent(pairs), F.col("node") == F.col("b")).select("a", "b", F.col("items").alias("i_b"))
    left = sets.join(sent(pairs.select(F.col("a").alias("node")).distinct()), "node", "left_semi").select(F.col("node").alias("a"), F.col("items").alias("i_a"))
    common = F.size(F.array_intersect("i_a", "i_b"))
    return right.join(left, "a").where(100 * common >= percent * (F.size("i_a") + F.size("i_b") - common)).select("a", "b")


def near_duplicates(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, p for every row of ``docs`` (doc_id, text).

    Null, empty and blank texts have no shingles and link with nothing: each is its own component and kept.  A row without
    id is not linked: null component, kept.  Rows that share an id are judged each by its own text, which ``p``, the
    checksum of the text, tells apart; repeated rows get equal results.  Ties between equal sets go to the smallest id.  A
    long text counts whole, one at a time.  An empty table gives an empty result; other columns are not looked at.
    """
    all_sketches = store(sketches(docs, k), "sketches")
    linkable = all_sketches.where("n > 0 and doc_id is not null")
    first = F.min(F.struct("doc_id", "p")).alias("first")
    distinct = linkable.groupBy("one", "two", "n").agg(first, F.first("regs").alias("regs")).select("one", "two", "n", "regs", "first.*")
    nodes = store(distinct, "sketch_nodes")
    numbered = bool(nodes.groupBy("doc_id").count().where("count > 1").head(1))
    if numbered:  # an id that several sets begin with names none of them: they are numbered in the order of their ids
        nodes = store(ranked(nodes, [], [F.col(c) for c in ("doc_id", "one", "two", "n")], "node").withColumn("node", F.col("node").cast("long")), "sketch_nodes")
    else:
        nodes = nodes.withColumn("node", F.col("doc_id"))
    bands = store(band_rows(nodes), "bands")
    repeated = store(all_sketches.groupBy("doc_id", "p").count().where("count > 1").select("doc_id", "p"), "repeated_rows")
    first = F.min(F.struct("node", "n"))
    shared = bands.groupBy("band").agg(first["node"].alias("least"), first["n"].alias("least_n"), F.max("node").alias("most"), F.count("*").alias("rows")).where("least <> most")
    members = store(bands.join(shared, "band").select("band", "node", "n", "least", "least_n", "rows"), "band_members")
    # the smaller set over the larger one bounds the similarity: other pairs cannot link and their registers stay
    sized_alike = F.expr(f"node <> least and 100 * least(n, least_n) >= {percent} * greatest(n, least_n)")
    near = store(likely(members.where(sized_alike).select(F.col("least").alias("a"), F.col("node").alias("b")).distinct(), nodes, percent), "near_pairs")
    ends = lambda pairs: pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    named = nodes.select("node", "doc_id", "p")
    sets = store(full_sets(docs, store(ends(near).join(named, "node"), "wanted_nodes"), repeated, k), "shingle_sets")
    links = store(verified(near, sets, percent), "links")
    groups = store(components(links), "groups")
    crowded = members.where("rows > 2").select("band", "node")
    sized = nodes.select("node", "n", "regs")

    def joined(new: DataFrame) -> DataFrame:
        return store(components(groups.select(F.col("node").alias("a"), F.col("component").alias("b")).union(new)), "groups")

    def with_sets(wanted: DataFrame) -> DataFrame:
        missing = store(wanted.join(sets.select("node"), "node", "left_anti").join(named, "node"), "late_nodes")
        return sets.union(store(full_sets(docs, missing, repeated, k), "late_sets")) if missing.head(1) else sets

    # where a band still holds several components, those outside its largest are held against another member of that one
    mixed = mixed_bands(crowded, groups).where("component <> lead")
    second = mixed.select(F.least("center", "node").alias("a"), F.greatest("center", "node").alias("b")).distinct()
    late = store(likely(second.join(near, ["a", "b"], "left_anti"), nodes, percent), "late_pairs")
    if late.head(1):
        sets = with_sets(ends(late))
        groups = joined(verified(late, sets, percent))
    # what two stars leave apart is compared by blocks: first by registers alone, then by full sets where that may link
    left = mixed_bands(crowded, groups).join(sized, "node")
    active = store(across(left, percent, exact=False), "active_nodes")
    if active.head(1):
        sets = with_sets(active)
        groups = joined(across(left.join(active, "node").join(sets, "node"), percent, exact=True))
    lead = nodes.join(groups, "node", "left").select("one", "two", F.col("n").alias("m"), F.coalesce("component", "node").alias("component_id"))
    if numbered:
        ids = named.select(F.col("node").alias("component_id"), "doc_id")
        lead = lead.join(ids, "component_id").select("one", "two", "m", F.col("doc_id").alias("component_id"))
    rows = all_sketches.select("doc_id", "p", "n", "one", "two").alias("s").join(lead.alias("l"), F.expr("s.one = l.one and s.two = l.two and s.n = l.m and s.doc_id is not null"), "left")
    return rows.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.lit(True)).alias("kept"), "p",
    )
