"""Merkle manifest of a dataset, with proofs and with versions that path copying gives.

Every row is a leaf; the leaves of a source, in id order, are hashed in runs of 16 until one node is left, its subroot, and
the subroots likewise give the root.  The tree is built by aligned blocks of 16^3 nodes: one task hashes the three levels
inside a block, and the roots of the blocks are the nodes of the next tier, 4096 times fewer.  Each block then learns its
path, the sibling digests from its root up to the root of the dataset, tier by tier from the top.

A block is a persistent tree: changing a leaf makes a version that copies only the ancestors of this leaf and shares all
other nodes, and which goes on over the path of the block through the upper tiers.  No version ever copies a block.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeops.functions.ranks import ranked
from storeops.llm.common import store

FAN = 16
LEVELS = 3  # of a block
BLOCK = FAN**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER = 5  # rows whose id has a checksum divisible by this are tampered with


def joined(digests: list[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


class Block:
    """The levels of hashes over up to BLOCK consecutive nodes, the first of which has index ``start`` in its tree.

    A tree with more than one block has all its blocks three levels high; a tree of one block stops at a single node.
    """

    def __init__(self, start: int, digests: list[str]):
        self.levels = [digests]
        while len(self.levels) <= LEVELS and (start > 0 or len(self.levels[-1]) > 1):
            below = self.levels[-1]
            self.levels.append([joined(below[i : i + FAN]) for i in range(0, len(below), FAN)])

    @property
    def root(self) -> str:
        return self.levels[-1][0]

    def siblings(self, i: int) -> list[str]:
        """The joined siblings left and right of a node, then of each of its ancestors."""
        out = []
        for level in self.levels[:-1]:
            run = i - i % FAN
            out += ["".join(level[run:i]), "".join(level[i + 1 : run + FAN])]
            i //= FAN
        return out


class Version:
    """A block with one leaf changed: ``copied`` holds the new leaf and its new ancestors, all other nodes are the block's."""

    def __init__(self, siblings: list[str], leaf: str):
        self.copied = [leaf]
        for left, right in zip(siblings[::2], siblings[1::2]):
            self.copied.append(joined([left, self.copied[-1], right]))

    def going_on(self, path: list[str]) -> str:
        """The root of the dataset in this version, by copying on along the siblings above the block."""
        return Version(path, self.copied[-1]).copied[-1]


def leaf_digest(text: Column, fields: tuple[str, ...] = FIELDS) -> Column:
    """SHA-256 of the fields, each as `-` or byte count, colon, value; ``text`` stands for the column of that name."""
    parts = []
    for name in fields:
        value = text if name == "text" else F.col(name).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def tampered_text() -> Column:
    return F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def is_tampered() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER == 0, F.lit(False))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[dict], list[str]]]:
    """The rows of each block and its path, from batches sorted by (tree, block, at); the row at -1 brings the path."""
    key, path, held = None, [], []
    for batch in batches:
        for row in batch.to_pylist():
            now = (row["tree"], row["block"])
            if now != key:
                if held:
                    yield held, path
                key, path, held = now, [], []
            if row["at"] < 0:
                path = row["path"]
            else:
                held.append(row)
    if held:
        yield held, path


def _dealt(nodes: DataFrame, paths: DataFrame | None = None) -> DataFrame:
    """The nodes of a tier by block, each block in index order in one task and led by its path, if there are paths."""
    rows = nodes.withColumns({"block": F.shiftright("at", 12), "path": F.lit(None).cast("array<string>")})
    if paths is not None:
        rows = rows.unionByName(paths.select("tree", "block", F.lit(-1).cast("long").alias("at"), "path"), allowMissingColumns=True)
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "at")


def block_roots(nodes: DataFrame) -> DataFrame:
    """The next tier: tree, at (the number of the block), digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for rows, _ in _blocks(batches):
            root = Block(rows[0]["at"], [r["digest"].hex() for r in rows]).root
            out.append((rows[0]["tree"], rows[0]["block"], bytes.fromhex(root)))
            if len(out) >= 1000:
                yield _batch(out)
                out = []
        yield _batch(out)

    def _batch(out: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*out)) or [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.binary()))], ["tree", "at", "digest"])

    return _dealt(nodes.select("tree", "at", "digest")).mapInArrow(run, "tree string, at long, digest binary")


def climb(nodes: DataFrame, name: str) -> list[DataFrame]:
    """The stored tiers above ``nodes``, up to the one where every tree has one node."""
    tiers = [store(block_roots(nodes), name)]
    while tiers[-1].where("at > 0").head(1):
        tiers.append(store(block_roots(tiers[-1]), name))
    return tiers


def lower_paths(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """tree, block, path of the blocks whose roots are ``nodes``, from the paths (tree, block, path) of the nodes' own blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, path in _blocks(batches):
            block = Block(rows[0]["at"], [r["digest"].hex() for r in rows])
            for a in range(0, len(rows), 64):
                some = rows[a : a + 64]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["tree"] for r in some], pa.string()), pa.array([r["at"] for r in some], pa.int64()), pa.array([block.siblings(a + i) + path for i in range(len(some))], pa.list_(pa.string()))],
                    ["tree", "block", "path"],
                )

    return _dealt(nodes, paths).mapInArrow(run, "tree string, block long, path array<string>")


def leaves(docs: DataFrame) -> DataFrame:
    """tree (the source), at (position from 0), doc_id, digest, changed (the digest after tampering; null: not tampered with)."""
    digest = leaf_digest(F.col("text"))
    named = docs.select(
        F.col("source").alias("tree"), "doc_id", digest.alias("digest"),
        F.when(is_tampered(), leaf_digest(tampered_text())).alias("changed"), F.monotonically_increasing_id().alias("row"),
    )
    rows = store(named, "merkle_leaves")
    numbered = ranked(rows, ["tree"], [F.col("doc_id"), F.col("digest"), F.col("row")], "at")
    return store(numbered.select("tree", (F.col("at") - 1).cast("long").alias("at"), "doc_id", "digest", "changed"), "merkle_positions")


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row of ``docs`` (the columns in FIELDS).

    The leaves of a source are in the order of doc_id, rows without id first and rows that share an id by digest; null is a
    source of its own, before all others.  Null fields hash as `-`, empty texts as a value of no bytes.  A long text is
    hashed whole.  Equal rows have equal digests, each with a place and a proof of its own.  Rows without id are not
    tampered with, nor does tampering change a text without A-Z: those verify.  An empty table has no rows and no root.
    Other columns are not looked at.
    """
    first = leaves(docs)
    tiers = climb(first, "merkle_tier")
    sources = tiers[-1].select(F.col("tree").alias("source"), "digest")
    ordered = ranked(sources, [], [F.col("source")], "at").select(F.lit("").alias("tree"), (F.col("at") - 1).cast("long").alias("at"), "digest", "source")
    top = store(ordered, "merkle_subroots")
    tops = climb(top, "merkle_top")
    none = F.array().cast("array<string>")
    paths = tops[-1].select("tree", F.col("at").alias("block"), none.alias("path"))  # the root: no siblings
    for tier in reversed(tops[:-1]):
        paths = store(lower_paths(tier, paths), "merkle_paths")
    above = lower_paths(top, paths).select(F.col("block").alias("at"), "path")
    paths = store(above.join(top.select("at", "source"), "at").select(F.col("source").alias("tree"), F.lit(0).cast("long").alias("block"), "path"), "merkle_paths")
    # the steps inside a source come before those above it, so the number of the latter tells them apart
    steps = paths.select("tree", F.size("path").alias("top_steps"))
    for tier in reversed(tiers[:-1]):
        paths = store(lower_paths(tier, paths), "merkle_paths")
    with_steps = paths.alias("p").join(steps.alias("s"), F.expr("p.tree <=> s.tree")).select("p.tree", "block", F.concat("path", F.array(F.col("top_steps").cast("string"))).alias("path"))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    kind = pa.int64() if docs.schema["doc_id"].dataType.simpleString() == "bigint" else None

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, path in _blocks(batches):
            path, top_steps = path[:-1], int(path[-1])
            inside, above = path[: len(path) - top_steps], path[len(path) - top_steps :]
            block = Block(rows[0]["at"], [r["digest"].hex() for r in rows])
            subroot = Version(inside, block.root).copied[-1]
            root = Version(above, subroot).copied[-1]
            rest = "".join(path).encode()
            out = []
            for i, row in enumerate(rows):
                own = block.siblings(i)
                proof = sha256("".join(own).encode() + rest).hexdigest()
                leaf = block.levels[0][i]
                # the original leaf is folded as well: a proof that did not lead to the root would show
                folded = Version(own, row["changed"].hex() if row["changed"] else leaf).going_on(path)
                out.append((row["doc_id"], leaf, subroot, root, proof, folded, folded == root))
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], kind), *map(pa.array, cols[1:])], ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return _dealt(first, with_steps).mapInArrow(prove, schema)


def oracle(levels: int = 6) -> str:
    """DuckDB SQL of the manifest, for sources of up to 16^levels rows and as many sources."""

    def tree(name: str, part: str) -> str:
        """Levels name_0 … of digests by ``part``, and the siblings met on the way, for each leaf (id)."""
        out = []
        for k in range(levels):
            out.append(f"""{name}_{k + 1} AS (
  SELECT part, CASE WHEN n > 1 THEN pos // 16 ELSE pos END AS pos, CASE WHEN n > 1 THEN sha256(string_agg(d, '' ORDER BY pos)) ELSE any_value(d) END AS d,
    CASE WHEN n > 1 THEN (n + 15) // 16 ELSE n END AS n
  FROM {name}_{k} GROUP BY part, CASE WHEN n > 1 THEN pos // 16 ELSE pos END, n)""")
        return ",\n".join(out)

    def walk(name: str, start: str, out: str) -> str:
        """Folds (row, part, pos, proof, folded) up the tree."""
        steps = [f"{out}_0 AS ({start})"]
        for k in range(levels):
            steps.append(f"""{out}_{k + 1} AS (
  SELECT w.row, w.part, CASE WHEN any_value(t.n) > 1 THEN w.pos // 16 ELSE w.pos END AS pos,
    w.proof || coalesce(string_agg(t.d, '' ORDER BY t.pos) FILTER (t.pos <> w.pos), '') AS proof,
    CASE WHEN any_value(t.n) > 1 THEN sha256(string_agg(CASE WHEN t.pos = w.pos THEN w.folded ELSE t.d END, '' ORDER BY t.pos)) ELSE w.folded END AS folded
  FROM {out}_{k} w JOIN {name}_{k} t ON t.part IS NOT DISTINCT FROM w.part AND t.pos // 16 = w.pos // 16
  GROUP BY w.row, w.part, w.pos, w.proof, w.folded)""")
        return ",\n".join(steps)

    def leaf(text: str) -> str:
        fields = [text if f == "text" else f"{f}::VARCHAR" for f in FIELDS]
        return "sha256(" + " || ".join(f"coalesce(octet_length(encode({f}))::VARCHAR || ':' || {f}, '-')" for f in fields) + ")"

    crc = f"""xor(list_reduce(list_transform(range(length(doc_id::VARCHAR)), lambda i: ascii(substr(doc_id::VARCHAR, i + 1, 1))::BIGINT),
    lambda a, b: xor(crc_table.l[(xor(a, b) & 255) + 1], a >> 8), 4294967295), 4294967295) % {TAMPER} = 0"""
    return f"""
WITH RECURSIVE shifts(i, c, k) AS (
  SELECT i, i, 0 FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM shifts WHERE k < 8
), crc_table AS (SELECT list(c ORDER BY i) AS l FROM shifts WHERE k = 8),
base AS MATERIALIZED (
  SELECT doc_id, source, {leaf('text')} AS leaf,
    CASE WHEN {crc} THEN {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS changed
  FROM documents, crc_table),
placed AS MATERIALIZED (
  SELECT *, row_number() OVER () AS row, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM base),
low_0 AS (SELECT source AS part, pos, leaf AS d, n FROM placed),
{tree('low', 'source')},
subroots AS MATERIALIZED (SELECT part AS source, d AS subroot, row_number() OVER (ORDER BY encode(part) NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM low_{levels}),
top_0 AS (SELECT 0 AS part, pos, subroot AS d, n FROM subroots),
{tree('top', '0')},
{walk('low', "SELECT row, source AS part, pos, '' AS proof, coalesce(changed, leaf) AS folded FROM placed", 'up')},
{walk('top', f"SELECT u.row, 0 AS part, s.pos, u.proof, u.folded FROM up_{levels} u JOIN subroots s ON s.source IS NOT DISTINCT FROM u.part", 'over')}
SELECT p.doc_id, p.leaf, s.subroot, t.d AS root, sha256(o.proof) AS proof_sha256, o.folded AS folded_root, o.folded = t.d AS verified
FROM placed p JOIN over_{levels} o USING (row) JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source, top_{levels} t"""
