"""Shards of segments: what is compared, in how many calls, and what batches may cut apart."""

import numpy as np
import pyarrow as pa
import pytest

from storeops.llm import bwt, repeats, rolling


class Frame:
    """Takes the place of a DataFrame and hands out the function given to mapInArrow."""

    def __getattr__(self, name):
        return lambda *a, **b: self

    def mapInArrow(self, run, schema):
        self.run = run
        return self


def found(rows, match, size=10_000):
    frame = Frame()
    repeats.matched(frame, match, repeats.BYTES, 1)
    h, doc, body, many = zip(*sorted(rows, key=lambda r: r[:2]))
    name = {rolling.Prefix(np.frombuffer(b, np.uint8)).of(np.array([0]), np.array([len(b)])).view(np.int64)[0]: b for b in body}
    table = pa.table({"h": pa.array(h, pa.int64()), "doc": pa.array(doc, pa.int64()), "body": pa.array(body, pa.binary()), "many": pa.array(many)})
    got = {}
    for out in frame.run(iter(table.to_batches(size))):
        for h, c, runs in zip(*[out.column(x).to_pylist() for x in ("h", "c", "runs")]):
            assert (h, name[c]) not in got
            got[h, name[c]] = [x["low"] for x in runs for _ in range(x["n"])]
    return got


def body(seed, n):
    return np.random.default_rng(seed).integers(97, 123, n, dtype=np.uint8).tobytes()


def test_segments_alone_at_their_anchor_do_not_fill_shards():
    lone = [(h, 7, body(h, 3000), False) for h in range(0, 100, 2)]  # 150,000 units
    pairs = [(h, doc, body(h, 60) + end, False) for h in range(1, 100, 2) for doc, end in ((3, b"x"), (9, b"y"))]
    calls = []

    def match(bodies, docs):
        calls.append(sum(map(len, bodies)))
        return bwt.match(bodies, docs)

    got = found(lone + pairs, match)
    assert sum(calls) == 100 * 61 and len(calls) <= 2  # the last anchor of a batch may go on in the next one
    # the later document of a pair has its first windows from the earlier one
    assert got == {(h, body(h, 60) + b"y"): [3] * 11 + [9] for h in range(1, 100, 2)}


@pytest.mark.parametrize("size", [1, 2, 5, 1000])
def test_batches_do_not_part_anchors(size):
    rng = np.random.default_rng(4)
    rows = []
    for h in range(-8, 8):
        whole = body(h + 100, 90)  # equal windows have equal anchors, so no text is at two
        for c in rng.choice(6, rng.integers(1, 5), replace=False).tolist():
            docs = rng.choice(50, rng.integers(1, 4), replace=False)
            rows += [(h, int(d), whole[c : c + 60 + 4 * (h % 3)], bool(rng.integers(2))) for d in docs]
    want = {}
    for h, b in {(r[0], r[2]) for r in rows}:
        own = [r for r in rows if (r[0], r[2]) == (h, b)]
        first = min(r[1] for r in own)
        lows = [min(r[1] for r in rows if r[0] == h and b[i : i + 50] in r[2]) for i in range(len(b) - 49)]
        if len(own) > 1 or own[0][3] or min(lows) < first:
            want[h, b] = lows
    assert found(rows, bwt.match, size) == want


def test_hashes_of_every_place():
    for n in (0, 3, 20, 400):
        p = rolling.Prefix(np.random.default_rng(n).integers(0, 256, n, dtype=np.uint8))
        at = np.arange(max(n - 19, 0))
        assert p.every(20).tolist() == p.of(at, at + 20).tolist()
