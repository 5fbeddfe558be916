"""Only what may be repeated takes part in the transforms of op8; every window still gets its smallest document."""

import random

import numpy as np
import pytest

from storeops.llm import bwt


def _bodies(seed, letters):
    rng = random.Random(seed)
    text = lambda n: bytes(rng.choice(letters) for _ in range(n))
    base, out = text(400), []
    for kind in [0, 1, 2] * 12:
        a = rng.randint(0, 300)
        out.append((text(rng.randint(50, 120)), base[a : a + rng.randint(50, 100)], text(rng.randint(0, 20)) + base[a : a + 60] + b"x" * rng.randint(0, 70))[kind])
    return out, np.array([rng.randint(-5, 20) for _ in out])


@pytest.mark.parametrize("seed, letters", [(1, b"ab"), (2, b"ab"), (3, bytes(range(97, 123))), (4, "é€x".encode())])
def test_windows_get_the_smallest_document(seed, letters):
    bodies, docs = _bodies(seed, letters)
    least = {}
    windows = lambda b: [b[i : i + bwt.LENGTH] for i in range(len(b) - bwt.LENGTH + 1)]
    for b, d in zip(bodies, docs.tolist()):
        for w in windows(b):
            least[w] = min(d, least.get(w, d))
    got = bwt.match(bodies, docs)
    assert [g.tolist() for g in got] == [[least[w] for w in windows(b)] for b in bodies]
    assert [g.tolist() for g in bwt.smallest(bodies, docs)] == [g.tolist() for g in got]  # the transforms alone


def test_bodies_that_only_share_an_anchor_are_not_transformed(monkeypatch):
    rng = random.Random(7)
    text = lambda n: bytes(rng.choice(b"abcdefgh") for _ in range(n))
    anchor, shared, seen, transform = text(20), text(60), [], bwt.transform
    monkeypatch.setattr(bwt, "transform", lambda t: (seen.append(len(t)), transform(t))[1])
    bodies = [text(25) + anchor + text(25) for _ in range(200)]
    docs = np.arange(200)
    assert [set(g.tolist()) for g in bwt.match(bodies, docs)] == [{d} for d in range(200)] and not seen
    got = bwt.match(bodies + [text(30) + shared + text(30), shared + text(40)], np.append(docs, [900, 800]))
    assert sum(seen) == 2 * (60 + 1)  # the shared stretches and their ends
    assert got[200].tolist() == [900] * 30 + [800] * 11 + [900] * 30 and set(got[201].tolist()) == {800}
