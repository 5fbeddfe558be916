"""Components: stars end the rounds, any shape ends in its smallest nodes."""

import random

import pytest

from storeops.llm import graph


def smallest(edges):
    root = {x: x for e in edges for x in e if e[0] != e[1]}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = top(a), top(b)
            root[max(a, b)] = min(a, b)
    return {x: top(x) for x in root}


def found(spark, edges):
    got = [tuple(r) for r in graph.components(spark.createDataFrame(edges, "a long, b long")).select("node", "component").collect()]
    assert len(got) == len({n for n, _ in got})
    return dict(got)


@pytest.fixture
def rounds(monkeypatch):
    """Names of what the rounds write."""
    names, write = [], graph.store
    monkeypatch.setattr(graph, "store", lambda df, name: (names.append(name), write(df, name))[1])
    return names


def test_stars_need_no_round(spark, rounds):
    edges = [(1, x) for x in range(2, 40)] + [(-5, -3), (-3, -5), (7000, 7000), (50, 60), (50, 60)]
    assert found(spark, edges) == smallest(edges)
    assert len(rounds) == 1


def test_no_edges(spark, rounds):
    assert found(spark, [(3, 3)]) == {} and len(rounds) == 1


def test_a_path_ends_when_it_is_a_star(spark, rounds):
    edges = [(x, x + 1) for x in range(3)]
    assert found(spark, edges) == smallest(edges)
    assert len(rounds) <= 3


@pytest.mark.parametrize("seed", range(3))
def test_any_shape(spark, seed):
    draw = random.Random(seed)
    nodes = [draw.randrange(-(2**62), 2**62) for _ in range(60)]
    edges = [(draw.choice(nodes), draw.choice(nodes)) for _ in range(20 + 20 * seed)] + list(zip(nodes[:15], nodes[1:15]))
    assert found(spark, edges) == smallest(edges)
