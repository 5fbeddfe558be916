"""The substitute queries list every pair of products, dealt to as many tasks as the pairs need."""

import random
from collections import Counter
from datetime import date
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from storeops.functions import pairs
from storeops.operators import market as mk
from storeops.plans import CATALOGUE
from tests.test_substitute_levels import _brute, _products, _rows

TWICE = [(1, "hot", "L", 1, "ACTIVE", 500), (None, "hot", "L", 2, "ACTIVE", 505), (8000, None, "L", 1, "ACTIVE", 100), (8001, None, "L", 1, "ACTIVE", 100)]


def _within(rows, fits):
    """(product, substitute) of every pair of rows of a segment that ``fits`` (cost, other cost, count, total)."""
    live = [r for r in rows if r[4] == "ACTIVE" and r[5] is not None and None not in r[1:3]]
    costs = {}
    for r in live:
        costs.setdefault(r[1:3], []).append(r[5])
    return sorted(
        (x[0], y[0]) for x in live for y in live
        if None not in (x[0], y[0]) and x[0] != y[0] and x[1:3] == y[1:3] and fits(x[5], y[5], len(costs[x[1:3]]), sum(costs[x[1:3]])))


def _listed(spark, name, rows):
    mart = SimpleNamespace(spark=spark, dim_product=_products(spark, rows))
    return sorted((r.product_id, r.substitute_id) for r in CATALOGUE[name].build(mart).collect())


def test_M13_lists_pairs_of_products(spark):
    rows = _rows() + TWICE
    got = _listed(spark, "M13_substitute_pairs", rows)
    assert got == _within(rows, lambda x, y, n, total: 5 * n * abs(x - y) <= total) and len(got) > 10_000
    assert set(_listed(spark, "M13_substitute_pairs", _rows())) == _brute(_rows())[0]


def test_M14_lists_pairs_of_products(spark):
    rows = _rows() + TWICE
    tenths = lambda x, y, n, total: (2000 * abs(x - y) * n + total) // (2 * total)
    assert _listed(spark, "M14_substitute_degrees", rows) == _within(rows, lambda *at: tenths(*at) <= 350)


def test_M15_lists_pairs_of_products(spark):
    rows = _rows() + TWICE + [(7000 + i, "dear", "L", i, "ACTIVE", 550 + 70 * i) for i in range(30)]
    pct = lambda x: 25 if x < 600 else 20 if x <= 1500 else 15
    assert _listed(spark, "M15_price_band_substitutes", rows) == _within(rows, lambda x, y, n, total: 100 * n * abs(x - y) <= pct(x) * total)


def test_M19_lists_pairs_of_products(spark):
    rows = _rows() + TWICE
    got = _listed(spark, "M19_dearer_substitutes", rows)
    assert got == _within(rows, lambda x, y, n, total: 5 * n * abs(x - y) <= total and 100 * y > 110 * x) and got


def test_stock_outs_list_their_substitutes(spark):
    rows = _rows() + TWICE
    out = [1, 2, 1003, 5000, 5001, 5002, 9999]
    stock = [(p, date(2001, 1, 1), 0, 0 if p in out else 5) for p in {r[0] for r in rows if r[0]} | set(out)]
    mart = SimpleNamespace(
        spark=spark, dim_product=_products(spark, rows),
        fact_inventory=spark.createDataFrame(stock, "product_id long, move_date date, qty_sold long, stock long"))
    got = sorted((r.product_id, r.substitute_id) for r in CATALOGUE["M13_substitutes_of_stock_outs"].build(mart).collect())
    assert got == [p for p in _within(rows, lambda x, y, n, total: 5 * n * abs(x - y) <= total) if p[0] in out]


def test_widest_pairs_are_not_lost_at_band_edges(spark):
    """Costs that differ by exactly a fifth of the mean, at any place of the bands."""
    rows = [(i, f"t{i // 40}", "L", 1, "ACTIVE", 1 + (i % 40) * (i // 40 + 1)) for i in range(1200)]
    assert _listed(spark, "M13_substitute_pairs", rows) == _within(rows, lambda x, y, n, total: 5 * n * abs(x - y) <= total)


@pytest.mark.parametrize("asked_only", [False, True])
def test_pairs_of_one_price_are_dealt_to_many_tasks(spark, monkeypatch, asked_only):
    rng = random.Random(3)
    rows = [(i, "hot", "L", 1, "ACTIVE", 500 if i % 4 else rng.randint(480, 520)) for i in range(400)]
    monkeypatch.setattr(pairs, "PAIRS_PER_TASK", 5000)
    monkeypatch.setattr(mk, "SALT_ROWS", 30)
    products = _products(spark, rows)
    if asked_only:
        found = mk.substitutes_of(spark.range(400).withColumnRenamed("id", "product_id"), products, mk.substitute_levels(products))
    else:
        costs = mk.segment_costs(products)
        found = pairs.banded_pairs(costs, mk.SEGMENT, "product_id", F.col("cost"), F.lit(100.0), ["cost"], salt_rows=30)
    per_task = Counter(r.t for r in found.select(F.spark_partition_id().alias("t")).collect())
    assert sum(per_task.values()) == 400 * 399 and max(per_task.values()) < 400 * 399 / 5
