"""Pair operators against brute force, with hot groups and ties."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from storeops.functions.pairs import banded_pairs, nearest_k, nearest_other, top_pairs


def _frame(spark, baskets):
    data = [(o, (i,)) for o, items in baskets.items() for i in items]
    return spark.createDataFrame(data, "order_no int, item struct<id:int>")


def _brute(baskets, k):
    counts = Counter()
    for items in baskets.values():
        counts.update(itertools.combinations(sorted(items), 2))
    return sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:k]


def _random_baskets(seed, orders, items, hot):
    rng = random.Random(seed)
    baskets = {o: set(rng.sample(range(items), rng.randint(1, 6))) for o in range(orders)}
    for o in range(hot):  # baskets that hold most items
        baskets[10_000 + o] = set(rng.sample(range(items), int(items * 0.8)))
    return baskets


@pytest.mark.parametrize("hot,k,heavy", [(0, 15, 256), (1, 15, 10), (3, 40, 10), (6, 25, 10)])
def test_top_pairs_is_exact_with_heavy_baskets(spark, hot, k, heavy):
    baskets = _random_baskets(hot, 150, 40, hot)
    df = _frame(spark, baskets)
    got = top_pairs(df, df, "order_no", k, lambda a, b: a["id"] < b["id"], heavy=heavy)
    assert [((r.a.id, r.b.id), r.orders) for r in got.orderBy(F.desc("orders"), "a", "b").collect()] == _brute(baskets, k)


def test_top_pairs_when_only_heavy_baskets_exist(spark):
    baskets = {1: set(range(30)), 2: set(range(10, 40))}
    df = _frame(spark, baskets)
    got = top_pairs(df, df, "order_no", 50, lambda a, b: a["id"] < b["id"], heavy=5)
    assert [((r.a.id, r.b.id), r.orders) for r in got.orderBy(F.desc("orders"), "a", "b").collect()] == _brute(baskets, 50)


def test_top_pairs_two_sides(spark):
    left = spark.createDataFrame([(o, (i,)) for o in range(8) for i in range(o % 4 + 1)], "order_no int, item struct<id:int>")
    right = spark.createDataFrame([(o, (i,)) for o in range(8) for i in range(3)], "order_no int, item struct<id:int>")
    got = {(r.a.id, r.b.id): r.orders for r in top_pairs(left, right, "order_no", 5, lambda a, b: F.lit(True), heavy=5).collect()}
    assert got == {(0, 0): 8, (0, 1): 8, (0, 2): 8, (1, 0): 6, (1, 1): 6}


@pytest.mark.parametrize("salt_rows", [1024, 7])
def test_banded_pairs_finds_every_pair_once(spark, salt_rows):
    rng = random.Random(1)
    # one group holds most members, half of them at one value
    data = [(i, "hot" if i % 5 else "cold", 100 if i % 2 else rng.randint(1, 400)) for i in range(120)]
    df = spark.createDataFrame(data, "id int, g string, v int")
    pairs = banded_pairs(df, ["g"], "id", F.col("v"), F.lit(30.0), ["v"], salt_rows).where(F.abs(F.col("x_v") - F.col("y_v")) <= 30)
    got = Counter((r.x_id, r.y_id) for r in pairs.collect())
    want = {(a[0], b[0]) for a in data for b in data if a[0] != b[0] and a[1] == b[1] and abs(a[2] - b[2]) <= 30}
    assert set(got) == want and set(got.values()) == {1}


def _nearest(data, me, k=1, ok=lambda r: True):
    others = [(abs(r[2] - me[2]), r[0]) for r in data if r[0] != me[0] and r[1] == me[1] and ok(r)]
    return sorted(others)[:k]


def test_nearest_other_with_ties(spark):
    rng = random.Random(2)
    data = [(i, "hot" if i % 4 else f"g{i % 12}", rng.randint(1, 60)) for i in range(150)] + [(999, "alone", 5)]
    df = spark.createDataFrame(data, "id int, g string, v int")
    got = {r.id: (r.diff, r.other) for r in nearest_other(df, ["g"], "v", "id").collect()}
    for row in data:
        want = _nearest(data, row)
        assert got[row[0]] == (want[0] if want else (None, None))


def test_nearest_k_keeps_the_closest_candidates(spark):
    rng = random.Random(3)
    data = [(i, "hot" if i % 4 else "cold", rng.randint(1, 80), i % 3 > 0) for i in range(160)]
    df = spark.createDataFrame(data, "id int, g string, v int, ok boolean")
    got = nearest_k(df, ["g"], "v", "id", F.col("ok"), 4).collect()
    assert len(got) == len(data)
    for r in got:
        me = (r.id, r.g, r.v)
        mine = sorted((abs(o.value - r.v), o.id) for o in r.options if o.id != r.id)[:4]
        assert mine == _nearest(data, me, 4, lambda x: x[3])


def test_top_pairs_of_two_large_baskets_enumerates_neither(spark):
    """Two equal baskets of 20,000 items hold 200 million pairs, all tied."""
    items = spark.range(20_000).selectExpr("struct(cast(id as int) as id) as item")
    df = items.withColumn("order_no", F.lit(1)).unionByName(items.withColumn("order_no", F.lit(2)))
    got = top_pairs(df, df, "order_no", 5, lambda a, b: a["id"] < b["id"])
    assert [(r.a.id, r.b.id, r.orders) for r in got.collect()] == [(0, i, 2) for i in range(1, 6)]


@pytest.mark.parametrize("seed,heavy", [(0, 12), (1, 12), (2, 8), (3, 256)])
def test_top_pairs_with_a_hot_item_and_few_seeds(spark, seed, heavy):
    """One item in every basket, large baskets of different sizes, ties: the bounds lose no pair."""
    rng = random.Random(seed)
    baskets = {o: {0, *rng.sample(range(1, 60), rng.randint(1, 30))} for o in range(40)}
    df = _frame(spark, baskets)
    got = top_pairs(df, df, "order_no", 30, lambda a, b: a["id"] < b["id"], heavy=heavy, seeds=3)
    assert [((r.a.id, r.b.id), r.orders) for r in got.collect()] == _brute(baskets, 30)


def test_top_pairs_when_few_pairs_qualify(spark):
    """Fewer than k pairs: every pair is found, also those of rare items in large baskets; rows without order or item do not count."""
    baskets = {1: set(range(20)), 2: set(range(15, 25)), 3: {1, 24}}
    df = _frame(spark, baskets).unionByName(spark.createDataFrame([(None, (1,)), (None, (2,)), (1, None)], "order_no int, item struct<id:int>"))
    got = top_pairs(df, df, "order_no", 1000, lambda a, b: (a["id"] < b["id"]) & (b["id"] > 17), heavy=5, seeds=2)
    want = [x for x in _brute(baskets, 10_000) if x[0][1] > 17]
    assert [((r.a.id, r.b.id), r.orders) for r in got.collect()] == want
    none = df.where("order_no > 99")
    assert top_pairs(none, none, "order_no", 3, lambda a, b: a["id"] < b["id"]).count() == 0
