"""Substitutes by price levels against all pairs."""

import random

from pyspark.sql import functions as F

from storeops.operators import market as mk


def _products(spark, rows):
    df = spark.createDataFrame(rows, "product_id long, product_type string, line string, supplier_id long, status string, cents long")
    return df.withColumn("unit_cost", (F.col("cents") / 100).cast("decimal(12,2)"))


def _rows():
    rng = random.Random(5)
    hot = [(i, "hot", "L", i % 7, "ACTIVE", 500 if i % 3 else rng.randint(300, 700)) for i in range(150)]  # most share one price
    cold = [(1000 + i, f"t{i % 4}", "L", None, "ACTIVE", rng.randint(100, 900)) for i in range(30)]
    return hot + cold + [(5000, "alone", "L", 1, "ACTIVE", 10), (5001, "hot", "L", 1, "INACTIVE", 500), (5002, "hot", "L", 1, "ACTIVE", None)]


def _brute(rows):
    live = [r for r in rows if r[4] == "ACTIVE" and r[5] is not None]
    segment = {}
    for r in live:
        segment.setdefault(r[1:3], []).append(r[5])
    near = lambda x, y: 5 * len(segment[x[1:3]]) * abs(x[5] - y[5]) <= sum(segment[x[1:3]])
    return {(x[0], y[0]) for x in live for y in live if x[0] != y[0] and x[1:3] == y[1:3] and near(x, y)}, {r[0] for r in live}


def test_counts_and_expansion_equal_all_pairs(spark):
    rows = _rows()
    links, live = _brute(rows)
    products = _products(spark, rows)
    levels = mk.substitute_levels(products)
    counts = {r.product_id: r.substitutes for r in mk.substitute_counts(products, levels).collect()}
    assert counts == {p: sum(a == p for a, _ in links) for p in live} and counts[5000] == 0
    asked = [1, 2, 1003, 5000, 5001, 5002, 9999]
    got = mk.substitutes_of(spark.createDataFrame([(p,) for p in asked * 2], "product_id long"), products, levels).collect()
    assert sorted((r.product_id, r.substitute_id) for r in got) == sorted((a, b) for a, b in links if a in asked)


def test_size_depends_on_prices_not_on_products(spark):
    few, many = ([(i, "t", "L", 1, "ACTIVE", 100 + i % 5) for i in range(n)] for n in (50, 5000))
    assert mk.substitute_levels(_products(spark, few)).count() == mk.substitute_levels(_products(spark, many)).count() == 25
