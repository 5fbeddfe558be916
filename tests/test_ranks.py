"""Row numbers in groups of any size."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from storeops.functions import ranks
from storeops.functions.ranks import ranked
from storeops.operators import planning
from storeops.sources import mart


def brute(rows, key, order):
    groups, out = defaultdict(list), {}
    for r in rows:
        groups[key(r)].append(r)
    for g in groups.values():
        for n, r in enumerate(sorted(g, key=order), 1):
            out[r] = n
    return out


@pytest.mark.parametrize("split", [50, 400, 10_000])
@pytest.mark.parametrize("by", [["g"], ["g", "h"], []])
def test_ranks_equal_a_sort(spark, by, split):
    rng = random.Random(1)
    rows = [(rng.choice([None, "a", "a", "a", "a", "b", "c"]), rng.randrange(2), rng.choice([None, *range(200)]), i) for i in range(5000)]
    df = spark.createDataFrame(rows, "g string, h int, v int, i int").repartition(5)
    want = brute(rows, lambda r: tuple(r[("g", "h").index(c)] for c in by), lambda r: ((0, 0) if r[2] is None else (1, -r[2]), r[3]))
    got = ranked(df, by, [-F.col("v"), F.col("i")], "n", split).collect()
    assert len(got) == 5000 and all(want[(r.g, r.h, r.v, r.i)] == r.n for r in got)


def test_no_task_sorts_a_hot_group_whole(spark):
    """Half of all rows are one group: its window is cut into ranges of about the wanted size."""
    df = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("g"), F.xxhash64("id").alias("v"))
    out = ranked(df, ["g"], [F.col("v")], "n", 500)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Window [row_number() windowspecdefinition(g" in plan and "_split" in plan
    rows = df.withColumn("_key", F.struct(F.col("v").alias("k0")))
    cuts = ranks._cuts(rows, ["g"], 20_000, 500).collect()
    assert [r.g for r in cuts] == [0] and len(cuts[0]["_cuts"]) >= 15
    edges = [c.k0 for c in cuts[0]["_cuts"]]
    sizes = defaultdict(int)
    for r in df.where("g = 0").collect():
        sizes[sum(r.v >= e for e in edges)] += 1
    assert max(sizes.values()) <= 1500
    assert out.where("g = 0").agg(F.max("n"), F.count("*"), F.count_distinct("n")).first()[:] == (10_000, 10_000, 10_000)


def test_lines_of_a_hot_order_and_documents_without_supplier(spark, tmp_path, monkeypatch, data_dir):
    monkeypatch.setattr(ranks, "SPLIT_ROWS", 200)
    lines = spark.read.parquet(f"{data_dir}/lineitem.parquet")
    hot = lines.withColumn("l_orderkey", F.when(F.col("l_partkey") % 2 == 0, F.lit(1)).otherwise(F.col("l_orderkey")).cast(lines.schema["l_orderkey"].dataType))
    hot.write.parquet(str(tmp_path / "lineitem.parquet"))
    numbered = mart.Mart(spark, str(tmp_path)).numbered_lines
    assert "_split" in numbered._jdf.queryExecution().optimizedPlan().toString()
    same = ["l_orderkey", *mart.LINE_ORDER, "item_no"]
    plain = mart.Mart(spark, str(tmp_path)).lines
    assert sorted(map(str, numbered.select(*same).collect())) == sorted(map(str, plain.select(*same).collect()))
    items = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 5).alias("supplier_id"), F.concat(F.lit("a"), "id").alias("article"), F.lit("1").alias("size_code"), F.col("id").alias("stock"),
        (F.col("id") % 7).alias("quantity"), F.lit(1).cast("decimal(12,2)").alias("value"), (F.col("id") % 11).cast("double").alias("coverage_days"),
    )
    docs = planning.supplier_documents(items, 50).collect()
    none = sorted((d for d in docs if d.supplier_id is None), key=lambda d: d.page)
    listed = [(i.coverage_days, -i.quantity, i.article) for d in none for i in d["items"]]
    assert len(listed) == 2000 and listed == sorted(listed) and [i.rank for d in none for i in d["items"]] == list(range(1, 2001))


def test_coarse_cuts_are_picked_once_a_group(spark):
    from storeops.functions.ranks import FINE, _cuts

    rows = spark.range(0, 20_000).selectExpr("id % 2 as g", "struct(id as k0) as _key")
    found = _cuts(rows, ["g"], 20_000, 50).collect()
    assert len(found) == 2 and all(len(r["_cuts"]) > 2 * FINE and r["_every"] == r["_cuts"][FINE - 1 :: FINE] for r in found)
