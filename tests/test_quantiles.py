"""Quantiles by histogram refinement against numpy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from storeops.functions.quantiles import group_quantiles

P = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p100": 1.0}


def _check(got, groups):
    assert {r.g for r in got} == set(groups)
    for r in got:
        want = np.percentile(groups[r.g], [100 * p for p in P.values()])
        assert np.allclose([r[n] for n in P], want, rtol=0, atol=1e-6), (r, want)


@pytest.mark.parametrize("bins", [16, 1024])
def test_equal_to_percentile_cont_with_one_hot_group(spark, bins):
    rng = random.Random(bins)
    groups = {"hot": [rng.randint(-500, 40_000) for _ in range(3000)], "few": [5, 9], "one": [7], None: [1, 1, 1, 8], "same": [3] * 50}
    data = [(g, v) for g, vs in groups.items() for v in vs] + [("few", None), ("none", None)]
    df = spark.createDataFrame(data, "g string, v int")
    _check(group_quantiles(df, ["g"], F.col("v"), P, bins=bins).collect(), groups)


def test_weights_count_as_repeats_and_wide_ranges_are_reached(spark):
    data = [("a", 0, 3), ("a", 10**12, 2), ("a", -(10**12), 1), ("a", 5, 0), ("b", 4, None), ("b", 6, 2)]
    df = spark.createDataFrame(data, "g string, v long, w int")
    _check(group_quantiles(df, ["g"], F.col("v"), P, F.col("w")).collect(), {"a": [0] * 3 + [10**12] * 2 + [-(10**12)], "b": [6, 6]})


def test_whole_table_and_empty_table(spark):
    df = spark.createDataFrame([(i,) for i in range(101)], "v int")
    assert group_quantiles(df, [], F.col("v"), {"p50": 0.5}).first()["p50"] == 50.0
    assert group_quantiles(df.withColumn("g", F.lit(1)).limit(0), ["g"], F.col("v"), P).collect() == []


def test_no_state_grows_with_the_group(spark):
    df = spark.range(1000).withColumn("g", F.col("id") % 2)
    plan = group_quantiles(df, ["g"], F.col("id"), {"p50": 0.5})._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "collect_list" not in plan
