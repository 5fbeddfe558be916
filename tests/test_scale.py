"""Plans and results on skewed input: one product holds a third of all rows."""

import re

import pytest
from pyspark.sql import functions as F

from storeops.plans import CATALOGUE
from storeops.sources.mart import Mart
from tests.compare import compare, connect

NAMES = [
    "K9_drill_down", "K17_inventory_deltas", "M21_stocked_substitutes", "M4_cross_sell_pairs", "P8_purchase_channels",
    "I9_alerts_without_open_order", "I18_daily_log", "I21_enriched_alerts", "E17_prorated_purchases", "Q11_orphan_values",
]


@pytest.fixture(scope="module")
def skewed_dir(spark, data_dir, tmp_path_factory):
    """The fixtures with a third of the lines moved to one product and a
    third to one order."""
    out = str(tmp_path_factory.mktemp("skew"))
    for name in ("region nation customer supplier part orders events documents embeddings pages benchmark labels conversations").split():
        spark.read.parquet(f"{data_dir}/{name}.parquet").write.parquet(f"{out}/{name}.parquet")
    lines = spark.read.parquet(f"{data_dir}/lineitem.parquet")
    mix = F.pmod(F.xxhash64(*lines.columns), F.lit(6))
    lines.withColumn("l_partkey", F.when(mix < 2, F.lit(4)).otherwise(F.col("l_partkey"))).withColumn(
        "l_orderkey", F.when(mix.isin(1, 2), F.lit(7)).otherwise(F.col("l_orderkey"))
    ).write.parquet(f"{out}/lineitem.parquet")
    return out


@pytest.fixture(scope="module")
def skewed_duck(skewed_dir):
    return connect(skewed_dir, "/*.parquet")


@pytest.mark.parametrize("name", NAMES)
def test_skewed_results(name, spark, skewed_dir, skewed_duck):
    q = CATALOGUE[name]
    problem = compare(q.run(spark, skewed_dir), skewed_duck, q.sql)
    assert problem is None, problem


@pytest.mark.parametrize("name", ["K2_revenue_by_month", "K13_turnover_by_category", "M13_substitute_pairs", "I8_purchase_alerts", "E11_key_lookup", "Q5_foreign_keys", "G3_conference"])
def test_no_cartesian_product_and_no_python(name, spark, data_dir):
    plan = CATALOGUE[name].run(spark, data_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython", plan)


def test_columns_and_filters_reach_the_scan(spark, data_dir):
    from storeops.operators.sales import sales_kpis, sales_slice

    m = Mart(spark, data_dir)
    plan = sales_kpis(sales_slice(m.fact_sales, first="1997-01-01"))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan  # the item number is not computed when unused
    lines = re.search(r"FileScan parquet \[(l_[^\]]*)\]", plan).group(1)
    assert "l_tax" not in lines and "l_shipdate" not in lines
    assert "o_orderdate" in re.search(r"PushedFilters: \[[^\]]*o_orderdate[^\]]*\]", plan).group(0)


def test_rank_limit_is_pushed_below_the_shuffle(spark, data_dir):
    from storeops.operators.control import recent_velocity

    plan = recent_velocity(Mart(spark, data_dir).fact_inventory)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_gold_tables_give_the_same_result(spark, data_dir):
    from storeops.operators.sales import revenue_by_month
    from storeops.session import work_path
    from storeops.sources.loads import store_gold

    folder = work_path(spark, "gold")
    assert {r.status for r in store_gold(Mart(spark, data_dir), folder).collect()} == {"OK"}
    rows = lambda m: sorted(map(tuple, revenue_by_month(m.fact_sales).collect()))
    assert rows(Mart(spark, data_dir, gold=folder)) == rows(Mart(spark, data_dir))
