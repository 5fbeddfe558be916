"""Stored layouts: periods, buckets, pruning, joins without exchange, writers bounded by size."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from storeops.session import work_path
from storeops.sources.layout import LAYOUTS, Layout, between, bucket_count, save, save_alike


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def sales(spark, rows=4000):
    """Half of all rows lie in one month, a third belong to one article; one row has no day."""
    month = F.when(F.col("id") % 2 == 0, 0).otherwise((F.col("id") % 24).cast("int"))
    return spark.range(rows).select(
        "id", F.add_months(F.lit("1996-01-15").cast("date"), month).alias("sale_date"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("a"), (F.col("id") % 97).cast("string"))).alias("article"), (F.col("id") % 7).alias("qty"),
    ).unionByName(spark.sql("select -1L as id, cast(null as date) as sale_date, cast(null as string) as article, 1L as qty"))


@pytest.mark.parametrize("period,values", [("year", {1996, 1997, None}), ("quarter", {19961, 19974, None}), ("month", {199601, 199712, None})])
def test_periods_keep_every_row(spark, period, values):
    rows, cut = sales(spark), Layout(period, "sale_date")
    stored = spark.table(save(rows, "sales", work_path(spark, "periods"), cut))
    assert values <= {r[0] for r in stored.select(cut.folder).distinct().collect()}
    assert sorted(map(tuple, stored.select(rows.columns).collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)


def test_days_prune_folders(spark):
    rows, cut = sales(spark), LAYOUTS["fact_sales"]
    stored = spark.table(save(rows, "sales", work_path(spark, "pruned"), cut))
    got = between(stored, cut, "1996-03-01", "1996-06-30")
    assert got.count() == rows.where("sale_date between '1996-03-01' and '1996-06-30'").count() > 0
    assert "part_month" in plan(got).split("PartitionFilters: [")[1].split("]")[0]
    read = {os.path.basename(os.path.dirname(f)) for f in (r[0] for r in got.select(F.input_file_name()).distinct().collect())}
    assert read <= {f"part_month=19960{k}" for k in range(3, 7)}


def test_like_buckets_join_without_exchange_and_runs_do_not_meet(spark):
    rows = sales(spark)
    products = rows.select("article").distinct().where("article is not null").withColumn("line", F.length("article"))
    folder = work_path(spark, "alike")
    tables = {"sales": (rows, Layout("month", "sale_date", "article")), "product": (products, LAYOUTS["dim_product"])}
    first, second = save_alike(tables, folder), save_alike(tables, folder)
    assert not set(first.values()) & set(second.values())
    per = spark.table(first["sales"]).groupBy("article").agg(F.sum("qty").alias("qty"))
    joined = per.join(spark.table(first["product"]).hint("merge"), "article").select("article", "qty", "line")
    assert "Exchange" not in plan(joined)
    want = rows.groupBy("article").agg(F.sum("qty").alias("qty")).join(products, "article")
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, want.select("article", "qty", "line").collect()))


def test_buckets_grow_with_the_rows_and_a_hot_key_is_not_bucketed(spark):
    rows, cut = sales(spark), Layout(hash_by="article")
    assert bucket_count(rows, cut) == 8
    assert bucket_count(rows.where("article <> 'hot'"), cut, 100) == 32
    assert bucket_count(rows, cut, 500) == 0
    assert bucket_count(rows.where("false"), cut) == 8
    assert spark.table(save(rows.where("false"), "none", work_path(spark, "none"), Layout("year", "sale_date", "article"))).count() == 0


def test_a_crowded_month_is_written_by_several_tasks(spark):
    rows, cut = sales(spark, 60_000).withColumn("pad", F.sha2(F.col("id").cast("string"), 512)), Layout("month", "sale_date")
    folder, old = work_path(spark, "crowded"), spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        table = save(rows.repartition(16), "sales", folder, cut)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes") if old is None else spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = lambda month: glob.glob(os.path.join(folder, table, f"part_month={month}", "*.parquet"))
    assert len(files(199601)) > 2 * len(files(199604))  # small months may share a cut shuffle partition
    assert spark.table(table).count() == 60_001
