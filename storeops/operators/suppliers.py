"""Supplier lead times and delivery performance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeops.functions.columns import big, count_big, count_where, dbl, divide, ratio, top

ON_TIME_DAYS = 45
# Orders above, lead time mean, spread, expected compliance.
TIERS = [(100, 20, 5, 0.85), (50, 25, 7, 0.78), (20, 30, 10, 0.72)]
LAST_TIER = (35, 15, 0.65)


def _tier(n: Column, i: int) -> Column:
    expr = F
    for bound, *values in TIERS:
        expr = expr.when(n > bound, F.lit(values[i]))
    return expr.otherwise(F.lit(LAST_TIER[i]))


def lead_time_tiers(purchases: DataFrame) -> DataFrame:
    """Orders, mean quantity and the lead-time tier they imply."""
    per = purchases.groupBy("supplier_id", "order_no").agg(count_big().alias("n"), F.sum("qty").alias("qty"))
    stats = per.groupBy("supplier_id").agg(count_big().alias("orders"), ratio(F.sum("qty"), F.sum("n")).alias("mean_qty"))
    n = F.col("orders")
    return stats.select("*", _tier(n, 0).alias("lead_mean"), _tier(n, 1).alias("lead_spread"), _tier(n, 2).alias("expected_compliance"))


def performance(purchases: DataFrame, suppliers: DataFrame, tiers: DataFrame) -> DataFrame:
    """Deliveries on time (45 days from the order), late, mean delay of the
    late ones; suppliers without receipts count as compliant."""
    late = F.col("days_to_arrive") > ON_TIME_DAYS
    per = purchases.groupBy("supplier_id").agg(
        count_big().alias("receipts"), count_where(~late).alias("on_time"), count_where(late).alias("late"),
        F.sum(F.when(late, F.col("days_to_arrive") - ON_TIME_DAYS)).alias("delay"),
    )
    rows = suppliers.join(per, "supplier_id", "left").join(tiers.select("supplier_id", "lead_mean"), "supplier_id", "left")
    zero = lambda c: big(F.coalesce(c, F.lit(0)))
    return rows.select(
        "supplier_id", "supplier", "supplier_category", zero("receipts").alias("receipts"), zero("on_time").alias("on_time"), zero("late").alias("late"),
        F.coalesce(F.round(divide(F.col("delay"), F.col("late")), 1), F.lit(0.0)).alias("mean_delay"),
        F.coalesce(ratio(F.col("on_time"), F.col("receipts")), F.lit(1.0)).alias("compliance"), F.coalesce("lead_mean", F.lit(0)).alias("lead_time"),
    )


def graded(perf: DataFrame) -> DataFrame:
    pct = F.round(F.col("compliance") * 100, 1)
    return perf.withColumn("compliance_pct", pct).withColumn("grade", F.when(pct >= 95, "A").when(pct >= 90, "B").when(pct >= 85, "C").otherwise("D"))


def worst_suppliers(perf: DataFrame, k: int = 5, min_receipts: int = 2) -> DataFrame:
    rows = perf.where(F.col("receipts") >= min_receipts).select("supplier_id", "supplier", "receipts", "compliance")
    return top(rows, k, F.asc("compliance"), F.asc("supplier_id"))
