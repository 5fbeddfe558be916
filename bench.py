"""Headline queries, timed one by one; prints one JSON line.

BENCH_SF_DIR   folder with the Parquet tables (default sf0.1)
BENCH_CPUS     local cores (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "K1_sales_kpis", "K2_revenue_by_month", "K3_sales_by_store", "K9_drill_down", "K11_inventory_kpis", "K17_inventory_deltas",
    "K23_supplier_products", "E3_product_dimension", "E12_sales_fact", "E6_scd2_apply", "E7_point_in_time", "E11_key_lookup", "E14_inventory_fact", "E16_purchase_fact",
    "E17_prorated_purchases", "E18_return_fact", "Q1_primary_keys", "Q5_foreign_keys", "Q21_quality_suite", "M4_cross_sell_pairs",
    "M13_substitute_pairs", "M21_stocked_substitutes", "R2_elasticity_by_category", "R9_weekly_regression", "R16_seasonal_forecast",
    "P8_purchase_channels", "P15_escalating_orders", "I8_purchase_alerts", "I9_alerts_without_open_order", "I18_daily_log",
    "I21_enriched_alerts", "G4_invoice_flags",
)


def main() -> None:
    from storeops.plans import CATALOGUE
    from storeops.session import local_session

    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    spark.read.parquet(os.path.join(path, "lineitem.parquet")).selectExpr("sum(l_quantity)").collect()  # start the JVM
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        # the noop sink runs the whole plan without bringing rows to the driver
        CATALOGUE[name].run(spark, path).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(path.rstrip("/")).removeprefix("sf"), "cpus": int(os.environ.get("BENCH_CPUS", "8")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
