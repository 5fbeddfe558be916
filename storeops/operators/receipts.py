"""Goods-receipt reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeops.functions.columns import big, count_big, count_where, dbl, percent, ratio

AUTHORISE_ABOVE = 10_000
DIVERGENCE_LIMIT_PCT = 5
DOUBLE_CHECK_ABOVE = 500
DOUBLE_SIGN_ABOVE = 5_000
# Targets of the quality indicators.
TARGETS = {"divergence_pct": 5.0, "scan_accuracy_pct": 99.5, "conference_minutes": 120.0, "release_minutes": 240.0}
# Longest allowed minutes per stage.
STAGE_SLA = {"RECEIVE": 30, "FORWARD": 15, "LABEL": 5, "SCAN": 45, "CHECK": 30, "RELEASE": 10}


def duplicate_invoices(invoices: DataFrame) -> DataFrame:
    return invoices.groupBy("number", "series", "supplier_id").agg(count_big().alias("copies")).where(F.col("copies") > 1)


def without_purchase_order(invoices: DataFrame, orders: DataFrame) -> DataFrame:
    return invoices.join(orders.select("order_no").distinct(), "order_no", "left_anti")


def needs_authorisation(invoices: DataFrame, above: float = AUTHORISE_ABOVE) -> DataFrame:
    return invoices.where(F.col("value") > above)


def conference(expected: DataFrame, scanned: DataFrame) -> DataFrame:
    """Invoice lines against scans per (order, product)."""
    keys = ["order_no", "product_id"]
    a = expected.groupBy(*keys).agg(big(F.sum("qty")).alias("expected"), F.sum("value").alias("value"), F.max("unit_value").alias("unit_value"))
    b = scanned.groupBy(*keys).agg(big(F.sum("qty")).alias("scanned"))
    e, s = F.col("expected"), F.col("scanned")
    result = F.when(s.isNull(), "MISSING").when(e.isNull(), "SURPLUS").when(e == s, "OK").otherwise("QUANTITY")
    return a.join(b, keys, "full").withColumn("result", result)


def invoice_flags(rows: DataFrame) -> DataFrame:
    """Divergence in value per invoice and the approvals it needs."""
    zero = F.lit(0).cast("bigint")
    gap = F.abs(F.coalesce("expected", zero) - F.coalesce("scanned", zero))
    diverged = F.when(F.col("expected").isNotNull(), F.col("value") * gap / F.col("expected"))
    per = rows.groupBy("order_no").agg(
        F.sum("value").alias("value"), F.sum(diverged.cast("decimal(20,4)")).alias("diverged"), count_where(F.col("result") != "OK").alias("differences"),
        F.max("unit_value").alias("unit"),
    )
    pct = percent(F.col("diverged"), F.col("value"), 2)
    return per.select(
        "order_no", dbl(F.col("value")).alias("value"), "differences", pct.alias("divergence_pct"), (pct > DIVERGENCE_LIMIT_PCT).alias("authorise"),
        (F.col("unit") > DOUBLE_CHECK_ABOVE).alias("double_check"), (F.col("unit") > DOUBLE_SIGN_ABOVE).alias("double_sign"),
    )


def quality_indicators(rows: DataFrame, lots: DataFrame) -> DataFrame:
    """Divergence rate, scan accuracy, mean conference and release time with
    their targets; one row per indicator."""
    per = rows.groupBy("order_no").agg(
        F.bool_or(F.col("result") != "OK").alias("bad"), F.sum("scanned").alias("scanned"),
        F.sum(F.when(F.col("expected").isNotNull(), F.least("expected", "scanned"))).alias("right"),
    )
    scans = per.agg(percent(count_where(F.col("bad")), count_big()).alias("divergence_pct"), percent(F.sum("right"), F.sum("scanned")).alias("scan_accuracy_pct"))
    minutes = lambda a, b: F.timestamp_diff("MINUTE", F.col(a), F.col(b))
    times = lots.agg(
        ratio(F.sum(minutes("received_at", "checked_at")), count_big(), 2).alias("conference_minutes"),
        ratio(F.sum(minutes("received_at", "released_at")), count_big(), 2).alias("release_minutes"),
    )
    tall = lambda df, names: df.select(F.inline(F.array(*[F.struct(F.lit(n).alias("indicator"), F.col(n).alias("value")) for n in names])))
    both = tall(scans, ["divergence_pct", "scan_accuracy_pct"]).unionByName(tall(times, ["conference_minutes", "release_minutes"]))
    target = F.create_map(*[x for k, v in TARGETS.items() for x in (F.lit(k), F.lit(v))])[F.col("indicator")]
    met = F.when(F.col("indicator") == "scan_accuracy_pct", F.col("value") >= target).otherwise(F.col("value") <= target)
    return both.withColumn("target", target).withColumn("met", met)


def next_event(events: DataFrame, key: str, ts: str, tie: str) -> DataFrame:
    """Each event with the time of the following event of its key.

    Sorted per key and day; the last event of a day continues with the first
    event of the key's next active day, so a key that owns most events is
    sorted by many tasks.
    """
    day = F.to_date(ts)
    rows = events.withColumn("_day", day)
    within = F.lead(ts).over(Window.partitionBy(key, "_day").orderBy(ts, tie))
    first = rows.groupBy(key, "_day").agg(F.min(ts).alias("_first"))
    following = first.select(key, "_day", F.lead("_first").over(Window.partitionBy(key).orderBy("_day")).alias("_tomorrow"))
    return rows.withColumn("_next", within).join(following, [key, "_day"]).withColumn("next_ts", F.coalesce("_next", "_tomorrow")).drop("_day", "_next", "_tomorrow")


def stage_durations(events: DataFrame, stage: Column, key: str, ts: str, tie: str) -> DataFrame:
    """Time spent per stage and how often it exceeds its limit."""
    rows = next_event(events, key, ts, tie).where(F.col("next_ts").isNotNull())
    seconds = F.timestamp_diff("SECOND", F.col(ts), F.col("next_ts"))
    limit = F.create_map(*[x for k, v in STAGE_SLA.items() for x in (F.lit(k), F.lit(v * 60))])
    timed = rows.select(stage.alias("stage"), seconds.alias("s")).withColumn("limit", limit[F.col("stage")])
    return timed.groupBy("stage").agg(
        count_big().alias("steps"), ratio(F.sum("s"), count_big() * 60, 2).alias("mean_minutes"), count_where(F.col("s") > F.col("limit")).alias("over_sla"),
        percent(count_where(F.col("s") > F.col("limit")), count_big()).alias("over_sla_pct"),
    )
