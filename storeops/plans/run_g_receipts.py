"""Goods-receipt and streaming queries."""

from pyspark.sql import functions as F

from storeops.functions.columns import count_big, money_of
from storeops.operators import receipts as g
from storeops.plans.oracle import define
from storeops.plans.registry import query
from storeops.session import work_path
from storeops.streaming import late, loads

define("invoices", """
SELECT o_orderkey AS order_no, o_orderkey // 3 AS number, o_orderstatus AS series, o_custkey % 4 AS supplier_id, cast(o_totalprice AS decimal(12,2)) AS value FROM orders""")


def invoices(m):
    key = F.col("o_orderkey")
    return m.raw("orders").select(
        key.alias("order_no"), F.floor(key / 3).alias("number"), F.col("o_orderstatus").alias("series"), (F.col("o_custkey") % 4).alias("supplier_id"),
        money_of(F.col("o_totalprice")).alias("value"),
    )


@query("G1_duplicate_invoices", "SELECT number, series, supplier_id, count(*) AS copies FROM invoices GROUP BY 1, 2, 3 HAVING count(*) > 1")
def _(m):
    return g.duplicate_invoices(invoices(m))


@query("G2_without_purchase_order", "SELECT order_no, cast(value AS double) AS value FROM invoices WHERE order_no NOT IN (SELECT l_orderkey FROM lineitem)")
def _(m):
    orders = m.raw("lineitem").select(F.col("l_orderkey").alias("order_no"))
    return g.without_purchase_order(invoices(m), orders).select("order_no", F.col("value").cast("double").alias("value"))


@query("G2_needs_authorisation", "SELECT series, count(*) AS invoices, cast(sum(value) AS double) AS value FROM invoices WHERE value > 10000 GROUP BY 1")
def _(m):
    return g.needs_authorisation(invoices(m)).groupBy("series").agg(count_big().alias("invoices"), F.sum("value").cast("double").alias("value"))


# scans: one piece short, a lost line, or a line booked on the next product
define("scan_expected", "SELECT order_no, product_id, qty, gross AS value, cast(gross / qty AS decimal(20,6)) AS unit_value FROM fact_purchases")
define("scan_actual", """
SELECT order_no, product_id + CASE WHEN (order_no + line_no) % 41 = 0 THEN 1 ELSE 0 END AS product_id, qty - CASE WHEN (order_no + line_no) % 20 = 0 THEN 1 ELSE 0 END AS qty
FROM fact_purchases WHERE (order_no + line_no) % 37 <> 0""")
define("conference", """
SELECT order_no, product_id, expected, value, unit_value, scanned, CASE WHEN scanned IS NULL THEN 'MISSING' WHEN expected IS NULL THEN 'SURPLUS' WHEN expected = scanned THEN 'OK' ELSE 'QUANTITY' END AS result
FROM (SELECT order_no, product_id, cast(sum(qty) AS bigint) AS expected, sum(value) AS value, max(unit_value) AS unit_value FROM scan_expected GROUP BY 1, 2)
FULL JOIN (SELECT order_no, product_id, cast(sum(qty) AS bigint) AS scanned FROM scan_actual GROUP BY 1, 2) USING (order_no, product_id)""")


def conference(m):
    mix = F.col("order_no") + F.col("line_no")
    expected = m.fact_purchases.select("order_no", "product_id", "qty", F.col("gross").alias("value"), (F.col("gross") / F.col("qty")).cast("decimal(20,6)").alias("unit_value"))
    scanned = m.fact_purchases.where(mix % 37 != 0).select(
        "order_no", (F.col("product_id") + (mix % 41 == 0).cast("int")).alias("product_id"), (F.col("qty") - (mix % 20 == 0).cast("int")).alias("qty")
    )
    return g.conference(expected, scanned)


@query("G3_conference", "SELECT order_no, product_id, expected, scanned, result FROM conference")
def _(m):
    return conference(m).select("order_no", "product_id", "expected", "scanned", "result")


@query("G4_invoice_flags", """
SELECT *, divergence_pct > 5 AS authorise FROM (SELECT order_no, cast(sum(value) AS double) AS value, count(*) FILTER (result <> 'OK') AS differences,
  round(100.0::double * cast(sum(cast(value * abs(expected - coalesce(scanned, 0)) / expected AS decimal(20,4))) AS double) / cast(sum(value) AS double), 2) AS divergence_pct,
  max(unit_value) > 500 AS double_check, max(unit_value) > 5000 AS double_sign FROM conference GROUP BY 1)""")
def _(m):
    return g.invoice_flags(conference(m))


@query("G5_quality_indicators", """
WITH l AS (SELECT order_no, bool_or(result <> 'OK') AS bad, sum(scanned) AS scanned, sum(CASE WHEN expected IS NOT NULL THEN CASE WHEN scanned IS NULL THEN expected ELSE least(expected, scanned) END END) AS rightly FROM conference GROUP BY 1),
i AS (SELECT 'divergence_pct' AS indicator, round(100.0::double * count(*) FILTER (bad)::double / count(*)::double, 2) AS value, 5.0::double AS target FROM l
UNION ALL SELECT 'scan_accuracy_pct', round(100.0::double * sum(rightly)::double / sum(scanned)::double, 2), 99.5 FROM l
UNION ALL SELECT 'conference_minutes', round(sum(30 + o_orderkey % 150)::double / count(*)::double, 2), 120 FROM orders
UNION ALL SELECT 'release_minutes', round(sum(60 + o_orderkey % 300)::double / count(*)::double, 2), 240 FROM orders)
SELECT *, CASE WHEN indicator = 'scan_accuracy_pct' THEN value >= target ELSE value <= target END AS met FROM i""")
def _(m):
    key, at = F.col("o_orderkey"), F.col("o_orderdate")
    after = lambda base, spread: F.timestamp_add("MINUTE", (F.lit(base) + key % spread).cast("int"), at)
    lots = m.raw("orders").select(at.alias("received_at"), after(30, 150).alias("checked_at"), after(60, 300).alias("released_at"))
    return g.quality_indicators(conference(m), lots)


STAGES = {"signup": "RECEIVE", "view": "FORWARD", "click": "LABEL", "purchase": "SCAN", "error": "CHECK"}


@query("G6_stage_durations", """
WITH n AS (SELECT event_type, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nx FROM events),
d AS (SELECT CASE event_type WHEN 'signup' THEN 'RECEIVE' WHEN 'view' THEN 'FORWARD' WHEN 'click' THEN 'LABEL' WHEN 'purchase' THEN 'SCAN' ELSE 'CHECK' END AS stage,
  CASE event_type WHEN 'signup' THEN 30 WHEN 'view' THEN 15 WHEN 'click' THEN 5 WHEN 'purchase' THEN 45 ELSE 30 END * 60 AS lim, datesub('second', ts, nx) AS s FROM n WHERE nx IS NOT NULL)
SELECT stage, count(*) AS steps, round(sum(s)::double / (count(*) * 60)::double, 2) AS mean_minutes, count(*) FILTER (s > lim) AS over_sla,
  round(100.0::double * count(*) FILTER (s > lim)::double / count(*)::double, 2) AS over_sla_pct FROM d GROUP BY 1""")
def _(m):
    stage = F.create_map(*[x for k, v in STAGES.items() for x in (F.lit(k), F.lit(v))])[F.col("event_type")]
    return g.stage_durations(m.raw("events"), stage, "user_id", "ts", "event_id")


@query("T1_stream_replace", """
SELECT cast(year(move_date) AS int) AS move_year, count(*) AS row_count, cast(sum(CASE WHEN year(move_date) = 1999 AND month(move_date) = 3 THEN qty_sold + 1 ELSE qty_sold END) AS bigint) AS qty_sold FROM movements GROUP BY 1""")
def _(m):
    landing, table, progress = (work_path(m.spark, n) for n in ("landing", "stream-inventory", "stream-progress"))
    rows = m.movements.withColumn("delivery", F.lit(1))
    # days are spread over files and batches: first load, then a correction of one month
    rows.write.mode("append").parquet(landing)
    run = lambda: loads.load_days(loads.file_stream(m.spark, landing, rows.schema, 4), table, "delivery", progress)
    run()
    march = (F.year("move_date") == 1999) & (F.month("move_date") == 3)
    rows.where(march).withColumn("qty_sold", F.col("qty_sold") + 1).withColumn("delivery", F.lit(2)).write.mode("append").parquet(landing)
    run()
    return loads.latest_days(m.spark.read.parquet(table), "move_date", "delivery").groupBy(F.year("move_date").alias("move_year")).agg(count_big().alias("row_count"), F.sum("qty_sold").alias("qty_sold"))


@query("T2_stream_dedup", "SELECT event_type, count(DISTINCT event_id) AS scans FROM events GROUP BY 1")
def _(m):
    landing, table, progress = (work_path(m.spark, n) for n in ("landing", "stream-scans", "stream-progress"))
    events = m.raw("events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    events.write.mode("append").parquet(landing)
    events.where(F.col("event_type") != "view").write.mode("append").parquet(landing)  # scanned twice
    run = lambda: loads.append(loads.without_duplicates(loads.file_stream(m.spark, landing, events.schema), "event_id", "ts", "1 hour"), table, progress)
    run()
    events.where(F.col("event_type") == "view").write.mode("append").parquet(landing)  # late repeats
    run()
    return m.spark.read.parquet(table).groupBy("event_type").agg(count_big().alias("scans"))


@query("T3_stream_daily_totals", """
SELECT cast(ts AS date) AS day, event_type, count(*) AS events, cast(sum(cast(value AS decimal(12,2))) AS double) AS total FROM events
WHERE cast(ts AS date) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) GROUP BY 1, 2""")
def _(m):
    landing, table, progress = (work_path(m.spark, n) for n in ("landing", "stream-daily", "stream-progress"))
    events = m.raw("events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    events.write.mode("append").parquet(landing)
    loads.append(loads.daily_totals(loads.file_stream(m.spark, landing, events.schema), "ts", "event_type", "value", "1 hour"), table, progress)
    return m.spark.read.parquet(table)


@query("T3_batch_daily_totals", """
SELECT cast(ts AS date) AS day, event_type, count(*) AS events, cast(sum(cast(value AS decimal(12,2))) AS double) AS total FROM events GROUP BY 1, 2""")
def _(m):
    return loads.daily_totals(m.raw("events"), "ts", "event_type", "value", None)


def _late_events(m):
    """Events in two deliveries: a quarter of the users reports only after all others, who report twice."""
    folder, landing, progress = (work_path(m.spark, n) for n in ("split-events", "landing", "stream-split"))
    events = m.raw("events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    behind = F.col("user_id") % 4 == 0
    run = lambda: late.split_rows(loads.file_stream(m.spark, landing, events.schema), folder, "event_id", "ts", "1 hour", progress)
    events.where(~behind).write.mode("append").parquet(landing)
    run()
    events.write.mode("append").parquet(landing)
    run()
    return folder


define("event_outcomes", """
WITH e AS (SELECT event_id, ts, event_type, value, user_id % 4 = 0 AS behind FROM events), m AS (SELECT max(ts) FILTER (NOT behind) AS mark FROM e)
SELECT event_id, event_type, 'kept' AS outcome FROM e WHERE NOT behind
UNION ALL SELECT event_id, event_type, CASE WHEN ts < mark - INTERVAL 1 HOUR THEN 'late' WHEN behind THEN 'kept' ELSE 'repeat' END FROM e, m""")


@query("T2_stream_outcomes", "SELECT event_type, outcome, count(*) AS row_count FROM event_outcomes GROUP BY 1, 2")
def _(m):
    return late.outcomes(m.spark, _late_events(m)).groupBy("event_type", "outcome").agg(count_big().alias("row_count"))


@query("T3_corrected_totals", """
WITH e AS (SELECT cast(ts AS date) AS day, event_type, cast(value AS decimal(12,2)) AS v, ts, user_id % 4 = 0 AS behind FROM events),
m AS (SELECT max(ts) FILTER (NOT behind) AS first_mark, max(ts) AS mark FROM e), r AS (SELECT *, behind AND ts < first_mark - INTERVAL 1 HOUR AS is_late FROM e, m)
SELECT day, event_type, count(*) FILTER (NOT is_late) AS given_events, cast(coalesce(sum(v) FILTER (NOT is_late), 0) AS double) AS given_total,
  count(*) FILTER (is_late) AS late_events, cast(coalesce(sum(v) FILTER (is_late), 0) AS double) AS late_total, count(*) AS events, cast(coalesce(sum(v), 0) AS double) AS total
FROM r WHERE day < cast(mark - INTERVAL 1 HOUR AS date) GROUP BY 1, 2""")
def _(m):
    return late.corrected_totals(m.spark, _late_events(m), "event_id", "ts", "event_type", "value", "1 hour")
