"""Stock-control and supplier queries."""

from pyspark.sql import functions as F

from storeops.functions.columns import count_big, dbl, top
from storeops.operators import control as c, daybook, market as mk, stock as k, suppliers as su
from storeops.plans.oracle import define
from storeops.plans.registry import query
from storeops.plans.run_k_stock import snap
from storeops.session import work_path
from storeops.sources.tables import write_json

AS_OF = "2001-07-15"
RULES = c.RegimeRules(
    continuous=("CONTINUOUS", "SEMI-CONTINUOUS"), fashion=("LARGE", "SMALL"), seasonal=("PROMO", "ECONOMY"), commodity=("STANDARD", "MEDIUM"), basic_line="LINE-0",
)

define("regimed", """
SELECT p.*, v.* EXCLUDE (rg) FROM (SELECT *, CASE WHEN status <> 'ACTIVE' THEN 'inactive' WHEN collection IN ('CONTINUOUS', 'SEMI-CONTINUOUS') THEN 'commodity'
  WHEN category IN ('LARGE', 'SMALL') THEN 'fashion' WHEN category IN ('PROMO', 'ECONOMY') AND line = 'LINE-0' THEN 'commodity'
  WHEN category IN ('PROMO', 'ECONOMY') THEN 'seasonal' WHEN category IN ('STANDARD', 'MEDIUM') THEN 'commodity' ELSE 'fashion' END AS regime FROM dim_product) p
JOIN (VALUES ('commodity', 90, 30, 15, 5, 10, 10, 50, 12, true), ('fashion', 14, 7, 10, 5, 10, 3, 10, 6, true), ('seasonal', 180, 60, 20, 7, 10, 15, 24, 12, true),
  ('inactive', 0, 0, 0, 0, 0, 0, 0, 0, false)) v(rg, target_days, reorder_days, lead_days, lead_spread, tagging_days, safety_days, min_order, pack, reorders) ON p.regime = v.rg""")
define("sale_days", """
SELECT product_id, move_date, stock, sum(qty_sold) OVER w AS sold, count(*) OVER w AS records FROM fact_inventory WHERE qty_sold > 0
WINDOW w AS (PARTITION BY product_id ORDER BY move_date ROWS 29 PRECEDING)""")
define("alert_rows", """
SELECT move_date AS alert_date, product_id, category, line, regime, supplier_id, lead_days, round((stock * records)::double / sold::double, 1) AS coverage_days, quantity,
  CASE WHEN stock * records <= 7 * sold THEN 'CRITICAL' WHEN stock * records <= 14 * sold THEN 'HIGH' WHEN stock * records <= 30 * sold THEN 'MEDIUM' ELSE 'LOW' END AS urgency,
  cast(coalesce(unit_cost, 0) AS double) AS unit_cost, cast(coalesce(unit_cost, 0) * quantity AS double) AS total_cost
FROM (SELECT *, cast(greatest(((greatest(((target_days + lead_days) * sold - stock * records) // records, 0) + pack - 1) // nullif(pack, 0)) * pack, min_order) AS bigint) AS quantity
  FROM sale_days JOIN regimed USING (product_id) WHERE reorders AND stock > 0 AND stock * records <= reorder_days * sold)""")


def alerts(m):
    return c.alerts(m.fact_inventory, m.dim_product, RULES)


@query("I1_regimes", "SELECT product_id, regime FROM regimed")
def _(m):
    return m.dim_product.select("product_id", c.regime(RULES).alias("regime"))


@query("I2_regime_parameters", """
SELECT product_id, regime, target_days, reorder_days, lead_days, safety_days, min_order, pack, reorders FROM regimed""")
def _(m):
    return c.with_regime(m.dim_product, RULES).select("product_id", "regime", "target_days", "reorder_days", "lead_days", "safety_days", "min_order", "pack", "reorders")


@query("I3_mean_sale_price", "SELECT product_id, price::double / 100 AS mean_price FROM mean_prices")
def _(m):
    return mk.mean_prices(m.fact_sales).select("product_id", (dbl(F.col("price")) / 100).alias("mean_price"))


@query("I4_last_sale", "SELECT product_id, max(sale_date) AS last_sale FROM fact_sales GROUP BY 1")
def _(m):
    return c.last_sales(m.fact_sales)


define("lead_tiers", """
SELECT supplier_id, orders, mean_qty, CASE WHEN orders > 100 THEN 20 WHEN orders > 50 THEN 25 WHEN orders > 20 THEN 30 ELSE 35 END AS lead_mean,
  CASE WHEN orders > 100 THEN 5 WHEN orders > 50 THEN 7 WHEN orders > 20 THEN 10 ELSE 15 END AS lead_spread,
  CASE WHEN orders > 100 THEN 0.85::double WHEN orders > 50 THEN 0.78::double WHEN orders > 20 THEN 0.72::double ELSE 0.65::double END AS expected_compliance
FROM (SELECT supplier_id, count(DISTINCT order_no) AS orders, round(sum(qty)::double / count(*)::double, 4) AS mean_qty FROM fact_purchases GROUP BY 1)""")


def tiers(m):
    return su.lead_time_tiers(m.fact_purchases)


@query("I5_lead_time_tiers", "SELECT * FROM lead_tiers")
def _(m):
    return tiers(m)


@query("I6_recent_velocity", """
SELECT product_id, cast(sum(qty_sold) AS bigint) AS sold, count(*) AS records, round(sum(qty_sold)::double / count(*)::double, 4) AS velocity
FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY move_date DESC) AS r FROM fact_inventory WHERE qty_sold > 0) WHERE r <= 30 GROUP BY 1""")
def _(m):
    return c.recent_velocity(m.fact_inventory)


@query("I6_calendar_velocity", f"""
SELECT product_id, cast(sum(qty_sold) AS bigint) AS sold, round(sum(qty_sold)::double / 30, 4) AS velocity FROM fact_inventory
WHERE move_date BETWEEN DATE '{AS_OF}' - 29 AND DATE '{AS_OF}' GROUP BY 1""")
def _(m):
    return c.calendar_velocity(m.fact_inventory, AS_OF)


@query("I7_reorder_triggers", "SELECT regime, cast(year(alert_date) AS int) AS year, count(*) AS triggers FROM alert_rows GROUP BY 1, 2")
def _(m):
    return alerts(m).groupBy("regime", F.year("alert_date").alias("year")).agg(count_big().alias("triggers"))


@query("I8_purchase_alerts", "SELECT * FROM alert_rows")
def _(m):
    return alerts(m)


define("open_intervals", "SELECT product_id, order_date, order_date + days_to_arrive AS arrival, order_date + days_to_arrive + 10 AS in_stock FROM fact_purchases")


@query("I9_alerts_without_open_order", """
SELECT * FROM alert_rows a WHERE NOT EXISTS (SELECT 1 FROM open_intervals o WHERE o.product_id = a.product_id AND order_date <= alert_date AND in_stock > alert_date)""")
def _(m):
    return c.without_open_order(alerts(m), m.fact_purchases)


define("timed_alerts", """
SELECT a.* EXCLUDE (lead_days), cast(coalesce(lead_mean, lead_days) AS int) AS lead_time, cast(alert_date + cast(coalesce(lead_mean, lead_days) AS int) AS date) AS expected_date
FROM alert_rows a LEFT JOIN lead_tiers USING (supplier_id)""")


@query("I10_expected_arrival", "SELECT * FROM timed_alerts")
def _(m):
    return c.expected_arrivals(alerts(m), tiers(m))


_SLOW = f"""
SELECT product_id, max(days_without_sale) AS days_without_sale, arg_max(move_date, days_without_sale * 100000 + (move_date - DATE '1990-01-01')) AS last_sale,
  arg_max(stock, days_without_sale * 100000 + (move_date - DATE '1990-01-01')) AS stock FROM (
  SELECT product_id, move_date, stock, cast(coalesce(lead(move_date) OVER (PARTITION BY product_id ORDER BY move_date) - 1, DATE '{AS_OF}') - move_date AS int) AS days_without_sale
  FROM fact_inventory WHERE qty_sold > 0 AND move_date <= DATE '{AS_OF}') WHERE stock > 0 AND days_without_sale >= 60 GROUP BY 1"""
define("slow", f"SELECT *, CASE WHEN days_without_sale < 90 THEN 0.1::double WHEN days_without_sale < 180 THEN 0.2::double ELSE 0.3::double END AS discount FROM ({_SLOW})")


@query("I11_slow_movers", "SELECT * FROM slow")
def _(m):
    return c.slow_movers(m.fact_inventory, AS_OF)


define("outs", """
SELECT product_id, move_date AS stock_out_date, restocked, cast(restocked - move_date AS int) AS days_until_restock FROM (
  SELECT *, lag(stock) OVER w AS before, min(CASE WHEN qty_in > 0 THEN move_date END) OVER (PARTITION BY product_id ORDER BY move_date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS restocked
  FROM fact_inventory WINDOW w AS (PARTITION BY product_id ORDER BY move_date)) WHERE before > 0 AND stock <= 0""")


@query("I12_first_stock_out", """
SELECT product_id, min(stock_out_date) AS stock_out_date, arg_min(restocked, stock_out_date) AS restocked, arg_min(days_until_restock, stock_out_date) AS days_until_restock,
  count(*) AS stock_outs FROM outs GROUP BY 1""")
def _(m):
    return c.first_stock_out(m.fact_inventory)


@query("I13_days_until_restock", "SELECT * FROM outs")
def _(m):
    return c.stock_outs(m.fact_inventory)


define("timeline", f"""
SELECT order_no, line_no, product_id, supplier_id, qty, order_date, cast(order_date + days_to_arrive AS date) AS arrival, cast(order_date + days_to_arrive + 10 AS date) AS in_stock,
  CASE WHEN order_date > DATE '{AS_OF}' THEN 'FUTURE' WHEN order_date + days_to_arrive > DATE '{AS_OF}' THEN 'PENDING' WHEN order_date + days_to_arrive + 10 > DATE '{AS_OF}' THEN 'TAGGING' ELSE 'RECEIVED' END AS state,
  days_to_arrive <= 45 AS on_time FROM fact_purchases""")


@query("I14_receipt_timeline", "SELECT * FROM timeline")
def _(m):
    return c.receipt_timeline(m.fact_purchases, AS_OF)


define("performance", """
SELECT s.supplier_id, supplier, supplier_category, coalesce(receipts, 0) AS receipts, coalesce(on_time, 0) AS on_time, coalesce(late, 0) AS late,
  coalesce(round(delay::double / nullif(late, 0)::double, 1), 0.0::double) AS mean_delay, coalesce(round(on_time::double / nullif(receipts, 0)::double, 4), 1.0::double) AS compliance,
  cast(coalesce(lead_mean, 0) AS int) AS lead_time
FROM dim_supplier s LEFT JOIN (SELECT supplier_id, count(*) AS receipts, count(*) FILTER (days_to_arrive <= 45) AS on_time, count(*) FILTER (days_to_arrive > 45) AS late,
  sum(days_to_arrive - 45) FILTER (days_to_arrive > 45) AS delay FROM fact_purchases GROUP BY 1) USING (supplier_id) LEFT JOIN lead_tiers USING (supplier_id)""")


def performance(m):
    return su.performance(m.fact_purchases, m.dim_supplier, tiers(m))


@query("I15_supplier_performance", "SELECT * FROM performance")
def _(m):
    return performance(m)


@query("I16_supplier_grades", """
SELECT supplier_id, round(compliance * 100, 1) AS compliance_pct, CASE WHEN round(compliance * 100, 1) >= 95 THEN 'A' WHEN round(compliance * 100, 1) >= 90 THEN 'B'
  WHEN round(compliance * 100, 1) >= 85 THEN 'C' ELSE 'D' END AS grade FROM performance""")
def _(m):
    return su.graded(performance(m)).select("supplier_id", "compliance_pct", "grade")


def days(m):
    return m.calendar


@query("I17_open_orders_per_day", """
SELECT day, cast((SELECT count(*) FROM open_intervals WHERE order_date <= day) - (SELECT count(*) FROM open_intervals WHERE arrival <= day) AS bigint) AS pending,
  cast((SELECT count(*) FROM open_intervals WHERE arrival <= day) - (SELECT count(*) FROM open_intervals WHERE in_stock <= day) AS bigint) AS tagging FROM calendar""")
def _(m):
    return c.open_orders_per_day(m.fact_purchases, days(m))


_FLOW = """
WITH r AS (SELECT f.*, lag(stock) OVER w AS before, min(CASE WHEN qty_sold > 0 THEN move_date END) OVER (PARTITION BY product_id ORDER BY move_date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt
  FROM fact_inventory f WINDOW w AS (PARTITION BY product_id ORDER BY move_date)),
p AS (SELECT r.*, category, line FROM r JOIN dim_product USING (product_id)),
mv AS (SELECT move_date AS day, {by}, sum(stock - coalesce(before, 0)) AS d, sum(qty_sold) AS q, count(*) FILTER (before > 0 AND stock <= 0) AS o, count(*) FILTER (qty_in > 0) AS rc FROM p GROUP BY ALL),
al AS (SELECT alert_date AS day, {by}, count(*) AS a FROM alert_rows GROUP BY ALL),
ev AS (SELECT cast(move_date + 60 AS date) AS day, {by}, 1 AS s FROM p WHERE qty_sold > 0 AND stock > 0 AND (nxt IS NULL OR nxt > move_date + 60)
  UNION ALL SELECT nxt, {by}, -1 FROM p WHERE qty_sold > 0 AND stock > 0 AND nxt > move_date + 60),
sl AS (SELECT day, {by}, sum(s) AS s FROM ev GROUP BY ALL),
vl AS (SELECT sale_date AS day, {by}, sum(net) AS v FROM fact_sales JOIN dim_product USING (product_id) GROUP BY ALL),
fr AS (SELECT day, {by} FROM calendar, (SELECT DISTINCT {by} FROM dim_product))
SELECT day{out}, cast(coalesce(sum(d) OVER w, 0) AS bigint) AS total_stock, cast(coalesce(q, 0) AS bigint) AS sales_qty, cast(coalesce(v, 0) AS double) AS sales_value, coalesce(o, 0) AS stock_outs,
  coalesce(rc, 0) AS receipts, coalesce(a, 0) AS alerts, cast(coalesce(sum(s) OVER w, 0) AS bigint) AS slow_movers
FROM fr LEFT JOIN mv USING (day, {by}) LEFT JOIN al USING (day, {by}) LEFT JOIN sl USING (day, {by}) LEFT JOIN vl USING (day, {by})
WINDOW w AS (PARTITION BY {by} ORDER BY day ROWS UNBOUNDED PRECEDING)"""
define("log_by_segment", _FLOW.format(by="category, line", out=", category, line"))
define("day_log", """
SELECT day, cast(sum(total_stock) AS bigint) AS total_stock, cast(sum(sales_qty) AS bigint) AS sales_qty, cast(sum(cast(sales_value AS decimal(18,2))) AS double) AS sales_value, cast(sum(stock_outs) AS bigint) AS stock_outs,
  cast(sum(receipts) AS bigint) AS receipts, cast(sum(alerts) AS bigint) AS alerts, cast(sum(slow_movers) AS bigint) AS slow_movers FROM log_by_segment GROUP BY 1""")


def log(m, by=None):
    return c.daily_log(m.fact_inventory, m.fact_sales, m.dim_product, RULES, days(m), by)


@query("I18_daily_log", "SELECT * FROM day_log")
def _(m):
    return log(m)


@query("I18_daily_log_by_segment", "SELECT * FROM log_by_segment")
def _(m):
    return log(m, ["category", "line"])


@query("I19_daily_by_category", """
SELECT day, category, cast(sum(total_stock) AS bigint) AS total_stock, cast(sum(sales_qty) AS bigint) AS sales_qty FROM log_by_segment GROUP BY 1, 2""")
def _(m):
    return log(m, ["category"]).select("day", "category", "total_stock", "sales_qty")


define("log_totals", """
SELECT count(*) AS days, min(day) AS first_day, max(day) AS last_day, cast(sum(sales_qty) AS bigint) AS sales_qty, cast(sum(cast(sales_value AS decimal(18,2))) AS double) AS sales_value,
  round(sum(sales_qty)::double / count(*), 1) AS daily_qty, round(cast(sum(cast(sales_value AS decimal(18,2))) AS double) / count(*), 2) AS daily_value,
  cast(sum(stock_outs) AS bigint) AS stock_outs, cast(sum(alerts) AS bigint) AS alerts, cast(sum(receipts) AS bigint) AS receipts, arg_max(total_stock, day) AS final_stock FROM day_log""")


@query("I20_period_summary", "SELECT * FROM log_totals")
def _(m):
    return c.log_totals(log(m))


@query("I20_regime_distribution", "SELECT regime, count(*) AS products FROM regimed GROUP BY 1")
def _(m):
    return c.regime_distribution(m.dim_product, RULES)


define("scored_alerts", """
WITH o AS (SELECT a.product_id, a.alert_date, min(arrival) AS pending_arrival, min(order_date) FILTER (arrival = best) AS pending_order_date FROM (
  SELECT a.product_id, a.alert_date, arrival, order_date, min(arrival) OVER (PARTITION BY a.product_id, a.alert_date) AS best
  FROM (SELECT DISTINCT product_id, alert_date FROM timed_alerts) a JOIN open_intervals o ON o.product_id = a.product_id AND order_date <= alert_date AND arrival > alert_date) a GROUP BY 1, 2)
SELECT t.*, article, cast(pending_arrival AS date) AS pending_arrival, pending_order_date, pending_arrival IS NOT NULL AS has_pending, cast(pending_arrival - alert_date AS int) AS days_to_arrival,
  CASE WHEN coverage_days < 7 THEN 'CRITICAL' WHEN coverage_days < 15 THEN 'HIGH' WHEN coverage_days >= 30 THEN 'LOW' WHEN coverage_days < lead_time THEN 'HIGH'
       WHEN coverage_days > lead_time + 5 THEN 'LOW' ELSE 'MEDIUM' END AS risk,
  CASE WHEN pending_arrival IS NULL THEN '-' WHEN pending_arrival - alert_date < coverage_days THEN 'YES' ELSE 'NO' END AS in_time
FROM timed_alerts t JOIN dim_product p USING (product_id) LEFT JOIN o USING (product_id, alert_date)""")


def scored(m):
    rows = c.enrich_alerts(c.expected_arrivals(alerts(m), tiers(m)), m.dim_product, m.fact_purchases)
    return rows.withColumn("risk", c.risk_score()).withColumn("in_time", c.arrives_in_time())


@query("I21_enriched_alerts", """
SELECT alert_date, product_id, article, has_pending, pending_order_date, pending_arrival, days_to_arrival FROM scored_alerts""")
def _(m):
    return scored(m).select("alert_date", "product_id", "article", "has_pending", "pending_order_date", "pending_arrival", "days_to_arrival")


@query("I22_risk_scores", "SELECT category, risk, count(*) AS alerts FROM scored_alerts GROUP BY 1, 2")
def _(m):
    return scored(m).groupBy("category", "risk").agg(count_big().alias("alerts"))


@query("I23_arrives_in_time", "SELECT in_time, has_pending, count(*) AS alerts FROM scored_alerts GROUP BY 1, 2")
def _(m):
    return scored(m).groupBy("in_time", "has_pending").agg(count_big().alias("alerts"))


@query("I24_alert_statistics", """
SELECT count(*) AS alerts, count(*) FILTER (risk IN ('HIGH', 'CRITICAL')) AS high_or_critical,
  round(100.0::double * count(*) FILTER (risk IN ('HIGH', 'CRITICAL'))::double / count(*)::double, 1) AS high_or_critical_pct, count(*) FILTER (in_time = 'NO') AS ruptures,
  count(DISTINCT a.supplier_id) AS suppliers, max(alert_date) AS latest, (SELECT supplier_id FROM performance WHERE supplier_id IN (SELECT supplier_id FROM scored_alerts) ORDER BY compliance, supplier_id LIMIT 1) AS worst_supplier
FROM scored_alerts a""")
def _(m):
    return c.alert_statistics(scored(m), performance(m))


@query("I24_alert_counts", "SELECT category, urgency, risk, count(*) AS alerts FROM scored_alerts GROUP BY 1, 2, 3")
def _(m):
    return scored(m).groupBy("category", "urgency", "risk").agg(count_big().alias("alerts"))


_ALERT = ["alert_date", "product_id", "urgency", "coverage_days", "quantity"]


@query("I25_latest_alerts", f"SELECT {', '.join(_ALERT)} FROM alert_rows ORDER BY alert_date DESC, product_id LIMIT 200")
def _(m):
    return c.latest_alerts(alerts(m).select(*_ALERT))


@query("I25_urgent_alerts", f"""
SELECT {', '.join(_ALERT)} FROM alert_rows ORDER BY CASE urgency WHEN 'CRITICAL' THEN 4 WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 ELSE 1 END DESC, coverage_days, alert_date DESC, product_id LIMIT 10""")
def _(m):
    return c.urgent_alerts(alerts(m).select(*_ALERT))


@query("I25_worst_suppliers", "SELECT supplier_id, supplier, receipts, compliance FROM performance WHERE receipts >= 2 ORDER BY compliance, supplier_id LIMIT 5")
def _(m):
    return su.worst_suppliers(performance(m))


@query("I25_alert_slice", f"""
SELECT {', '.join(_ALERT)} FROM alert_rows WHERE urgency IN ('CRITICAL', 'HIGH') AND category IN ('PROMO', 'STANDARD') AND supplier_id BETWEEN 10 AND 40""")
def _(m):
    return c.slice_alerts(alerts(m), urgencies=["CRITICAL", "HIGH"], suppliers=list(range(10, 41)), categories=["PROMO", "STANDARD"]).select(*_ALERT)


@query("I26_buyer_kpis", """
WITH l AS (SELECT max(alert_date) AS last FROM alert_rows)
SELECT round(cast(sum(cast(total_cost AS decimal(18,2))) AS double), 2) AS alert_cost, count(*) FILTER (urgency = 'CRITICAL') AS critical, count(*) FILTER (urgency = 'CRITICAL' AND alert_date = last) AS critical_last_day,
  count(*) FILTER (urgency = 'CRITICAL' AND alert_date > last - 7) AS critical_last_week, count(*) FILTER (coverage_days <= 5) AS rupture_risk FROM alert_rows, l""")
def _(m):
    return c.buyer_kpis(alerts(m))


@query("I27_labelled_alerts", """
SELECT alert_date, product_id, supplier_id, urgency, quantity, CASE WHEN coverage_days <= 3 THEN 'CRITICAL' WHEN coverage_days <= 7 THEN 'VERY LOW' WHEN coverage_days <= 14 THEN 'LOW'
  WHEN coverage_days <= 30 THEN 'MEDIUM' WHEN coverage_days <= 60 THEN 'GOOD' ELSE 'COMFORTABLE' END AS coverage_label FROM alert_rows""")
def _(m):
    return alerts(m).select("alert_date", "product_id", "supplier_id", "urgency", "quantity", c.coverage_label().alias("coverage_label"))


@query("I27_open_orders", f"""
SELECT order_no, line_no, product_id, supplier_id, qty, state, cast(CASE state WHEN 'PENDING' THEN arrival ELSE in_stock END - DATE '{AS_OF}' AS int) AS days_remaining
FROM timeline WHERE state IN ('PENDING', 'TAGGING')""")
def _(m):
    day = F.lit(AS_OF).cast("date")
    rows = c.receipt_timeline(m.fact_purchases, AS_OF).where(F.col("state").isin("PENDING", "TAGGING"))
    until = F.when(F.col("state") == "PENDING", F.col("arrival")).otherwise(F.col("in_stock"))
    return rows.select("order_no", "line_no", "product_id", "supplier_id", "qty", "state", F.date_diff(until, day).alias("days_remaining"))


@query("I27_top_slow_movers", "SELECT product_id, days_without_sale, stock, discount FROM slow ORDER BY days_without_sale DESC, product_id LIMIT 5")
def _(m):
    rows = c.slow_movers(m.fact_inventory, AS_OF).select("product_id", "days_without_sale", "stock", "discount")
    return top(rows, 5, F.desc("days_without_sale"), F.asc("product_id"))


DOCUMENT_DAYS = ("2001-06-01", "2001-06-30")
_PAGE = 50
define("day_entries", f"""
SELECT day, 'ALERT' AS section, row_number() OVER (PARTITION BY day ORDER BY CASE urgency WHEN 'CRITICAL' THEN 4 WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 ELSE 1 END DESC, coverage_days, product_id) AS position,
  product_id, supplier_id, quantity, CASE WHEN coverage_days <= 3 THEN 'CRITICAL' WHEN coverage_days <= 7 THEN 'VERY LOW' WHEN coverage_days <= 14 THEN 'LOW'
  WHEN coverage_days <= 30 THEN 'MEDIUM' WHEN coverage_days <= 60 THEN 'GOOD' ELSE 'COMFORTABLE' END AS label, cast(NULL AS int) AS days
FROM (SELECT *, alert_date AS day FROM alert_rows WHERE alert_date BETWEEN DATE '{DOCUMENT_DAYS[0]}' AND DATE '{DOCUMENT_DAYS[1]}')
UNION ALL
SELECT day, 'ORDER', row_number() OVER (PARTITION BY day ORDER BY days, order_no, line_no, product_id, supplier_id, qty), product_id, supplier_id, qty, label, days
FROM (SELECT *, CASE WHEN arrival > day THEN 'PENDING' ELSE 'TAGGING' END AS label, cast(CASE WHEN arrival > day THEN arrival - day ELSE in_stock - day END AS int) AS days
  FROM timeline JOIN calendar ON day >= order_date AND day < in_stock WHERE day BETWEEN DATE '{DOCUMENT_DAYS[0]}' AND DATE '{DOCUMENT_DAYS[1]}')""")


@query("I27_day_documents", f"""
SELECT day, cast((position - 1) // {_PAGE} AS int) AS page, section, cast(position AS bigint) AS position, product_id, supplier_id, cast(quantity AS bigint) AS quantity, label, days FROM day_entries
UNION ALL SELECT day, 0, 'TOTALS', 0, NULL, NULL, sales_qty, NULL, NULL FROM day_log WHERE day BETWEEN DATE '{DOCUMENT_DAYS[0]}' AND DATE '{DOCUMENT_DAYS[1]}'
UNION ALL SELECT day, 0, 'SLOW', r, product_id, NULL, stock, cast(discount AS varchar), days_without_sale
FROM (SELECT *, row_number() OVER (ORDER BY days_without_sale DESC, product_id) AS r FROM slow), calendar WHERE r <= 5 AND day BETWEEN DATE '{DOCUMENT_DAYS[0]}' AND DATE '{DOCUMENT_DAYS[1]}'""")
def _(m):
    # nested documents, written as JSON, read back and flattened
    documents = daybook.day_documents(log(m), alerts(m), m.fact_purchases, c.slow_movers(m.fact_inventory, AS_OF), *DOCUMENT_DAYS, page_size=_PAGE)
    path = work_path(m.spark, "day-documents")
    write_json(documents, path, compression="gzip")
    return daybook.flat_documents(m.spark.read.schema(documents.schema).json(path))


@query("I28_log_by_month", """
SELECT strftime(day, '%Y-%m') AS month, cast(sum(sales_qty) AS bigint) AS sales_qty, cast(sum(cast(sales_value AS decimal(18,2))) AS double) AS sales_value, round(sum(sales_qty)::double / count(*), 1) AS daily_qty,
  round(cast(sum(cast(sales_value AS decimal(18,2))) AS double) / count(*), 2) AS daily_value, cast(sum(stock_outs) AS bigint) AS stock_outs, cast(sum(alerts) AS bigint) AS alerts, count(*) AS days FROM day_log GROUP BY 1""")
def _(m):
    return c.log_by_month(log(m))


@query("I28_every_seventh_day", "SELECT day, total_stock, sales_qty FROM day_log WHERE (day - (SELECT min(day) FROM day_log)) % 7 = 0")
def _(m):
    return c.every_nth_day(log(m)).select("day", "total_stock", "sales_qty")


@query("I33_sell_through", """
SELECT product_id, category, opening, received, sold, round(sold::double / nullif(opening + received, 0)::double, 4) AS sell_through, (sold * 10 >= (opening + received) * 7 AND opening + received > 0) AS reorder
FROM (SELECT product_id, arg_min(stock - qty_in + qty_sold, move_date) AS opening, cast(sum(qty_in) AS bigint) AS received, cast(sum(qty_sold) AS bigint) AS sold FROM fact_inventory GROUP BY 1)
JOIN regimed USING (product_id) WHERE regime = 'seasonal'""")
def _(m):
    return c.sell_through(m.fact_inventory, m.dim_product, RULES)


@query("I34_stock_ledger", """
SELECT product_id, store_id, move_date, stock AS book_stock, counted AS counted_stock, counted - stock AS difference FROM stock_book""")
def _(m):
    # receipts, sales, transfers and adjustments on every day, against the counted stock where there is one
    counts = m.stock_book.where(F.col("counted").isNotNull()).select("product_id", "store_id", "move_date", F.col("counted").alias("counted_stock"))
    return c.ledger(m.stock_book, 10 * (F.col("product_id") % 10), counts, ["product_id", "store_id"])
