"""Purchase-planning queries."""

from pyspark.sql import functions as F

from storeops.functions.columns import dbl
from storeops.operators import planning as p
from storeops.plans.oracle import define
from storeops.plans.registry import query
from storeops.plans.run_i_control import alerts
from storeops.plans.run_k_stock import CLOTHING, JEWELLERY, snap, supplier_products
from storeops.plans.run_r_models import MAJOR, forecast_days
from storeops.session import work_path
from storeops.sources import tables

MAPPING = {c: c for c in MAJOR}
JEWELLERS = [3, 11, 27]

define("day_counts", "SELECT count(DISTINCT move_date) AS all_days, count(DISTINCT CASE WHEN qty_sold > 0 THEN move_date END) AS selling_days FROM fact_inventory")
define("velocity_rows", """
SELECT product_id, stock, sold, selling_days, all_days, sold::double / selling_days::double AS chain_velocity, greatest(sold::double / all_days::double, 0.0001::double) AS velocity
FROM (SELECT product_id, arg_max(stock, move_date) AS stock, cast(sum(qty_sold) AS bigint) AS sold FROM fact_inventory GROUP BY 1), day_counts""")
define("horizon", """
SELECT category AS forecast_group, sum(yhat) AS total, sum(yhat) / count(*)::double AS daily_mean FROM forecast_days WHERE ds - (SELECT min(ds) FROM forecast_days) < 120 GROUP BY 1""")
define("candidates", """
SELECT d.*, v.* EXCLUDE (product_id), CASE WHEN category IN ('STANDARD', 'MEDIUM', 'LARGE', 'PROMO') THEN category ELSE 'OTHER' END AS forecast_group
FROM dim_product d JOIN velocity_rows v USING (product_id) WHERE status = 'ACTIVE'""")


def totals(m):
    return p.horizon_totals(forecast_days(m))


def rows(m):
    return p.candidates(m.fact_inventory, m.dim_product, MAPPING)


@query("P1_latest_stock", "SELECT product_id, stock, move_date FROM snapshot")
def _(m):
    return snap(m).select("product_id", "stock", "move_date")


@query("P2_velocities", "SELECT product_id, sold, round(chain_velocity, 4) AS chain_velocity, round(velocity, 4) AS velocity FROM velocity_rows")
def _(m):
    return p.velocities(m.fact_inventory).select("product_id", "sold", F.round("chain_velocity", 4).alias("chain_velocity"), F.round("velocity", 4).alias("velocity"))


@query("P3_forecast_groups", """
SELECT category, CASE WHEN category IN ('STANDARD', 'MEDIUM', 'LARGE', 'PROMO') THEN category ELSE 'OTHER' END AS forecast_group, count(*) AS products FROM dim_product GROUP BY 1, 2""")
def _(m):
    return m.dim_product.groupBy("category", p.forecast_group(MAPPING).alias("forecast_group")).agg(F.count(F.lit(1)).alias("products"))


define("needs", """
SELECT product_id, article, product_type, category, line, size_code, supplier_id, forecast_group, stock, round(chain_velocity, 4) AS velocity, round(f, 1) AS forecast,
  cast(round(greatest(f - stock, 0), 0) AS bigint) AS quantity, greatest(f - stock, 0) > 1 AS needed, CASE WHEN unit_cost > 0 THEN unit_cost ELSE 0 END AS unit_cost
FROM (SELECT c.*, CASE WHEN sold > 0 THEN chain_velocity * 120 WHEN gs > 0 THEN coalesce(daily_mean, 1.0::double) * 0.1::double * 120 ELSE greatest(1.0::double, coalesce(total, 0.0::double) / gn) END AS f
  FROM candidates c JOIN (SELECT forecast_group, sum(sold) AS gs, count(*) AS gn FROM candidates GROUP BY 1) USING (forecast_group) LEFT JOIN horizon USING (forecast_group))""")


def needs(m):
    return p.need_by_velocity(rows(m), totals(m))


@query("P4_need_by_velocity", "SELECT * REPLACE (cast(unit_cost AS double) AS unit_cost) FROM needs")
def _(m):
    return needs(m).withColumn("unit_cost", dbl(F.col("unit_cost")))


define("shares", """
SELECT c.*, CASE WHEN total > 0 THEN velocity / vs * total ELSE velocity * 120 END AS forecast FROM candidates c
JOIN (SELECT category, coalesce(sum(sold) FILTER (sold::double / all_days::double >= 0.0001), 0)::double / max(all_days)::double + count(*) FILTER (sold::double / all_days::double < 0.0001) * 0.0001::double AS vs
  FROM candidates GROUP BY 1) USING (category) LEFT JOIN (SELECT forecast_group AS category, total FROM horizon) USING (category)""")


@query("P5_proportional_need", """
SELECT product_id, category, stock, round(forecast, 4) AS forecast, cast(greatest(ceil(round(forecast - stock, 6)), 0) AS bigint) AS quantity FROM shares""")
def _(m):
    return p.proportional_need(rows(m), totals(m)).select("product_id", "category", "stock", F.round("forecast", 4).alias("forecast"), "quantity")


define("category_costs", "SELECT category, cast(round(cast(sum(unit_cost) AS double) / count(*), 4) AS decimal(12,4)) AS category_cost FROM dim_product WHERE unit_cost > 0 GROUP BY 1")
define("costed", """
SELECT product_id, coalesce(CASE WHEN unit_cost > 0 THEN cast(unit_cost AS decimal(12,4)) END, category_cost, (SELECT cast(round(avg(category_cost)::double, 4) AS decimal(12,4)) FROM category_costs), 15) AS cost
FROM dim_product LEFT JOIN category_costs USING (category)""")


@query("P6_cost_fallback", "SELECT product_id, cast(cost AS double) AS cost FROM costed")
def _(m):
    return p.with_cost(m.dim_product, m.dim_product).select("product_id", dbl(F.col("cost")).alias("cost"))


define("purchase_plan", """
SELECT s.*, cost, quantity * cost AS value, CASE WHEN velocity > 0.0001 THEN sign(stock) * ((200 * abs(stock) * all_days + sold) // (2 * sold))::double / 100 + 0.0::double ELSE 999.0::double END AS coverage_days,
  CASE category WHEN 'LARGE' THEN 'CLOTHING' WHEN 'SMALL' THEN 'JEWELLERY' ELSE 'SUPPLIER' END AS channel
FROM (SELECT *, cast(greatest(ceil(round(forecast - stock, 6)), 0) AS bigint) AS quantity FROM shares) s JOIN costed USING (product_id) WHERE quantity > 0""")


def plan(m):
    return p.purchase_plan(m.fact_inventory, m.dim_product, totals(m), MAPPING)


def channel(m, name):
    return plan(m).where(p.channel(CLOTHING, JEWELLERY) == name)


@query("P7_coverage", "SELECT product_id, stock, CASE WHEN velocity > 0.0001 THEN sign(stock) * ((200 * abs(stock) * all_days + sold) // (2 * sold))::double / 100 + 0.0::double ELSE 999.0::double END AS coverage_days FROM candidates")
def _(m):
    return rows(m).select("product_id", "stock", p.coverage().alias("coverage_days"))


@query("P8_purchase_channels", """
SELECT product_id, channel, quantity, cast(cost AS double) AS cost, cast(value AS double) AS value, coverage_days FROM purchase_plan""")
def _(m):
    return plan(m).select("product_id", p.channel(CLOTHING, JEWELLERY).alias("channel"), "quantity", dbl(F.col("cost")).alias("cost"), dbl(F.col("value")).alias("value"), "coverage_days")


define("supplier_items", """
SELECT supplier_id, article, size_code, cast(sum(stock) AS bigint) AS stock, cast(sum(quantity) AS bigint) AS quantity, sum(value) AS value,
  round(cast(sum(cast(coverage_days AS decimal(20,2))) AS double) / count(*), 2) AS coverage_days, count(*) AS skus, max(category) AS category
FROM purchase_plan WHERE channel = 'SUPPLIER' GROUP BY 1, 2, 3""")


@query("P9_supplier_rollup", """
SELECT supplier_id, count(*) AS items, cast(sum(quantity) AS bigint) AS quantity, round(cast(sum(value) AS double), 2) AS value, cast(sum(stock) AS bigint) AS stock,
  round(cast(sum(cast(coverage_days AS decimal(20,2))) AS double) / count(*), 1) AS coverage_days, string_agg(DISTINCT category, ', ' ORDER BY category) AS categories,
  bool_or(contains(upper(article), 'RING')) OR coalesce(supplier_id IN (3, 11, 27), false) AS jewellery
FROM supplier_items GROUP BY 1 ORDER BY coverage_days, supplier_id NULLS FIRST LIMIT 20""")
def _(m):
    return p.supplier_rollup(p.supplier_items(channel(m, "SUPPLIER")), JEWELLERS)


@query("S10_supplier_documents", """
SELECT supplier_id, count(*) AS items, max(rank) AS last_rank, cast(sum(quantity) AS bigint) AS quantity, cast(max((rank - 1) // 50) + 1 AS int) AS pages
FROM (SELECT *, cast(row_number() OVER (PARTITION BY supplier_id ORDER BY coverage_days, quantity DESC, article, size_code) AS int) AS rank FROM supplier_items) GROUP BY 1""")
def _(m):
    docs = p.supplier_documents(p.supplier_items(channel(m, "SUPPLIER")))
    path = work_path(m.spark, "supplier-documents")
    tables.write_json(docs, path)
    back = m.spark.read.schema(docs.schema).json(path)
    items = tables.flatten(back, "items", ["supplier_id", "page"], ["rank", "quantity"])
    return items.groupBy("supplier_id").agg(
        F.count(F.lit(1)).alias("items"), F.max("rank").alias("last_rank"), F.sum("quantity").alias("quantity"), (F.max("page") + 1).alias("pages")
    )


def _rollup_sql(chan, by, k):
    return f"""WITH s AS (SELECT {by}, size_code, cast(sum(stock) AS bigint) AS stock, cast(sum(quantity) AS bigint) AS quantity, count(*) AS skus FROM purchase_plan WHERE channel = '{chan}' GROUP BY 1, 2),
    t AS (SELECT {by}, cast(sum(quantity) AS bigint) AS total_needed FROM s GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {k}) SELECT * FROM s JOIN t USING ({by})"""


@query("P10_clothing_rollup", _rollup_sql("CLOTHING", "article", 30))
def _(m):
    return p.size_rollup(channel(m, "CLOTHING"), "article", 30)


@query("P11_jewellery_rollup", _rollup_sql("JEWELLERY", "product_type", 20))
def _(m):
    return p.size_rollup(channel(m, "JEWELLERY"), "product_type", 20)


@query("P12_category_overview", """
SELECT *, forecast > 2 * stock AS critical FROM (SELECT category, count(*) AS products, cast(sum(stock) AS bigint) AS stock, round(cast(sum(cast(forecast AS decimal(18,1))) AS double), 1) AS forecast,
  cast(sum(CASE WHEN needed THEN quantity ELSE 0 END) AS bigint) AS quantity, round(cast(sum(CASE WHEN needed THEN quantity ELSE 0 END * unit_cost) AS double), 2) AS value FROM needs GROUP BY 1)""")
def _(m):
    return p.category_overview(needs(m))


@query("P13_plan_totals", """
SELECT coalesce(channel, 'TOTAL') AS channel, count(*) AS products, count(DISTINCT supplier_id) AS suppliers, cast(sum(quantity) AS bigint) AS quantity, round(cast(sum(value) AS double), 2) AS value
FROM purchase_plan GROUP BY ROLLUP (channel)""")
def _(m):
    return p.plan_totals(plan(m), CLOTHING, JEWELLERY)


@query("P14_category_need", """
WITH f AS (SELECT category, round(sum(yhat), 0) AS forecast FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY ds) AS r FROM forecast_days) WHERE r <= 120 GROUP BY 1),
s AS (SELECT category, sum(stock) AS stock FROM snapshot JOIN dim_product USING (product_id) WHERE status = 'ACTIVE' GROUP BY 1)
SELECT category, cast(coalesce(stock, 0) AS bigint) AS stock, coalesce(forecast, 0.0::double) AS forecast, CASE WHEN forecast IS NULL THEN 0.0::double ELSE greatest(forecast - coalesce(stock, 0)::double, 0.0::double) END AS need,
  CASE WHEN coalesce(forecast, 0) > 0 THEN round(coalesce(stock, 0)::double / (forecast / 120), 0) ELSE 999.0::double END AS coverage_days FROM f FULL JOIN s USING (category)""")
def _(m):
    return p.category_need(forecast_days(m), snap(m), m.dim_product)


define("category_rates", """
SELECT category, round(cast(sum(CASE WHEN velocity > 0 THEN cast(velocity AS decimal(18,4)) END) AS double) / nullif(count(CASE WHEN velocity > 0 THEN 1 END), 0), 4) AS cv,
  round(cast(sum(CASE WHEN unit_cost > 0 THEN cast(unit_cost AS decimal(12,2)) END) AS double) / nullif(count(CASE WHEN unit_cost > 0 THEN 1 END), 0), 4) AS cc FROM supplier_products GROUP BY 1""")
define("filled_rates", """
SELECT product_id, supplier_id, category, stock, coalesce(CASE WHEN velocity > 0 THEN velocity END, cv, (SELECT round(avg(cast(cv AS decimal(18,4)))::double, 4) FROM category_rates), 0.02::double) AS velocity,
  coalesce(CASE WHEN unit_cost > 0 THEN unit_cost END, cc, (SELECT round(avg(cast(cc AS decimal(18,4)))::double, 4) FROM category_rates), 20.0::double) AS unit_cost
FROM supplier_products LEFT JOIN category_rates USING (category)""")
define("supplier_urgency", """
SELECT supplier_id, ['LOW', 'MEDIUM', 'HIGH', 'CRITICAL'][max(list_position(['LOW', 'MEDIUM', 'HIGH', 'CRITICAL'], urgency))] AS urgency, min(coverage_days) AS min_coverage, count(*) AS alerts
FROM alert_rows WHERE supplier_id IS NOT NULL GROUP BY 1""")
define("escalating", """
SELECT supplier_id, cast(target_days AS int) AS target_days, items, quantity, cast(cost AS double) AS cost, cost >= 10000 AS meets_minimum, alerts, urgency, min_coverage FROM (
  SELECT *, row_number() OVER (PARTITION BY supplier_id ORDER BY target_days) AS r FROM (
    SELECT supplier_id, target_days, count(*) AS items, cast(sum(q) AS bigint) AS quantity, sum(cast(round(q * unit_cost, 2) AS decimal(18,2))) AS cost
    FROM (SELECT *, cast(greatest(floor(target_days * velocity - stock + 0.5::double), 1) AS bigint) AS q FROM filled_rates, (VALUES (120), (150), (180)) t(target_days) WHERE stock < target_days * velocity)
    GROUP BY 1, 2) WHERE cost >= 10000 OR target_days = 180) JOIN supplier_urgency USING (supplier_id) WHERE r = 1""")


@query("P15_escalating_orders", "SELECT * FROM escalating")
def _(m):
    return p.escalating_orders(supplier_products(m), alerts(m))


@query("P16_fallback_rates", "SELECT product_id, round(velocity, 4) AS velocity, round(unit_cost, 4) AS unit_cost FROM filled_rates")
def _(m):
    return p.fallback_rates(supplier_products(m)).select("product_id", F.round("velocity", 4).alias("velocity"), F.round("unit_cost", 4).alias("unit_cost"))


@query("P17_order_ranking", """
SELECT *, cast(CASE urgency WHEN 'CRITICAL' THEN 0 WHEN 'HIGH' THEN 1 ELSE 2 END AS int) AS level FROM escalating ORDER BY level, min_coverage, supplier_id LIMIT 50""")
def _(m):
    return p.ranked_orders(p.escalating_orders(supplier_products(m), alerts(m)))


@query("P17_supplier_urgency", "SELECT * FROM supplier_urgency")
def _(m):
    return p.supplier_urgency(alerts(m))


@query("P18_coverage_tags", """
SELECT tag, count(*) AS products, cast(sum(stock) AS bigint) AS stock FROM (SELECT *, CASE WHEN stock / nullif(forecast, 0) < 0.5 THEN 'CRITICAL' WHEN stock / nullif(forecast, 0) <= 1.5 THEN 'OK' ELSE 'EXCESS' END AS tag FROM needs) GROUP BY 1""")
def _(m):
    return needs(m).groupBy(p.coverage_tag().alias("tag")).agg(F.count(F.lit(1)).alias("products"), F.sum("stock").alias("stock"))


@query("P19_allowed_orders", """
WITH o AS (SELECT f.supplier_id, order_no, order_date, count(*) AS lines, sum(gross) AS value FROM fact_purchases f JOIN dim_product d USING (product_id)
  WHERE status NOT IN ('DISCONTINUED', 'INACTIVE', 'CLEARANCE') GROUP BY 1, 2, 3 HAVING sum(gross) >= 10000)
SELECT supplier_id, order_no, order_date, lines, cast(value AS double) AS value, cast(date_trunc('month', order_date) AS date) AS month FROM o
QUALIFY row_number() OVER (PARTITION BY supplier_id, date_trunc('month', order_date) ORDER BY value DESC, order_no) = 1""")
def _(m):
    return p.allowed_orders(m.fact_purchases, m.dim_product)
