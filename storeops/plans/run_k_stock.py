"""Inventory KPI queries."""

from pyspark.sql import functions as F

from storeops.operators import dims, stock as k
from storeops.plans.oracle import define
from storeops.plans.registry import query

CLOTHING = "LARGE"
JEWELLERY = "SMALL"


def snap(m):
    return k.latest_stock(m.fact_inventory)


define("snap_products", "SELECT s.*, p.* EXCLUDE (product_id), coalesce(p.unit_cost, 0) AS cost0 FROM snapshot s JOIN dim_product p USING (product_id)")


@query("K11_inventory_kpis", """
SELECT cast(sum(stock * cost0) AS double) AS stock_value, round(sum(qty_sold)::double / avg(stock::double), 4) AS turnover,
  round((sum(stock)::double / count(*)) / (sum(qty_sold)::double / count(*)) * 30, 4) AS coverage_days, count(*) FILTER (stock = 0) AS stock_outs
FROM snap_products""")
def _(m):
    return k.inventory_kpis(snap(m), m.dim_product)


@query("K12_top_stock_value", """
SELECT product_type, category, cast(sum(stock) AS bigint) AS stock, cast(sum(stock * cost0) AS double) AS stock_value FROM snap_products
WHERE stock > 0 GROUP BY 1, 2 ORDER BY 4 DESC, 1, 2 LIMIT 10""")
def _(m):
    return k.top_stock_value(snap(m), m.dim_product)


@query("K13_turnover_by_category", """
SELECT category, cast(sum(qty_sold) AS bigint) AS sold, round(sum(stock)::double / count(*), 4) AS mean_stock,
  CASE WHEN sum(stock) > 0 THEN round(sum(qty_sold)::double / (sum(stock)::double / count(*)), 4) ELSE 0 END AS turnover
FROM fact_inventory JOIN dim_product USING (product_id) GROUP BY 1""")
def _(m):
    return k.turnover_by_category(m.fact_inventory, m.dim_product)


_COV = "CASE WHEN qty_sold > 0 THEN round(stock::double / qty_sold::double * 30, 4) ELSE 999.0::double END"
_BAND = "CASE WHEN coverage_days < 30 THEN 'CRITICAL' WHEN coverage_days <= 60 THEN 'ATTENTION' ELSE 'OK' END"


@query("K14_critical_products", f"""
SELECT product_id, product_type, category, stock, qty_sold, {_COV} AS coverage_days FROM snap_products WHERE stock <= 10
ORDER BY coverage_days, product_id LIMIT 20""")
def _(m):
    return k.critical_products(snap(m), m.dim_product)


@query("K15_coverage_bands", f"""
SELECT {_BAND} AS band, count(*) AS products, cast(sum(stock) AS bigint) AS stock FROM (SELECT *, {_COV} AS coverage_days FROM snapshot) GROUP BY 1""")
def _(m):
    return k.coverage_bands(snap(m))


@query("K15_category_coverage", f"""
SELECT category, coverage_days, {_BAND} AS band FROM (SELECT category, {_COV} AS coverage_days FROM (
  SELECT category, sum(stock) AS stock, sum(qty_sold) AS qty_sold FROM snap_products GROUP BY 1))""")
def _(m):
    return k.category_coverage(snap(m), m.dim_product)


define("month_grid", """
SELECT product_id, month, month_end, arg_max(stock, move_date) AS stock
FROM (SELECT DISTINCT cast(year(move_date) * 100 + month(move_date) AS int) AS month, last_day(move_date) AS month_end FROM fact_inventory)
JOIN fact_inventory ON move_date <= month_end GROUP BY ALL""")
define("month_stock", """
SELECT month, cast(sum(stock) AS bigint) AS stock, cast(sum(stock * coalesce(unit_cost, 0)) AS double) AS stock_value,
  count(*) FILTER (stock <= 0) AS stock_outs FROM month_grid JOIN dim_product USING (product_id) GROUP BY 1""")
define("month_sold", "SELECT cast(year(move_date) * 100 + month(move_date) AS int) AS month, cast(sum(qty_sold) AS bigint) AS sold FROM fact_inventory GROUP BY 1")


@query("K16_stock_and_sales", "SELECT month, stock, sold FROM month_stock JOIN month_sold USING (month)")
def _(m):
    return k.stock_and_sales(m.fact_inventory, m.dim_product)


@query("K17_inventory_deltas", """
WITH l AS (SELECT month, stock_value, stock_outs, round(sold::double / nullif(stock, 0)::double, 4) AS turnover,
  round(stock::double / nullif(sold, 0)::double * 30, 4) AS coverage_days FROM month_stock JOIN month_sold USING (month)),
p AS (SELECT *, lag(stock_value) OVER w AS v0, lag(turnover) OVER w AS t0, lag(coverage_days) OVER w AS c0, lag(stock_outs) OVER w AS o0 FROM l WINDOW w AS (ORDER BY month))
SELECT month, stock_value, stock_outs, turnover, coverage_days, round((stock_value - v0) * 100.0::double / v0, 2) AS value_pct,
  round((turnover - t0) * 100.0::double / t0, 2) AS turnover_pct, round(coverage_days - c0, 4) AS coverage_change, stock_outs - o0 AS stock_out_change FROM p""")
def _(m):
    return k.inventory_deltas(m.fact_inventory, m.dim_product)


@query("K18_movement_summary", """
SELECT count(*) AS sale_rows, min(move_date) AS first_day, max(move_date) AS last_day, count(DISTINCT store_id) AS stores, count(DISTINCT category) AS categories
FROM movements JOIN dim_product USING (product_id) WHERE qty_sold > 0""")
def _(m):
    return k.movement_summary(m.movements, m.dim_product)


@query("K19_movement_by_store", """
SELECT store_id, store, count(*) AS sale_rows, cast(sum(qty_sold) AS bigint) AS sold FROM movements JOIN dim_store USING (store_id) WHERE qty_sold > 0 GROUP BY 1, 2""")
def _(m):
    return k.movement_by_store(m.movements, m.dim_store)


@query("K19_movement_by_category", """
SELECT category, count(*) AS sale_rows, cast(sum(qty_sold) AS bigint) AS sold FROM movements JOIN dim_product USING (product_id) WHERE qty_sold > 0 GROUP BY 1""")
def _(m):
    return k.movement_by_category(m.movements, m.dim_product)


@query("K19_movement_by_month", """
SELECT cast(year(move_date) * 100 + month(move_date) AS int) AS month, cast(sum(qty_sold) AS bigint) AS sold FROM movements WHERE qty_sold > 0 GROUP BY 1""")
def _(m):
    return k.movement_by_month(m.movements)


@query("K20_product_lookup", """
SELECT product_id, article, product_type, category, line, collection, status, supplier_id, cast(unit_cost AS double) AS unit_cost FROM dim_product WHERE status = 'ACTIVE'""")
def _(m):
    cols = ["product_id", "article", "product_type", "category", "line", "collection", "status", "supplier_id"]
    return dims.current(m.dim_product, ["ACTIVE"]).select(*cols, F.col("unit_cost").cast("double").alias("unit_cost"))


define("store_stock", """
SELECT product_id, store_id, store, stock FROM (SELECT product_id, store_id, arg_max(stock, move_date) AS stock FROM fact_store_inventory GROUP BY 1, 2)
JOIN dim_store USING (store_id) WHERE stock > 0""")


@query("K21_stock_by_store", "SELECT * FROM store_stock")
def _(m):
    return k.stock_by_store(m.fact_store_inventory, m.dim_store)


@query("K21_stores_per_product", """
SELECT product_id, string_agg(i, ', ' ORDER BY i) AS stores, cast(sum(stock) AS bigint) AS stock
FROM (SELECT product_id, stock, concat(store, ':', cast(stock AS varchar)) AS i FROM store_stock) GROUP BY 1""")
def _(m):
    return k.stores_per_product(k.stock_by_store(m.fact_store_inventory, m.dim_store))


@query("K22_status_histogram", """
SELECT status, count(*) AS products FROM dim_product GROUP BY 1""")
def _(m):
    return k.status_histogram(m.dim_product)


define("trailing_sales", """
SELECT product_id, cast(coalesce(sum(CASE WHEN recent THEN qty END), 0) AS bigint) AS recent_qty, count(DISTINCT CASE WHEN recent THEN sale_date END) AS recent_days,
  max(sale_date) AS last_sale FROM (SELECT *, sale_date > (SELECT max(sale_date) - 90 FROM fact_sales) AS recent FROM fact_sales) GROUP BY 1""")
define("supplier_products", """
SELECT product_id, article, category, line, supplier_id, supplier, supplier_category, cast(unit_cost AS double) AS unit_cost, stock, last_sale,
  round(recent_qty::double / 90, 4) AS velocity, CASE WHEN recent_qty > 0 THEN round(stock::double / (recent_qty::double / 90), 2) END AS coverage_days
FROM dim_product JOIN snapshot USING (product_id) LEFT JOIN trailing_sales USING (product_id) LEFT JOIN dim_supplier USING (supplier_id)
WHERE status = 'ACTIVE' AND stock > 0""")


def supplier_products(m):
    return k.supplier_products(snap(m), m.dim_product, m.dim_supplier, m.fact_sales)


@query("K23_supplier_products", "SELECT * FROM supplier_products")
def _(m):
    return supplier_products(m)


@query("K24_supplier_summary", """
SELECT supplier, supplier_category, count(*) AS products, cast(sum(stock) AS bigint) AS stock,
  round(cast(sum(cast(coverage_days AS decimal(18,2))) AS double) / nullif(count(coverage_days), 0), 4) AS mean_coverage,
  cast(sum(stock * cast(coalesce(unit_cost, 0) AS decimal(12,2))) AS double) AS stock_value
FROM supplier_products WHERE supplier_id IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 3""")
def _(m):
    return k.supplier_summary(supplier_products(m))


define("active_stock", "SELECT p.*, stock, coalesce(unit_cost, 0) AS cost0 FROM dim_product p LEFT JOIN snapshot USING (product_id) WHERE status = 'ACTIVE'")


@query("K25_headline", f"""
SELECT count(DISTINCT supplier_id) AS suppliers, count(*) FILTER (category = '{CLOTHING}' AND coalesce(stock, 0) <= 0) AS clothing_out_of_stock,
  round(cast(sum(coalesce(stock, 0) * cost0) AS double), 0) AS stock_value FROM active_stock""")
def _(m):
    return k.headline(snap(m), m.dim_product, CLOTHING)


@query("K26_clothing_need", f"""
WITH s AS (SELECT product_id, sum(qty) AS qty FROM fact_sales GROUP BY 1),
g AS (SELECT product_type, coalesce(size_code, 'ONE') AS size, cast(coalesce(sum(stock), 0) AS bigint) AS stock, coalesce(sum(qty), 0) AS sold,
  cast(round(coalesce(sum(qty), 0)::double * 17 / 52, 0) AS bigint) AS need
  FROM active_stock LEFT JOIN s USING (product_id) WHERE category = '{CLOTHING}' GROUP BY 1, 2)
SELECT product_type, size, stock, need, stock - need AS difference, CASE WHEN stock >= need THEN 'OK' ELSE 'BUY' END AS action FROM g WHERE stock > 0 OR sold > 0""")
def _(m):
    return k.clothing_need(snap(m), m.dim_product, m.fact_sales, CLOTHING)


@query("K27_other_suppliers", f"""
SELECT coalesce(supplier, 'NO SUPPLIER') AS supplier, count(*) AS products, round(sum(coalesce(stock, 0))::double / count(*), 1) AS mean_stock,
  round(cast(sum(coalesce(stock, 0) * cost0) AS double), 0) AS stock_value,
  CASE WHEN round(cast(sum(coalesce(stock, 0) * cost0) AS double), 0) >= 10000 THEN 'YES' ELSE 'NO' END AS reaches_minimum
FROM active_stock LEFT JOIN dim_supplier USING (supplier_id) WHERE category <> '{CLOTHING}' GROUP BY 1""")
def _(m):
    return k.other_suppliers(snap(m), m.dim_product, m.dim_supplier, CLOTHING)


@query("K28_weekly_mean", """
WITH w AS (SELECT category, date_trunc('week', sale_date) AS week, sum(qty) AS qty FROM fact_sales JOIN dim_product USING (product_id) GROUP BY 1, 2),
a AS (SELECT category, round(sum(qty)::double / count(*), 1) AS weekly_mean FROM w WHERE qty > 0 GROUP BY 1)
SELECT *, round(weekly_mean * 26, 0) AS projection FROM a""")
def _(m):
    return k.weekly_mean(m.fact_sales, m.dim_product)


@query("K29_week_labels", """
SELECT cast(i AS int) AS week_ahead, cast(d + cast(7 * i AS int) AS date) AS day,
  concat('W', cast(weekofyear(d + cast(7 * i AS int)) AS varchar), '/', cast(isoyear(d + cast(7 * i AS int)) AS varchar)) AS label
FROM (SELECT max(sale_date) AS d FROM fact_sales), (SELECT unnest(generate_series(1, 26)) AS i)""")
def _(m):
    return k.week_labels(m.fact_sales)


@query("K30_cost_statistics", """
SELECT category, count(*) AS products, round(cast(sum(unit_cost) FILTER (unit_cost > 0) AS double) / nullif(count(*) FILTER (unit_cost > 0), 0), 2) AS mean_cost,
  count(*) FILTER (unit_cost IS NULL OR unit_cost <= 0) AS without_cost FROM dim_product GROUP BY 1""")
def _(m):
    return k.cost_statistics(m.dim_product)


@query("K31_supplier_presence", """
SELECT category, count(*) AS products, count(supplier_id) AS with_supplier, count(*) FILTER (supplier_id IS NULL) AS without_supplier FROM dim_product GROUP BY 1""")
def _(m):
    return k.supplier_presence(m.dim_product)


@query("K31_top_suppliers", f"""
SELECT supplier_id, count(*) AS products FROM dim_product WHERE category = '{CLOTHING}' AND supplier_id IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def _(m):
    return k.top_suppliers(m.dim_product, CLOTHING)


define("product_sold", """
SELECT product_id, cast(sum(qty_sold) AS bigint) AS sold, count(*) FILTER (qty_sold > 0) AS selling_days,
  (SELECT count(DISTINCT move_date) FROM fact_inventory) AS all_days FROM fact_inventory GROUP BY 1""")


@query("K32_velocity_comparison", """
SELECT product_id, product_type, category, sold, selling_days, round(sold::double / selling_days::double, 4) AS velocity_selling,
  round(sold::double / all_days::double, 4) AS velocity_calendar, round(sold::double / selling_days::double * 120, 0) AS projection_selling,
  round(sold::double / all_days::double * 120, 0) AS projection_calendar
FROM product_sold JOIN dim_product USING (product_id) WHERE sold > 0""")
def _(m):
    return k.velocity_comparison(m.fact_inventory, m.dim_product)


@query("K33_observed_days", """
SELECT count(DISTINCT move_date) AS days, count(DISTINCT CASE WHEN qty_sold > 0 THEN move_date END) AS selling_days FROM fact_inventory""")
def _(m):
    return k.observed_days(m.fact_inventory)


@query("K34_stocked_products", """
SELECT category, count(DISTINCT product_id) AS products FROM fact_inventory JOIN dim_product USING (product_id) WHERE stock > 0 GROUP BY 1""")
def _(m):
    return k.stocked_products(m.fact_inventory, m.dim_product)


@query("K35_source_differences", """
WITH a AS (SELECT DISTINCT concat(article, '/', product_type) AS item FROM dim_product WHERE status <> 'INACTIVE'),
b AS (SELECT DISTINCT concat(article, '/', product_type) AS item FROM dim_product WHERE supplier_id IS NOT NULL)
SELECT item, 'A' AS only_in FROM a WHERE item NOT IN (SELECT item FROM b) UNION ALL SELECT item, 'B' FROM b WHERE item NOT IN (SELECT item FROM a)""")
def _(m):
    items = m.dim_product.withColumn("item", F.concat_ws("/", "article", "product_type"))
    return k.differences(items.where(F.col("status") != "INACTIVE"), items.where(F.col("supplier_id").isNotNull()), "item")


@query("K36_assortment_profile", """
SELECT category, line, collection, count(*) AS skus, round(cast(sum(unit_cost) AS double) / nullif(count(unit_cost), 0), 4) AS mean_cost,
  round(cast(sum(net) AS double) / nullif(sum(pieces), 0)::double, 4) AS mean_price, cast(coalesce(sum(stock), 0) AS bigint) AS stock, cast(coalesce(sum(recent_qty), 0) AS bigint) AS recent_qty,
  round(sum(recent_qty)::double / nullif(90 * count(*) FILTER (recent_qty > 0), 0)::double, 4) AS velocity_per_sku,
  cast(coalesce(sum(recent_days), 0) AS bigint) AS selling_days
FROM dim_product LEFT JOIN snapshot USING (product_id) LEFT JOIN trailing_sales USING (product_id)
LEFT JOIN (SELECT product_id, sum(net) AS net, sum(qty) AS pieces FROM fact_sales WHERE qty > 0 GROUP BY 1) USING (product_id) GROUP BY 1, 2, 3""")
def _(m):
    return k.assortment_profile(snap(m), m.dim_product, m.fact_sales)


@query("K36_supplier_orders", """
SELECT supplier_id, supplier, supplier_category, count(DISTINCT order_no) AS orders, round(sum(qty)::double / count(*), 4) AS mean_qty,
  round(cast(sum(gross) AS double) / count(*), 4) AS mean_value, min(order_date) AS first_order, max(order_date) AS last_order
FROM fact_purchases JOIN dim_supplier USING (supplier_id) GROUP BY 1, 2, 3""")
def _(m):
    return k.supplier_orders(m.fact_purchases, m.dim_supplier)
