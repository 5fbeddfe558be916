"""Sales KPI queries."""

from storeops.operators import sales as s
from storeops.plans.registry import query

PERIOD = ("1996-01-01", "1999-12-31")


@query("K1_sales_kpis", """
SELECT cast(sum(net) AS double) AS revenue, cast(sum(qty) AS bigint) AS volume,
       round(cast(sum(net) AS double) / nullif(count(DISTINCT ticket), 0), 4) AS avg_ticket,
       round(cast(sum(net) - sum(cost) AS double) / nullif(cast(sum(net) AS double), 0), 4) AS margin
FROM fact_sales WHERE sale_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'""")
def _(m):
    return s.sales_kpis(s.sales_slice(m.fact_sales, first=PERIOD[0], last=PERIOD[1]))


@query("K2_revenue_by_month", """
SELECT cast(year(sale_date) AS int) AS year, cast(month(sale_date) AS int) AS month, monthname(sale_date) AS month_name,
       cast(sum(net) AS double) AS revenue
FROM fact_sales GROUP BY 1, 2, 3""")
def _(m):
    return s.revenue_by_month(m.fact_sales)


@query("K3_sales_by_store", """
SELECT store, count(*) AS sales_rows, cast(sum(qty) AS bigint) AS pieces, cast(sum(net) AS double) AS revenue,
       round(cast(sum(net) AS double) / count(*), 4) AS mean_value
FROM fact_sales JOIN dim_store USING (store_id) GROUP BY store""")
def _(m):
    return s.sales_by_store(m.fact_sales, m.dim_store)


@query("K4_weekday_profile", """
SELECT cast(dayofweek(sale_date) + 1 AS int) AS weekday, dayname(sale_date) AS weekday_name, count(*) AS sales_rows,
       cast(sum(net) AS double) AS revenue
FROM fact_sales GROUP BY 1, 2""")
def _(m):
    return s.weekday_profile(m.fact_sales)


@query("K5_category_distribution", """
WITH per AS (SELECT category, cast(sum(qty) AS bigint) AS pieces, cast(sum(net) AS double) AS revenue
  FROM fact_sales JOIN dim_product USING (product_id) GROUP BY category)
SELECT *, round(100.0::double * pieces / (SELECT sum(pieces) FROM per)::double, 2) AS share_pct FROM per""")
def _(m):
    return s.category_distribution(m.fact_sales, m.dim_product)


@query("K6_top_products", """
WITH per AS (SELECT product_type, category, cast(sum(qty) AS bigint) AS pieces
  FROM fact_sales JOIN dim_product USING (product_id) GROUP BY ALL)
SELECT *, round(100.0::double * pieces / (SELECT sum(pieces) FROM per)::double, 2) AS share_pct FROM per
ORDER BY pieces DESC, product_type, category LIMIT 10""")
def _(m):
    return s.top_products(m.fact_sales, m.dim_product)


@query("K7_period_deltas", """
WITH mm AS (SELECT cast(year(sale_date) * 100 + month(sale_date) AS int) AS month, cast(sum(net) AS double) AS revenue,
    cast(sum(qty) AS bigint) AS volume, cast(sum(net) AS double) / count(DISTINCT ticket) AS ticket,
    cast(sum(net) - sum(cost) AS double) / cast(sum(net) AS double) AS margin
  FROM fact_sales GROUP BY 1),
pp AS (SELECT *, lag(revenue) OVER w AS r0, lag(volume) OVER w AS v0, lag(ticket) OVER w AS t0, lag(margin) OVER w AS m0
  FROM mm WINDOW w AS (ORDER BY month))
SELECT month, revenue, volume, round(ticket, 4) AS avg_ticket, round(margin, 4) AS margin,
       round((revenue - r0) * 100.0::double / r0, 2) AS revenue_pct, round((volume - v0) * 100.0::double / v0, 2) AS volume_pct,
       round((ticket - t0) * 100.0::double / t0, 2) AS ticket_pct, round((margin - m0) * 100.0::double, 2) AS margin_points
FROM pp""")
def _(m):
    return s.period_deltas(m.fact_sales)


@query("K8_store_detail", """
SELECT store, count(DISTINCT ticket) AS sales, count(*) AS items, cast(sum(net) AS double) AS revenue,
       round(cast(sum(net) AS double) / count(DISTINCT ticket), 4) AS avg_ticket, cast(sum(cost) AS double) AS cost,
       round(cast(sum(net) - sum(cost) AS double) / cast(sum(net) AS double), 4) AS margin
FROM fact_sales JOIN dim_store USING (store_id) GROUP BY store""")
def _(m):
    return s.store_detail(m.fact_sales, m.dim_store)


@query("K9_drill_down", """
SELECT store, category, cast(sum(qty) AS bigint) AS pieces, cast(sum(net) AS double) AS revenue,
       cast(grouping_id(store, category) AS int) AS level
FROM fact_sales JOIN dim_product USING (product_id) JOIN dim_store USING (store_id)
GROUP BY ROLLUP (store, category)""")
def _(m):
    return s.drill_down(m.fact_sales, m.dim_product, m.dim_store)


@query("K9_sales_slice", """
SELECT store_id, count(*) AS sales_rows, cast(sum(net) AS double) AS revenue
FROM fact_sales JOIN dim_product USING (product_id)
WHERE sale_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' AND store_id IN (1, 2, 3, 5, 8) AND seller_id BETWEEN 3 AND 30
  AND category IN ('STANDARD', 'PROMO') AND line <> 'LINE-4' GROUP BY store_id""")
def _(m):
    from pyspark.sql import functions as F

    part = s.sales_slice(
        m.fact_sales, m.dim_product, first=PERIOD[0], last=PERIOD[1], stores=[1, 2, 3, 5, 8],
        sellers=list(range(3, 31)), categories=["STANDARD", "PROMO"], lines=[f"LINE-{i}" for i in range(4)],
    )
    return part.groupBy("store_id").agg(
        F.count(F.lit(1)).alias("sales_rows"), F.sum("net").cast("double").alias("revenue")
    )


@query("K10_store_city_month", """
SELECT store, city, strftime(sale_date, '%Y-%m') AS period, cast(sum(qty) AS bigint) AS pieces,
       cast(sum(net) AS double) AS revenue, count(*) AS transactions
FROM fact_sales JOIN dim_store USING (store_id) GROUP BY 1, 2, 3""")
def _(m):
    return s.store_city_month(m.fact_sales, m.dim_store)


_HISTORY = """
SELECT cast(year(sale_date) AS int) AS year, cast(month(sale_date) AS int) AS month, category, cast(sum(qty) AS bigint) AS qty,
       cast(sum(net) AS double) AS revenue, count(DISTINCT product_id) AS skus, count(*) AS transactions,
       strftime(sale_date, '%Y-%m') AS year_month
FROM fact_sales JOIN dim_product USING (product_id) GROUP BY 1, 2, 3, 8"""


@query("I29_history_by_month_category", _HISTORY)
def _(m):
    return s.history_by_month_category(m.fact_sales, m.dim_product)


_MONTHS = """
SELECT cast(year(sale_date) AS int) AS year, cast(month(sale_date) AS int) AS month, cast(sum(qty) AS bigint) AS qty,
       cast(sum(net) AS double) AS revenue, count(DISTINCT product_id) AS skus, count(*) AS transactions,
       round(cast(sum(qty) AS double) / 30, 1) AS avg_daily_qty
FROM fact_sales GROUP BY 1, 2"""


@query("I29_history_by_month", _MONTHS)
def _(m):
    return s.history_by_month(m.fact_sales)


@query("I30_year_grid", f"""
WITH mm AS ({_MONTHS}), g AS (SELECT cast(unnest(generate_series(1, 12)) AS int) AS month),
a AS (SELECT * FROM mm WHERE year = 2001), b AS (SELECT * FROM mm WHERE year = 1998)
SELECT g.month, monthname(make_date(2000, g.month, 1)) AS month_name, cast(coalesce(a.qty, 0) AS bigint) AS plan_qty,
       coalesce(a.revenue, 0.0::double) AS plan_value, cast(coalesce(b.qty, 0) AS bigint) AS hist_qty,
       coalesce(b.revenue, 0.0::double) AS hist_value
FROM g LEFT JOIN a USING (month) LEFT JOIN b USING (month)""")
def _(m):
    return s.year_grid(s.history_by_month(m.fact_sales), (2001, 1998))


@query("I31_season_profile", f"""
WITH h AS ({_HISTORY}) SELECT month, cast(sum(qty) AS bigint) AS qty FROM h WHERE category = 'PROMO' GROUP BY month""")
def _(m):
    return s.season_profile(s.history_by_month_category(m.fact_sales, m.dim_product), "PROMO")


@query("I32_compare_periods", """
SELECT CASE WHEN sale_date < DATE '1999-01-01' THEN 'A' ELSE 'B' END AS period, cast(sum(qty) AS bigint) AS qty,
       cast(sum(net) AS double) AS revenue,
       round(cast(sum(qty) AS double) / (CASE WHEN sale_date < DATE '1999-01-01' THEN 365 ELSE 360 END), 1) AS daily_qty
FROM fact_sales
WHERE sale_date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31' OR sale_date BETWEEN DATE '2000-01-01' AND DATE '2000-12-25'
GROUP BY period, CASE WHEN sale_date < DATE '1999-01-01' THEN 365 ELSE 360 END""")
def _(m):
    return s.compare_periods(m.fact_sales, ("1998-01-01", "1998-12-31"), ("2000-01-01", "2000-12-25"))
