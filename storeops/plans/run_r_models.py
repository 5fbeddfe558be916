"""Elasticity, regression and forecast queries."""

from pyspark.sql import functions as F

from storeops.functions.columns import dbl
from storeops.operators import elasticity as el, forecast as fc, holidays, seasonal
from storeops.plans.oracle import define, define_sweep
from storeops.plans.registry import query
from storeops.session import materialize

define("price_months", """
SELECT category, cast(date_trunc('month', sale_date) AS date) AS month, sum(qty)::double AS qty, cast(sum(net) AS double) / count(*) AS price, count(*) AS transactions,
  ln(sum(qty)::double) AS ln_qty, ln(cast(sum(net) AS double) / count(*)) AS ln_price
FROM fact_sales JOIN dim_product USING (product_id) WHERE qty > 0 AND net > 0 GROUP BY 1, 2""")
define("elasticities", """
SELECT category, count(*) AS n, regr_slope(ln_qty, ln_price) AS elasticity, regr_intercept(ln_qty, ln_price) AS intercept, regr_r2(ln_qty, ln_price) AS r2,
  corr(ln_qty, ln_price) AS r, avg(price) AS mean_price, sum(qty) AS qty, count(DISTINCT month) AS months FROM price_months GROUP BY 1 HAVING count(*) >= 3""")
_R6 = lambda *cols: ", ".join(f"round({c}, 6) AS {c}" for c in cols)


def rounded(df, *cols):
    return df.select(*[F.round(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns])


def months(m):
    return el.month_aggregates(m.fact_sales, m.dim_product)


@query("R1_price_months", f"SELECT category, month, qty, transactions, {_R6('price', 'ln_qty', 'ln_price')} FROM price_months")
def _(m):
    return rounded(months(m), "price", "ln_qty", "ln_price")


@query("R2_elasticity_by_category", f"SELECT category, n, qty, months, {_R6('elasticity', 'intercept', 'r2', 'r', 'mean_price')} FROM elasticities")
def _(m):
    return rounded(el.elasticity_by_category(months(m)), "elasticity", "intercept", "r2", "r", "mean_price")


@query("R3_pooled_elasticity", """
SELECT count(*) AS n, round(regr_slope(ln_qty, ln_price), 6) AS elasticity, round(regr_intercept(ln_qty, ln_price), 6) AS intercept,
  round(regr_r2(ln_qty, ln_price), 6) AS r2, round(corr(ln_qty, ln_price), 6) AS r FROM price_months""")
def _(m):
    return rounded(el.pooled_elasticity(months(m)), "elasticity", "intercept", "r2", "r")


@query("R4_elasticity_reading", """
SELECT category, CASE WHEN elasticity > 0.5 THEN 'ELASTIC (POSITIVE, MIX EFFECT)' WHEN elasticity > 0.1 THEN 'SLIGHTLY ELASTIC (POSITIVE)'
  WHEN elasticity > -0.1 THEN 'NEAR-UNIT ELASTIC' WHEN elasticity > -0.5 THEN 'SLIGHTLY INELASTIC' WHEN elasticity > -1.0 THEN 'INELASTIC'
  WHEN elasticity > -2.0 THEN 'ELASTIC' ELSE 'HIGHLY ELASTIC' END AS reading FROM elasticities""")
def _(m):
    return el.elasticity_by_category(months(m)).select("category", el.reading(F.col("elasticity")).alias("reading"))


@query("R5_revenue_effect", """
SELECT category, round(dp * 100, 1) AS price_pct, round(elasticity * dp * 100, 2) AS qty_pct, round(((1 + elasticity * dp) * (1 + dp) - 1) * 100, 2) AS revenue_pct
FROM elasticities, (SELECT unnest([-0.10::double, -0.05::double, 0.05::double, 0.10::double]) AS dp)""")
def _(m):
    return el.revenue_effect(el.elasticity_by_category(months(m)), [-0.10, -0.05, 0.05, 0.10])


@query("R6_price_variation", """
WITH s AS (SELECT product_id, count(*) AS sales, count(DISTINCT unit_cents) AS prices FROM unit_prices GROUP BY 1)
SELECT count(*) AS products, count(*) FILTER (prices = 1) AS single_price, round(100.0::double * count(*) FILTER (prices = 1)::double / count(*)::double, 2) AS single_price_pct,
  count(*) FILTER (sales >= 30 AND prices >= 2) AS fit_candidates FROM s""")
def _(m):
    return el.price_variation(m.fact_sales, min_sales=30)


define("weekly", """
SELECT category, cast(date_trunc('week', sale_date) AS date) AS week_start, cast(sum(qty) AS bigint) AS qty, cast(sum(net) AS double) AS revenue,
  count(DISTINCT product_id) AS skus, min(sale_date) AS first_day, cast(isoyear(date_trunc('week', sale_date)) * 100 + weekofyear(date_trunc('week', sale_date)) AS int) AS year_week
FROM fact_sales JOIN dim_product USING (product_id) WHERE sale_date >= DATE '1996-01-01' GROUP BY 1, 2, 7""")


def weekly(m):
    return fc.weekly_sales(m.fact_sales, m.dim_product, since="1996-01-01")


@query("R7_weekly_sales", "SELECT * FROM weekly")
def _(m):
    return weekly(m)


@query("R8_weekly_features", """
SELECT category, week_start, qty, round(ln(1 + qty::double), 6) AS y, cast((week_start - (SELECT min(week_start) FROM weekly)) // 7 AS int) AS t,
  cast(quarter(week_start) AS int) AS quarter FROM weekly""")
def _(m):
    return fc.weekly_features(weekly(m)).select("category", "week_start", "qty", F.round("y", 6).alias("y"), "t", "quarter")


# the regression in SQL: categories are swept out by their own sums, quarters and trend by Gauss-Jordan steps
define("reg_rows", """
SELECT category, ln(1 + qty::double) AS y, ((week_start - (SELECT min(week_start) FROM weekly)) // 7)::double AS t, quarter(week_start) AS q FROM weekly""", once=True)
define("reg_long", """
SELECT category, row, i, CASE i WHEN 4 THEN t WHEN 5 THEN y ELSE CASE WHEN q = i + 1 THEN 1.0::double ELSE 0.0::double END END AS x
FROM (SELECT *, row_number() OVER () AS row FROM reg_rows), (SELECT unnest(range(1, 6)) AS i)""", once=True)
define("reg_levels", "SELECT category, i, count(*)::double AS n, sum(x) / count(*) AS mean FROM reg_long GROUP BY 1, 2", once=True)
define("reg_within", """
SELECT 0 AS part, a.i, b.i AS j, sum((a.x - ma.mean) * (b.x - mb.mean)) AS v FROM reg_long a JOIN reg_long b USING (row)
  JOIN reg_levels ma ON ma.category = a.category AND ma.i = a.i JOIN reg_levels mb ON mb.category = b.category AND mb.i = b.i GROUP BY 1, 2, 3""", once=True)
_REG = define_sweep("reg_sweep", "reg_within", 4)
define("reg_fit", f"""
SELECT n, c + 4 AS k, (SELECT v FROM {_REG} WHERE i = 5 AND j = 5) AS rss, tss, (SELECT v FROM {_REG} WHERE i = 5 AND j = 5) / (n - c - 4) AS s2
FROM (SELECT count(*) AS n, var_pop(y) * count(*) AS tss, count(DISTINCT category) AS c FROM reg_rows)""", once=True)
define("reg_summary", """
SELECT n, k AS parameters, round(1 - rss / tss, 6) AS r2, round(1 - (rss / tss) * (n - 1) / (n - k), 6) AS r2_adj,
  round(2 * k + n * (ln(2 * pi() * rss / n) + 1), 6) AS aic, round(ln(n) * k + n * (ln(2 * pi() * rss / n) + 1), 6) AS bic FROM reg_fit""")


@query("R9_weekly_regression", "SELECT * FROM reg_summary")
def _(m):
    return rounded(fc.model_summary(fc.fit_weekly(fc.weekly_features(weekly(m)))), "r2", "r2_adj", "aic", "bic")


# p-values by Simpson's rule on Student's t, as an integral over the angle atan(t / sqrt(df))
define("reg_terms", f"""
WITH base AS (SELECT min(category) AS c FROM reg_rows),
d AS (SELECT a.category, a.i, a.n, CASE WHEN a.category = c THEN a.mean ELSE a.mean - b.mean END AS m, b.n AS bn, a.category = c AS is_base
  FROM reg_levels a, base, reg_levels b WHERE b.category = c AND b.i = a.i),
level AS (SELECT category, any_value(n) AS n, any_value(bn) AS bn, any_value(is_base) AS is_base, sum(CASE WHEN i = 5 THEN m ELSE -m * w.v END) AS b
  FROM d LEFT JOIN (SELECT i AS wi, v FROM {_REG} WHERE j = 5 AND i < 5) w ON wi = i GROUP BY 1),
spread AS (SELECT x.category, -sum(x.m * z.m * w.v) AS q FROM d x JOIN d z USING (category) JOIN {_REG} w ON w.i = x.i AND w.j = z.i WHERE x.i < 5 AND z.i < 5 GROUP BY 1)
SELECT CASE WHEN is_base THEN 'Intercept' ELSE concat('category=', category) END AS term, b AS coefficient,
  sqrt(s2 * (q + 1 / n + CASE WHEN is_base THEN 0 ELSE 1 / bn END)) AS se FROM level JOIN spread USING (category), (SELECT s2 FROM reg_fit)
UNION ALL
SELECT CASE w.i WHEN 4 THEN 't' ELSE concat('quarter=', w.i + 1) END, w.v, sqrt(-u.v * s2) FROM {_REG} w JOIN {_REG} u ON u.i = w.i AND u.j = w.i, (SELECT s2 FROM reg_fit)
WHERE w.j = 5 AND w.i < 5""", once=True)
_TAIL = lambda a: f"list_sum(list_transform(range(8001), lambda i: (CASE WHEN i IN (0, 8000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * (pi() / 2 - {a}) / 24000 * pow(cos({a} + (pi() / 2 - {a}) * i / 8000), (n - k - 1)::double)))"


@query("R10_coefficients", f"""
WITH p AS (SELECT term, coefficient, {_TAIL('atan(abs(coefficient / se) / sqrt(n - k))')} / {_TAIL('0.0::double')} AS p_value FROM reg_terms, reg_fit)
SELECT term, round(coefficient, 6) AS coefficient, round(p_value, 6) AS p_value,
  CASE WHEN p_value < 0.01 THEN '***' WHEN p_value < 0.05 THEN '**' WHEN p_value < 0.1 THEN '*' ELSE '' END AS stars,
  CASE WHEN term <> 't' THEN NULL WHEN p_value >= 0.05 THEN 'NO SIGNIFICANT TREND' WHEN coefficient > 0 THEN 'SIGNIFICANT GROWTH' ELSE 'SIGNIFICANT DECLINE' END AS reading FROM p""")
def _(m):
    out = fc.coefficients(fc.fit_weekly(fc.weekly_features(weekly(m))))
    return rounded(out.drop("se"), "coefficient", "p_value")


define("weekly_ahead", f"""
WITH g AS (SELECT category, week_ahead, cast((SELECT max(week_start) FROM weekly) + cast(7 * week_ahead AS int) AS date) AS week_start, (SELECT max(t) FROM reg_rows) + week_ahead AS t
  FROM (SELECT DISTINCT category FROM weekly), (SELECT unnest(range(1, 27)) AS week_ahead)),
x AS (SELECT g.category, week_ahead, week_start, i, l.n, l.mean, CASE WHEN i = 4 THEN t WHEN i = 5 THEN 0 WHEN quarter(week_start) = i + 1 THEN 1.0::double ELSE 0.0::double END - l.mean AS d
  FROM g JOIN reg_levels l USING (category)),
s AS (SELECT a.category, a.week_ahead, -sum(a.d * b.d * w.v) AS q FROM x a JOIN x b USING (category, week_ahead) JOIN {_REG} w ON w.i = a.i AND w.j = b.i WHERE a.i < 5 AND b.i < 5 GROUP BY 1, 2),
m AS (SELECT category, week_ahead, any_value(week_start) AS week_start, any_value(n) AS n, sum(CASE WHEN i = 5 THEN mean ELSE d * w.v END) AS mu
  FROM x LEFT JOIN (SELECT i AS wi, v FROM {_REG} WHERE j = 5 AND i < 5) w ON wi = i GROUP BY 1, 2),
f AS (SELECT category, cast(week_ahead AS int) AS week_ahead, week_start, mu, 1.96::double * sqrt(s2 * (1 / n + q)) AS half FROM m JOIN s USING (category, week_ahead), (SELECT s2 FROM reg_fit))
SELECT category, week_ahead, week_start, cast(isoyear(week_start) AS int) AS iso_year, cast(weekofyear(week_start) AS int) AS iso_week,
  greatest(round(exp(mu) - 1, 1), 0.0::double) AS mean, greatest(round(exp(greatest(mu - half, 0.0::double)) - 1, 1), 0.0::double) AS low, greatest(round(exp(mu + half) - 1, 1), 0.0::double) AS high FROM f""", once=True)


def weekly_ahead(m):
    features = fc.weekly_features(weekly(m))
    return fc.weekly_forecast(features, fc.fit_weekly(features))


@query("R11_weekly_forecast", "SELECT * FROM weekly_ahead")
def _(m):
    return weekly_ahead(m)


@query("R12_purchase_quantity", """
SELECT category, round(sum(mean), 1) AS mean_total, round(sum(low), 1) AS low_total, round(sum(high), 1) AS high_total, cast(count(*) AS int) AS weeks
FROM weekly_ahead WHERE week_ahead <= 18 GROUP BY 1""")
def _(m):
    return fc.purchase_quantity(weekly_ahead(m))


STORES = [3, 4, 6, 7, 8, 9, 15, 16, 20, 23]
define("demand", """
SELECT category, move_date AS ds, cast(sum(qty_sold) AS bigint) AS y FROM movements JOIN dim_product USING (product_id) WHERE qty_sold > 0 GROUP BY 1, 2""")
MAJOR = ["STANDARD", "MEDIUM", "LARGE", "PROMO"]
define("grouped_demand", """
SELECT CASE WHEN category IN ('STANDARD', 'MEDIUM', 'LARGE', 'PROMO') THEN category ELSE 'OTHER' END AS category, ds, cast(sum(y) AS bigint) AS y FROM demand GROUP BY 1, 2""")


def demand(m):
    return fc.daily_demand(m.movements, m.dim_product)


def grouped(m):
    """Daily demand per forecast group: a small series table, stored once per mart."""
    if "_grouped" not in m.__dict__:
        m._grouped = materialize(m.spark, fc.group_rare(demand(m), MAJOR), "demand")
    return m._grouped


@query("R13_daily_demand", f"""
SELECT category, move_date AS ds, cast(sum(qty_sold) AS bigint) AS y FROM movements JOIN dim_product USING (product_id)
WHERE qty_sold > 0 AND store_id IN ({', '.join(map(str, STORES))}) GROUP BY 1, 2""")
def _(m):
    return fc.daily_demand(m.movements, m.dim_product, STORES)


@query("R14_grouped_demand", "SELECT * FROM grouped_demand")
def _(m):
    return grouped(m)


define("short_demand", """
SELECT category, move_date AS ds, cast(sum(qty_sold) AS bigint) AS y FROM movements JOIN dim_product USING (product_id) WHERE qty_sold > 0 GROUP BY 1, 2""")


@query("R15_long_series", """
SELECT category, count(*) AS days FROM short_demand GROUP BY 1 HAVING count(*) >= 30""")
def _(m):
    rows = fc.long_enough(fc.daily_demand(m.movements, m.dim_product), 30)
    return rows.groupBy("category").agg(F.count(F.lit(1)).alias("days"))


# the seasonal fit in SQL: design rows by name, their Gram matrix, Gauss-Jordan steps, and the days scored by the solution
HOLIDAYS = 10  # federal ones
SIZE = 2 + 2 * seasonal.FOURIER_ORDER + HOLIDAYS
define("federal", "SELECT day AS ds, min(holiday) AS holiday FROM holiday_days WHERE kind = 'FEDERAL' GROUP BY 1")
define("federal_no", "SELECT holiday, row_number() OVER (ORDER BY holiday) AS h FROM (SELECT DISTINCT holiday FROM federal)")
define("series", "SELECT * FROM grouped_demand WHERE category IN (SELECT category FROM grouped_demand GROUP BY 1 HAVING count(*) >= 30)", once=True)
define("seasonal_days", """
SELECT category, g.ds, y::double AS y, h, (g.ds - a)::double / greatest(b - a, 1)::double AS tau, 2 * pi() * (g.ds - DATE '1970-01-01')::double / 365.25 AS angle
FROM (SELECT category, a, b, cast(unnest(generate_series(a::timestamp, b::timestamp, INTERVAL 1 DAY)) AS date) AS ds
      FROM (SELECT category, min(ds) AS a, cast(max(ds) + 182 AS date) AS b FROM series GROUP BY 1)) g
  LEFT JOIN series s USING (category, ds) LEFT JOIN federal f ON f.ds = g.ds LEFT JOIN federal_no USING (holiday)""", once=True)
define("seasonal_design", f"""
SELECT category, ds, y, i, CASE WHEN i = 1 THEN 1.0::double WHEN i = 2 THEN tau WHEN i <= 12 THEN sin(angle * (i - 2)) WHEN i <= 22 THEN cos(angle * (i - 12)) WHEN i <= {SIZE} THEN 1.0::double ELSE ln(1 + y) END AS x
FROM (SELECT *, unnest(range(1, {SIZE + 2})) AS i FROM seasonal_days) WHERE i <= 22 OR (i = 22 + h) OR (i = {SIZE + 1} AND y IS NOT NULL)""", once=True)
define("seasonal_gram", f"""
WITH g AS (SELECT a.category, a.i, b.i AS j, sum(a.x * b.x) AS v FROM seasonal_design a JOIN seasonal_design b USING (category, ds) WHERE a.y IS NOT NULL GROUP BY 1, 2, 3)
SELECT category AS part, i, j, coalesce(v, 0.0::double) + CASE WHEN i <> j OR i > {SIZE} THEN 0.0::double WHEN i <= 2 THEN 1e-9::double WHEN i <= 22 THEN 0.1::double + 1e-9::double ELSE 1.0::double + 1e-9::double END AS v
FROM (SELECT category, i, unnest(range(1, {SIZE + 2})) AS j FROM (SELECT category, unnest(range(1, {SIZE + 2})) AS i FROM (SELECT DISTINCT category FROM series))) c LEFT JOIN g USING (category, i, j)""", once=True)
_SOLVED = define_sweep("seasonal_sweep", "seasonal_gram", SIZE)
define("seasonal", f"""
WITH f AS (SELECT d.category, d.ds, any_value(d.y) AS y, sum(d.x * w.v) AS mean, sum(CASE WHEN d.i <= 2 THEN d.x * w.v END) AS level,
    sum(CASE WHEN d.i BETWEEN 3 AND 22 THEN d.x * w.v END) AS season, coalesce(sum(CASE WHEN d.i > 22 THEN d.x * w.v END), 0.0::double) AS mark
  FROM seasonal_design d JOIN {_SOLVED} w ON w.part = d.category AND w.i = d.i AND w.j = {SIZE + 1} WHERE d.i <= {SIZE} GROUP BY 1, 2),
s AS (SELECT category, stddev_pop(ln(1 + y) - mean) AS sigma FROM f WHERE y IS NOT NULL GROUP BY 1)
SELECT category, ds, y, greatest(exp(mean) - 1, 0.0::double) AS yhat, greatest(exp(mean - {seasonal.BAND_80} * sigma) - 1, 0.0::double) AS yhat_lower,
  greatest(exp(mean + {seasonal.BAND_80} * sigma) - 1, 0.0::double) AS yhat_upper, greatest(exp(level) - 1, 0.0::double) AS trend, exp(season) - 1 AS yearly, exp(mark) - 1 AS holidays
FROM f JOIN s USING (category)""", once=True)


def seasonal_rows(m):
    """History and forecast of the grouped demand."""
    federal = holidays.holiday_calendar(m.date_span).where(F.col("kind") == "FEDERAL")
    return seasonal.seasonal_forecast(fc.long_enough(grouped(m)), federal)


_SEASONAL = ("yhat", "yhat_lower", "yhat_upper", "trend", "yearly", "holidays")


@query("R16_seasonal_forecast", "SELECT category, ds, y, " + ", ".join(f"round({c}, 5) AS {c}" for c in _SEASONAL) + " FROM seasonal")
def _(m):
    return seasonal_rows(m).select("category", "ds", "y", *[F.round(c, 5).alias(c) for c in _SEASONAL])


@query("R16_gram_matrix", """
SELECT category, coalesce(holiday, '-') AS holiday, cast(k AS int) AS k, """ + ", ".join(f"round(sum({e}), 6) AS {n}" for n, e in {
    "c": "cos(angle * k)", "s": "sin(angle * k)", "tc": "tau * cos(angle * k)", "ts": "tau * sin(angle * k)", "zc": "ln(1 + y) * cos(angle * k)", "zs": "ln(1 + y) * sin(angle * k)",
}.items()) + """
FROM seasonal_days LEFT JOIN federal_no USING (h), (SELECT unnest(range(21)) AS k) WHERE y IS NOT NULL GROUP BY 1, 2, 3""")
def _(m):
    federal = holidays.holiday_calendar(m.date_span).where(F.col("kind") == "FEDERAL")
    moments = seasonal.seasonal_moments(seasonal.seasonal_grid(fc.long_enough(grouped(m)), federal))
    # no negative zero in sums that vanish
    return moments.select("category", F.coalesce("holiday", F.lit("-")).alias("holiday"), "k", *[(F.round(c, 6) + 0.0).alias(c) for c in ("c", "s", "tc", "ts", "zc", "zs")])


@query("R17_zero_filled_months", """
WITH s AS (SELECT category, cast(date_trunc('month', sale_date) AS date) AS month, cast(sum(qty) AS bigint) AS qty FROM fact_sales JOIN dim_product USING (product_id)
  GROUP BY 1, 2),
g AS (SELECT category, cast(unnest(generate_series(min(month)::timestamp, max(month)::timestamp, INTERVAL 1 MONTH)) AS date) AS month FROM s GROUP BY category)
SELECT category, month, cast(coalesce(qty, 0) AS bigint) AS qty FROM g LEFT JOIN s USING (category, month)""")
def _(m):
    per = m.fact_sales.groupBy("product_id", F.trunc("sale_date", "month").alias("month")).agg(F.sum("qty").alias("qty"))
    monthly = per.join(m.dim_product, "product_id").groupBy("category", "month").agg(F.sum("qty").alias("qty"))
    return fc.zero_filled_months(monthly)


# the days ahead, to four decimals, as a forecast table would keep them
define("forecast_days", "SELECT category, ds, " + ", ".join(f"round({c}, 4) AS {c}" for c in _SEASONAL[:3]) + " FROM seasonal WHERE ds > (SELECT max(ds) FROM series)", once=True)


def forecast_days(m):
    """The seasonal forecast behind the last observed day, stored: plans read it more than once."""
    ahead = fc.future_part(seasonal_rows(m).select("category", "ds", *[F.round(c, 4).alias(c) for c in _SEASONAL[:3]]), grouped(m))
    return materialize(m.spark, ahead, "forecast")


@query("R18_horizon_summary", """
SELECT category, round(sum(yhat), 2) AS total, round(sum(yhat) / count(*), 2) AS daily_mean, round(max(yhat), 2) AS peak, min(ds) FILTER (yhat = top) AS peak_day
FROM (SELECT *, max(yhat) OVER (PARTITION BY category) AS top FROM forecast_days) GROUP BY 1""")
def _(m):
    return fc.horizon_summary(forecast_days(m))


@query("R19_season_effect", """
WITH a AS (SELECT category, cast(month(ds) AS int) AS month, sum(y) AS y, count(*) AS n FROM grouped_demand GROUP BY 1, 2),
e AS (SELECT category, month, round(((y::double / n::double) / (sum(y) OVER (PARTITION BY category)::double / sum(n) OVER (PARTITION BY category)::double) - 1) * 100, 2) AS effect_pct FROM a)
SELECT *, cast(row_number() OVER (PARTITION BY category ORDER BY effect_pct DESC, month) AS int) AS rank FROM e""")
def _(m):
    return fc.season_effect(grouped(m))


@query("R20_holiday_impact", """
WITH u AS (SELECT category, dayofweek(ds) AS wd, sum(y)::double / count(*)::double AS usual FROM grouped_demand GROUP BY 1, 2),
h AS (SELECT d.category, holiday, round(sum(y - usual), 2) AS impact, count(*) AS days FROM grouped_demand d JOIN holiday_days ON day = ds
  JOIN u ON u.category = d.category AND wd = dayofweek(ds) GROUP BY 1, 2)
SELECT *, cast(row_number() OVER (PARTITION BY category ORDER BY abs(impact) DESC, holiday) AS int) AS rank FROM h
QUALIFY row_number() OVER (PARTITION BY category ORDER BY abs(impact) DESC, holiday) <= 5""")
def _(m):
    return fc.holiday_impact(grouped(m), holidays.holiday_calendar(m.date_span))


@query("R22_cover_need", """
WITH p AS (SELECT category, sum(yhat) AS need FROM forecast_days WHERE ds - (SELECT min(ds) FROM forecast_days) < 120 GROUP BY 1),
r AS (SELECT category, round(need, 2) AS forecast, cast(floor(round(need * 120 / 100, 6)) AS bigint) AS recommended FROM p)
SELECT * FROM r UNION ALL SELECT 'TOTAL', round(sum(forecast), 2), cast(sum(recommended) AS bigint) FROM r""")
def _(m):
    return fc.cover_need(forecast_days(m))


define("profile_months", """
SELECT category, date_trunc('month', sale_date) AS month, sum(qty)::double AS qty FROM fact_sales JOIN dim_product USING (product_id) GROUP BY 1, 2""")
define("profile_base", "SELECT category, avg(qty) AS a, stddev_pop(qty) AS s FROM profile_months GROUP BY 1")


@query("R23_demand_profile", """
SELECT category, round(a, 1) AS base_mean, round(s, 1) AS base_std, round(greatest(s * 0.15::double, 1.0::double), 2) AS residual_std,
  mean_price, price_spread, median_price FROM profile_base JOIN (SELECT category, round(sum(unit_cents)::double / count(*) / 100, 2) AS mean_price,
  round(stddev_samp(unit_cents::double) / 100, 2) AS price_spread, round(quantile_cont(unit_cents::double, 0.5) / 100, 2) AS median_price
  FROM unit_prices JOIN dim_product USING (product_id) GROUP BY 1) USING (category)""")
def _(m):
    return fc.demand_profile(m.fact_sales, m.dim_product).drop("month_index", "weekday_weights")


@query("R23_month_index", """
SELECT category, cast(month(month) AS int) AS month, round(avg(qty) / greatest(max(a), 1.0::double), 2) AS month_index FROM profile_months JOIN profile_base USING (category) GROUP BY 1, 2""")
def _(m):
    return fc.demand_profile(m.fact_sales, m.dim_product).select("category", F.explode("month_index").alias("month", "month_index"))


@query("R23_weekday_weights", """
SELECT category, cast(wd AS int) AS weekday, round(n::double / (sum(n) OVER (PARTITION BY category))::double, 4) AS weight
FROM (SELECT dayofweek(sale_date) + 1 AS wd, count(*) AS n FROM fact_sales GROUP BY 1), (SELECT DISTINCT category FROM dim_product)""")
def _(m):
    return fc.demand_profile(m.fact_sales, m.dim_product).select("category", F.explode("weekday_weights").alias("weekday", "weight"))


@query("R24_model_gate", """
SELECT 'model r2' AS check_name, round(1 - rss / tss, 4) AS value, 0.7::double AS threshold, CASE WHEN 1 - rss / tss >= 0.7 THEN 'PASS' ELSE 'BLOCK' END AS status FROM reg_fit
UNION ALL SELECT 'forecast not positive', count(*) FILTER (mean <= 0)::double, 0.0::double, CASE WHEN count(*) FILTER (mean <= 0) = 0 THEN 'PASS' ELSE 'BLOCK' END FROM weekly_ahead""")
def _(m):
    features = fc.weekly_features(weekly(m))
    fit = fc.fit_weekly(features)
    return fc.model_gate(fc.model_summary(fit), fc.weekly_forecast(features, fit))


@query("R25_method_choice", """
WITH p AS (SELECT category, cast(datediff('month', min(ds), max(ds)) - CASE WHEN day(max(ds)) < day(min(ds)) THEN 1 ELSE 0 END AS int) AS months, count(*) AS rows FROM short_demand GROUP BY 1)
SELECT *, CASE WHEN months < 6 THEN 'MOVING AVERAGE' WHEN months < 12 THEN 'REGRESSION' WHEN months < 36 THEN 'SEASONAL' ELSE 'SEASONAL OR MACHINE LEARNING' END AS by_history,
 CASE WHEN rows < 1000 THEN 'SIMPLE REGRESSION' WHEN rows < 50000 THEN 'REGRESSION' WHEN rows < 500000 THEN 'SEASONAL' ELSE 'SEASONAL OR MACHINE LEARNING' END AS by_rows FROM p""")
def _(m):
    return fc.choose_method(fc.daily_demand(m.movements, m.dim_product))


@query("R26_moving_average", """
SELECT category, week_start, qty, round(sum(qty) OVER w::double / count(*) OVER w::double, 4) AS moving_average FROM weekly
WINDOW w AS (PARTITION BY category ORDER BY week_start ROWS 7 PRECEDING)""")
def _(m):
    return fc.moving_average(weekly(m))


@query("R27_forecast_accuracy", """
WITH f AS (SELECT category, cast(ds + 364 AS date) AS ds, y::double AS yhat, y * 0.75::double AS lo, y * 1.25::double AS hi FROM grouped_demand)
SELECT category, count(*) AS days, round(avg(abs(yhat - y) / nullif(y, 0)::double) * 100, 2) AS mape_pct, round(sum(yhat - y) / sum(y) * 100, 2) AS bias_pct,
 round(100.0::double * count(*) FILTER (y BETWEEN lo AND hi)::double / count(*)::double, 2) AS in_band_pct FROM f JOIN grouped_demand USING (category, ds) GROUP BY 1""")
def _(m):
    # last year's day as the forecast that is judged
    rows = grouped(m)
    past = rows.select(
        "category", F.date_add("ds", 364).alias("ds"), dbl(F.col("y")).alias("yhat"), (F.col("y") * F.lit(0.75)).alias("yhat_lower"), (F.col("y") * F.lit(1.25)).alias("yhat_upper")
    )
    return fc.accuracy(past, rows)


@query("R28_forecast_totals", """
SELECT category, round(sum(yhat), 2) AS total, count(*) AS days, min(ds) AS first_day, max(ds) AS last_day FROM forecast_days WHERE ds < (SELECT cast(min(ds) + 100 AS date) FROM forecast_days) GROUP BY 1""")
def _(m):
    rows = forecast_days(m)
    return fc.forecast_totals(rows, F.date_add(rows.select(F.min("ds").alias("v")).scalar(), 100))


@query("R28_seasonal_summary", """
SELECT category, count(*) AS days, round(min(yearly), 4) AS yearly_min, round(avg(yearly), 4) AS yearly_mean, round(max(yearly), 4) AS yearly_max,
  count(*) FILTER (holidays <> 0) AS holiday_days FROM seasonal GROUP BY 1""")
def _(m):
    return seasonal.seasonal_summary(seasonal_rows(m))
