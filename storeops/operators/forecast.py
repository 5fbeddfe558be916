"""Demand series, regression and seasonal forecasts.

A *forecast* is a table (category, ds, yhat, yhat_lower, yhat_upper).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeops.functions import ols
from storeops.functions.columns import big, count_big, dbl, divide, percent, ratio, top_per, week_start
from storeops.functions.quantiles import group_quantiles
from storeops.operators.market import unit_price_cents
from storeops.session import materialize

# ---- weekly regression ------------------------------------------------------


def weekly_sales(sales: DataFrame, products: DataFrame, since: str | None = None) -> DataFrame:
    """Category × ISO week: the ISO year keeps the turn of the year in one week."""
    if since:
        sales = sales.where(F.col("sale_date") >= F.lit(since).cast("date"))
    day = F.col("sale_date")
    per = sales.groupBy("product_id", week_start(day).alias("week_start")).agg(
        F.sum("qty").alias("qty"), F.sum("net").alias("net"), F.min(day).alias("first_day")
    )
    weekly = per.join(products.where(F.col("category").isNotNull()).select("product_id", "category"), "product_id").groupBy("category", "week_start").agg(
        big(F.sum("qty")).alias("qty"), dbl(F.sum("net")).alias("revenue"), count_big().alias("skus"), F.min("first_day").alias("first_day")
    )
    iso = F.extract(F.lit("YEAROFWEEK"), F.col("week_start"))
    return weekly.withColumn("year_week", (iso * 100 + F.weekofyear("week_start")).cast("int"))


def weekly_features(weekly: DataFrame) -> DataFrame:
    """log1p(quantity), weeks since the first week, calendar quarter."""
    weekly = materialize(weekly.sparkSession, weekly, "weekly")  # one row per category and week
    first = weekly.select(F.min("week_start").alias("v")).scalar()
    t = (F.date_diff(F.col("week_start"), first) / 7).cast("int")
    return weekly.withColumn("y", F.log1p(dbl(F.col("qty")))).withColumn("t", t).withColumn("quarter", F.quarter("week_start"))


def _quarters(quarter: Column) -> dict[str, Column]:
    return {f"quarter={q}": F.when(quarter == q, 1.0).otherwise(0.0) for q in (2, 3, 4)}


def fit_weekly(features: DataFrame) -> ols.SweptFit:
    """y ~ category + quarter + t; the category is swept out, so the driver only solves for quarters and trend."""
    return ols.fit_swept(features, "category", F.col("y"), {**_quarters(F.col("quarter")), "t": F.col("t")})


def model_summary(fit: ols.SweptFit) -> DataFrame:
    row = (fit.n, fit.parameters, float(fit.r2), float(fit.r2_adj), float(fit.aic), float(fit.bic))
    return fit.levels.sparkSession.createDataFrame([row], "n bigint, parameters bigint, r2 double, r2_adj double, aic double, bic double")


def coefficients(fit: ols.SweptFit) -> DataFrame:
    """Coefficients with p-value, stars and the reading of the trend."""
    p, b = F.col("p_value"), F.col("coefficient")
    stars = F.when(p < 0.01, "***").when(p < 0.05, "**").when(p < 0.1, "*").otherwise("")
    trend = F.when(p >= 0.05, "NO SIGNIFICANT TREND").when(b > 0, "SIGNIFICANT GROWTH").otherwise("SIGNIFICANT DECLINE")
    out = ols.with_p_values(fit.terms(), fit.n - fit.parameters)
    return out.withColumn("stars", stars).withColumn("reading", F.when(F.col("term") == "t", trend))


def weekly_forecast(features: DataFrame, fit: ols.SweptFit, weeks: int = 26) -> DataFrame:
    """Mean and 95 % band for the next weeks of every category.

    Every category is one row of the fit that is unfolded to the weeks ahead; nothing is joined.
    """
    grid = fit.levels.select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(weeks))).alias("week_ahead"),
        features.select(F.max("week_start").alias("v")).scalar().alias("last"), features.select(F.max("t").alias("v")).scalar().alias("t0"),
    )
    rows = grid.withColumn("week_start", F.date_add("last", F.col("week_ahead") * 7))
    quarters = _quarters(F.quarter("week_start"))
    mean, se = fit.mean_and_se([*quarters.values(), F.col("t0") + F.col("week_ahead")])
    back = lambda x: F.greatest(F.round(F.expm1(x), 1), F.lit(0.0))
    return rows.select(
        "category", "week_ahead", "week_start", F.extract(F.lit("YEAROFWEEK"), F.col("week_start")).cast("int").alias("iso_year"),
        F.weekofyear("week_start").alias("iso_week"), back(mean).alias("mean"), back(F.greatest(mean - 1.96 * se, F.lit(0.0))).alias("low"), back(mean + 1.96 * se).alias("high"),
    )


def purchase_quantity(forecast: DataFrame, weeks: int = 18) -> DataFrame:
    """120 days ≈ the first 18 weeks: mean, low and high totals."""
    return forecast.where(F.col("week_ahead") <= weeks).groupBy("category").agg(
        *[F.round(F.sum(c), 1).alias(f"{c}_total") for c in ("mean", "low", "high")], F.count(F.lit(1)).cast("int").alias("weeks")
    )


# ---- daily demand ------------------------------------------------------------


def daily_demand(movements: DataFrame, products: DataFrame, stores: list | None = None) -> DataFrame:
    """Units sold per day and category, optionally for some stores."""
    rows = movements.where(F.col("qty_sold") > 0)
    if stores:
        rows = rows.where(F.col("store_id").isin(stores))
    per = rows.groupBy("product_id", F.col("move_date").alias("ds")).agg(F.sum("qty_sold").alias("y"))
    cat = products.select("product_id", F.coalesce("category", F.lit("OTHER")).alias("category"))
    return per.join(cat, "product_id").groupBy("category", "ds").agg(big(F.sum("y")).alias("y"))


def group_rare(demand: DataFrame, major: list[str]) -> DataFrame:
    """Categories outside ``major`` become OTHER, summed again per day."""
    name = F.when(F.col("category").isin(major), F.col("category")).otherwise("OTHER")
    return demand.groupBy(name.alias("category"), "ds").agg(big(F.sum("y")).alias("y"))


def long_enough(demand: DataFrame, min_days: int = 30) -> DataFrame:
    sizes = demand.groupBy("category").agg(count_big().alias("_n")).where(F.col("_n") >= min_days)
    return demand.join(sizes.select("category"), "category", "left_semi")


def zero_filled_months(monthly: DataFrame) -> DataFrame:
    """(category, month, qty) with every month between a series' ends."""
    span = monthly.groupBy("category").agg(F.min("month").alias("a"), F.max("month").alias("b"))
    grid = span.select("category", F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("month"))
    return grid.join(monthly, ["category", "month"], "left").select("category", "month", big(F.coalesce("qty", F.lit(0))).alias("qty"))


def future_part(forecast: DataFrame, demand: DataFrame) -> DataFrame:
    last = demand.select(F.max("ds").alias("v")).scalar()
    return forecast.where(F.col("ds") > last)


# ---- using a forecast ----------------------------------------------------------


def horizon_summary(forecast: DataFrame) -> DataFrame:
    """Total, daily mean, peak and first day of the peak."""
    peak = F.max(F.struct(F.col("yhat").alias("v"), (-F.unix_date("ds")).alias("d")))
    return forecast.groupBy("category").agg(F.sum("yhat").alias("total"), count_big().alias("n"), peak.alias("p")).select(
        "category", F.round("total", 2).alias("total"), F.round(F.col("total") / F.col("n"), 2).alias("daily_mean"),
        F.round("p.v", 2).alias("peak"), F.date_from_unix_date((-F.col("p.d")).cast("int")).alias("peak_day"),
    )


def season_effect(demand: DataFrame) -> DataFrame:
    """Monthly mean against the overall mean, in percent, with rank."""
    monthly = demand.groupBy("category", F.month("ds").alias("month")).agg(F.sum("y").alias("y"), count_big().alias("n"))
    # at most twelve rows per category
    w = Window.partitionBy("category")
    effect = (divide(F.col("y"), F.col("n")) / divide(F.sum("y").over(w), F.sum("n").over(w)) - 1) * 100
    rows = monthly.select("category", "month", F.round(effect, 2).alias("effect_pct"))
    return rows.withColumn("rank", F.row_number().over(w.orderBy(F.desc("effect_pct"), "month")))


def holiday_impact(demand: DataFrame, holidays: DataFrame, k: int = 5) -> DataFrame:
    """Units above or below the same weekday's mean, summed per holiday."""
    usual = demand.groupBy("category", F.dayofweek("ds").alias("weekday")).agg(divide(F.sum("y"), count_big()).alias("usual"))
    days = demand.join(F.broadcast(holidays.select(F.col("day").alias("ds"), "holiday")), "ds").withColumn("weekday", F.dayofweek("ds"))
    per = days.join(usual, ["category", "weekday"]).groupBy("category", "holiday").agg(
        F.round(F.sum(F.col("y") - F.col("usual")), 2).alias("impact"), count_big().alias("days")
    )
    return top_per(per, ["category"], k, F.desc(F.abs("impact")), F.asc("holiday"))


def cover_need(forecast: DataFrame, days: int = 120, margin_pct: int = 20) -> DataFrame:
    """Units for the first ``days`` days plus safety margin, with total row."""
    first = forecast.select(F.min("ds").alias("v")).scalar()
    per = forecast.where(F.date_diff(F.col("ds"), first) < days).groupBy("category").agg(F.sum("yhat").alias("need"))
    rows = per.select("category", F.round("need", 2).alias("forecast"), big(F.floor(F.round(F.col("need") * (100 + margin_pct) / 100, 6))).alias("recommended"))
    return rows.rollup("category").agg(F.round(F.sum("forecast"), 2).alias("forecast"), F.sum("recommended").alias("recommended")).withColumn(
        "category", F.coalesce("category", F.lit("TOTAL"))
    )


def forecast_totals(forecast: DataFrame, cutoff: Column) -> DataFrame:
    """Totals up to a cut-off date, with day count and range."""
    return forecast.where(F.col("ds") < cutoff).groupBy("category").agg(
        F.round(F.sum("yhat"), 2).alias("total"), count_big().alias("days"), F.min("ds").alias("first_day"), F.max("ds").alias("last_day")
    )


def accuracy(forecast: DataFrame, actual: DataFrame) -> DataFrame:
    """Error of a forecast against what was sold: MAPE, bias, share in band."""
    rows = forecast.join(actual, ["category", "ds"])
    err = F.col("yhat") - F.col("y")
    inside = F.col("y").between(F.col("yhat_lower"), F.col("yhat_upper"))
    return rows.groupBy("category").agg(
        count_big().alias("days"), F.round(F.avg(F.abs(err) / F.nullif(dbl(F.col("y")), F.lit(0.0))) * 100, 2).alias("mape_pct"),
        F.round(F.sum(err) / F.sum("y") * 100, 2).alias("bias_pct"), percent(F.count_if(inside), count_big()).alias("in_band_pct"),
    )


def moving_average(weekly: DataFrame, window: int = 8) -> DataFrame:
    """Mean of the last ``window`` weeks of each series: the forecast for
    histories too short for a model.  One row per week and category."""
    w = Window.partitionBy("category").orderBy("week_start").rowsBetween(-(window - 1), 0)
    mean = F.sum("qty").over(w) / F.count("qty").over(w)
    return weekly.select("category", "week_start", "qty", F.round(mean, 4).alias("moving_average"))


def choose_method(demand: DataFrame) -> DataFrame:
    """Forecast method by length of history and number of rows."""
    months = F.months_between(F.max("ds"), F.min("ds"))
    per = demand.groupBy("category").agg(F.floor(months).cast("int").alias("months"), count_big().alias("rows"))
    m, n = F.col("months"), F.col("rows")
    by_length = F.when(m < 6, "MOVING AVERAGE").when(m < 12, "REGRESSION").when(m < 36, "SEASONAL").otherwise("SEASONAL OR MACHINE LEARNING")
    by_rows = F.when(n < 1_000, "SIMPLE REGRESSION").when(n < 50_000, "REGRESSION").when(n < 500_000, "SEASONAL").otherwise("SEASONAL OR MACHINE LEARNING")
    return per.withColumn("by_history", by_length).withColumn("by_rows", by_rows)


def demand_profile(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Learned parameters per category: monthly mean and spread, month index
    and weekday weights as maps, price mean, spread and median."""
    day = F.col("sale_date")
    per = sales.groupBy("product_id", day).agg(F.sum("qty").alias("qty"), count_big().alias("n"))
    cat = products.where(F.col("category").isNotNull()).select("product_id", "category")
    daily = per.join(cat, "product_id").groupBy("category", day).agg(F.sum("qty").alias("qty"), F.sum("n").alias("n"))
    daily = materialize(sales.sparkSession, daily, "daily")  # one row per category and day
    monthly = daily.groupBy("category", F.trunc("sale_date", "month").alias("month")).agg(dbl(F.sum("qty")).alias("qty"))
    base = monthly.groupBy("category").agg(F.avg("qty").alias("avg"), F.stddev_pop("qty").alias("std"))
    by_month = monthly.groupBy("category", F.month("month").alias("m")).agg(F.avg("qty").alias("v")).join(base, "category")
    index = by_month.groupBy("category").agg(  # at most twelve entries
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("m", F.round(F.col("v") / F.greatest("avg", F.lit(1.0)), 2).alias("i"))))).alias("month_index")
    )
    # weekday weights are shared by all categories: seven rows
    weekday = daily.groupBy(F.dayofweek("sale_date").alias("d")).agg(F.sum("n").alias("n"))
    share = F.round(dbl(F.col("n")) / dbl(F.sum("n").over(Window.partitionBy())), 4)
    weights = weekday.select("d", share.alias("w")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("d", "w")))).alias("v")).scalar()
    prices = sales.where(F.col("qty") > 0).groupBy("product_id", unit_price_cents().alias("price")).agg(count_big().alias("f"))
    freq = prices.join(cat, "product_id").groupBy("category", "price").agg(F.sum("f").alias("f"))
    p, f = F.col("price").cast("decimal(38,0)"), F.col("f")
    n, s1, s2 = F.sum("f"), F.sum(p * f), F.sum(p * p * f)
    spread = F.sqrt((dbl(s2) - dbl(s1) * dbl(s1) / n) / (n - 1))
    price = freq.groupBy("category").agg(
        F.round(dbl(s1) / n / 100, 2).alias("mean_price"), F.round(spread / 100, 2).alias("price_spread"),
    )
    median = group_quantiles(freq, ["category"], F.col("price"), {"median": 0.5}, F.col("f"))
    price = price.join(median.select("category", F.round(F.col("median") / 100, 2).alias("median_price")), "category")
    return base.join(index, "category").join(price, "category").select(
        "category", F.round("avg", 1).alias("base_mean"), F.round("std", 1).alias("base_std"),
        F.round(F.greatest(F.col("std") * 0.15, F.lit(1.0)), 2).alias("residual_std"),
        "month_index", weights.alias("weekday_weights"), "mean_price", "price_spread", "median_price",
    )


def model_gate(summary: DataFrame, forecast: DataFrame, min_r2: float = 0.70) -> DataFrame:
    """Release checks of a model: fit quality and strictly positive forecasts."""
    r2 = summary.select(F.lit("model r2").alias("check_name"), F.round("r2", 4).alias("value"), F.lit(min_r2).alias("threshold"),
                        F.when(F.col("r2") >= min_r2, "PASS").otherwise("BLOCK").alias("status"))
    low = forecast.agg(F.count_if(F.col("mean") <= 0).alias("n")).select(
        F.lit("forecast not positive").alias("check_name"), dbl(F.col("n")).alias("value"), F.lit(0.0).alias("threshold"),
        F.when(F.col("n") == 0, "PASS").otherwise("BLOCK").alias("status"))
    return r2.unionByName(low)
