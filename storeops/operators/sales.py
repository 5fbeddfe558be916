"""Sales KPIs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeops.functions.columns import (
    big, count_big, dbl, divide, month_key, month_start, percent, ratio, top, total,
)


def sales_slice(
    sales: DataFrame, products: DataFrame | None = None, *, first: date | str | None = None,
    last: date | str | None = None, stores: list | None = None, sellers: list | None = None,
    categories: list[str] | None = None, lines: list[str] | None = None,
) -> DataFrame:
    """Sales restricted by period, store, seller, category and line.

    Conditions on the fact reach its scan; the product is joined only when a
    product condition is given, as a semi join.
    """
    if first is not None:
        sales = sales.where(F.col("sale_date") >= F.lit(first).cast("date"))
    if last is not None:
        sales = sales.where(F.col("sale_date") <= F.lit(last).cast("date"))
    if stores:
        sales = sales.where(F.col("store_id").isin(stores))
    if sellers:
        sales = sales.where(F.col("seller_id").isin(sellers))
    if categories or lines:
        wanted = products
        if categories:
            wanted = wanted.where(F.col("category").isin(categories))
        if lines:
            wanted = wanted.where(F.col("line").isin(lines))
        sales = sales.join(wanted.select("product_id"), "product_id", "left_semi")
    return sales


def ticket_totals(sales: DataFrame, *keys: Column | str) -> DataFrame:
    """One row per ticket (and key): partial sums that every KPI can reuse,
    which also makes the ticket count an ordinary row count."""
    return sales.groupBy(*keys, "ticket").agg(
        count_big().alias("items"), F.sum("qty").alias("qty"), F.sum("net").alias("net"), F.sum("cost").alias("cost"),
    )


def _kpi_columns() -> list[Column]:
    net, cost = F.sum("net"), F.sum("cost")
    return [
        total("net").alias("revenue"),
        big(F.sum("qty")).alias("volume"),
        ratio(net, count_big()).alias("avg_ticket"),
        ratio(net - cost, net).alias("margin"),
    ]


def sales_kpis(sales: DataFrame) -> DataFrame:
    """Revenue, volume, average ticket and margin."""
    return ticket_totals(sales).agg(*_kpi_columns())


def revenue_by_month(sales: DataFrame) -> DataFrame:
    # names are formatted once per month, not once per row
    m = F.col("m")
    per = sales.groupBy(month_start(F.col("sale_date")).alias("m")).agg(total("net").alias("revenue"))
    return per.select(F.year(m).alias("year"), F.month(m).alias("month"), F.date_format(m, "MMMM").alias("month_name"), "revenue")


def sales_by_store(sales: DataFrame, stores: DataFrame) -> DataFrame:
    per_store = sales.groupBy("store_id").agg(
        count_big().alias("sales_rows"),
        big(F.sum("qty")).alias("pieces"),
        total("net").alias("revenue"),
        ratio(F.sum("net"), count_big()).alias("mean_value"),
    )
    return per_store.join(stores, "store_id").select("store", "sales_rows", "pieces", "revenue", "mean_value")


def weekday_profile(sales: DataFrame) -> DataFrame:
    per = sales.groupBy(F.dayofweek("sale_date").alias("weekday")).agg(count_big().alias("sales_rows"), total("net").alias("revenue"))
    sunday = F.lit("2000-01-02").cast("date")
    return per.withColumn("weekday_name", F.date_format(F.date_add(sunday, F.col("weekday") - 1), "EEEE"))


def by_product(sales: DataFrame) -> DataFrame:
    """Fact reduced to one row per product before any product join."""
    return sales.groupBy("product_id").agg(
        count_big().alias("rows"), F.sum("qty").alias("qty"), F.sum("net").alias("net"), F.sum("cost").alias("cost"),
    )


def share_of_total(df: DataFrame, value: str, name: str) -> DataFrame:
    """Adds the percentage of the grand total.

    ``df`` is already one row per category or type, so the single window
    partition holds a vocabulary, not the fact.
    """
    return df.withColumn(name, percent(F.col(value), F.sum(value).over(Window.partitionBy())))


def category_distribution(sales: DataFrame, products: DataFrame) -> DataFrame:
    per = by_product(sales).join(products, "product_id").groupBy("category").agg(
        big(F.sum("qty")).alias("pieces"), total("net").alias("revenue")
    )
    return share_of_total(per, "pieces", "share_pct")


def top_products(sales: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    per = by_product(sales).join(products, "product_id").groupBy("product_type", "category").agg(
        big(F.sum("qty")).alias("pieces")
    )
    return top(share_of_total(per, "pieces", "share_pct"), k, F.desc("pieces"), F.asc("product_type"), F.asc("category"))


def period_deltas(sales: DataFrame) -> DataFrame:
    """Monthly KPIs with change against the previous month: revenue, volume
    and ticket in percent, margin in points."""
    day = F.col("sale_date")
    monthly = ticket_totals(sales, month_key(day).alias("month")).groupBy("month").agg(
        F.sum("net").alias("net"), F.sum("cost").alias("cost"), F.sum("qty").alias("qty"), count_big().alias("tickets")
    ).select(
        "month",
        dbl(F.col("net")).alias("revenue"),
        big(F.col("qty")).alias("volume"),
        divide(F.col("net"), F.col("tickets")).alias("ticket"),
        divide(F.col("net") - F.col("cost"), F.col("net")).alias("margin"),
    )
    # months only: the window has one row per month of the calendar
    w = Window.orderBy("month")
    before = {c: F.lag(c).over(w) for c in ("revenue", "volume", "ticket", "margin")}
    change = lambda c: F.round((F.col(c) - before[c]) * 100.0 / F.nullif(dbl(before[c]), F.lit(0.0)), 2)
    return monthly.select(
        "month", "revenue", "volume",
        F.round("ticket", 4).alias("avg_ticket"),
        F.round("margin", 4).alias("margin"),
        change("revenue").alias("revenue_pct"),
        change("volume").alias("volume_pct"),
        change("ticket").alias("ticket_pct"),
        F.round((F.col("margin") - before["margin"]) * 100.0, 2).alias("margin_points"),
    )


def store_detail(sales: DataFrame, stores: DataFrame) -> DataFrame:
    per = ticket_totals(sales, "store_id").groupBy("store_id").agg(
        count_big().alias("sales"),
        big(F.sum("items")).alias("items"),
        total("net").alias("revenue"),
        ratio(F.sum("net"), count_big()).alias("avg_ticket"),
        total("cost").alias("cost"),
        ratio(F.sum("net") - F.sum("cost"), F.sum("net")).alias("margin"),
    )
    return per.join(stores, "store_id").drop("store_id", "city")


def drill_down(sales: DataFrame, products: DataFrame, stores: DataFrame) -> DataFrame:
    """Store × category totals with subtotals (NULL = all)."""
    base = sales.groupBy("store_id", "product_id").agg(F.sum("qty").alias("qty"), F.sum("net").alias("net"))
    base = base.join(products, "product_id").groupBy("store_id", "category").agg(
        F.sum("qty").alias("qty"), F.sum("net").alias("net")
    ).join(stores, "store_id")
    return base.rollup("store", "category").agg(
        big(F.sum("qty")).alias("pieces"), total("net").alias("revenue"),
        F.grouping_id().cast("int").alias("level"),
    )


def store_city_month(sales: DataFrame, stores: DataFrame) -> DataFrame:
    per = sales.groupBy("store_id", month_start(F.col("sale_date")).alias("period")).agg(
        big(F.sum("qty")).alias("pieces"), total("net").alias("revenue"), count_big().alias("transactions")
    ).withColumn("period", F.date_format("period", "yyyy-MM"))
    return per.join(stores, "store_id").drop("store_id")


def history_by_month_category(sales: DataFrame, products: DataFrame) -> DataFrame:
    """History by month and category; SKUs counted once per cell."""
    base = sales.groupBy(month_start(F.col("sale_date")).alias("m"), "product_id").agg(
        F.sum("qty").alias("qty"), F.sum("net").alias("net"), count_big().alias("rows")
    ).select(F.year("m").alias("year"), F.month("m").alias("month"), "product_id", "qty", "net", "rows")
    return base.join(products, "product_id").groupBy("year", "month", "category").agg(
        big(F.sum("qty")).alias("qty"),
        total("net").alias("revenue"),
        count_big().alias("skus"),
        big(F.sum("rows")).alias("transactions"),
    ).withColumn("year_month", F.format_string("%04d-%02d", F.col("year"), F.col("month")))


def history_by_month(sales: DataFrame, days_per_month: int = 30) -> DataFrame:
    """Months over all categories: SKUs recounted, not summed over categories."""
    month = F.col("sale_date")
    per = sales.groupBy(F.year(month).alias("year"), F.month(month).alias("month"), "product_id").agg(
        F.sum("qty").alias("qty"), F.sum("net").alias("net"), count_big().alias("rows")
    )
    return per.groupBy("year", "month").agg(
        big(F.sum("qty")).alias("qty"), total("net").alias("revenue"), count_big().alias("skus"),
        big(F.sum("rows")).alias("transactions"),
        F.round(dbl(F.sum("qty")) / days_per_month, 1).alias("avg_daily_qty"),
    )


def year_grid(months: DataFrame, years: tuple[int, int]) -> DataFrame:
    """Two years side by side on a zero-filled grid of 12 months."""
    spark = months.sparkSession
    grid = spark.range(1, 13).select(F.col("id").cast("int").alias("month"))
    a, b = years
    pick = lambda y, c: F.sum(F.when(F.col("year") == y, F.col(c)))
    side = months.where(F.col("year").isin(a, b)).groupBy("month").agg(
        pick(a, "qty").alias("plan_qty"), pick(a, "revenue").alias("plan_value"),
        pick(b, "qty").alias("hist_qty"), pick(b, "revenue").alias("hist_value"),
    )
    names = F.date_format(F.make_date(F.lit(2000), F.col("month"), F.lit(1)), "MMMM")
    return grid.join(side, "month", "left").select(
        "month", names.alias("month_name"),
        big(F.coalesce("plan_qty", F.lit(0))).alias("plan_qty"),
        F.coalesce("plan_value", F.lit(0.0)).alias("plan_value"),
        big(F.coalesce("hist_qty", F.lit(0))).alias("hist_qty"),
        F.coalesce("hist_value", F.lit(0.0)).alias("hist_value"),
    )


def season_profile(history: DataFrame, category: str) -> DataFrame:
    """Units by calendar month of one category."""
    return history.where(F.col("category") == category).groupBy("month").agg(big(F.sum("qty")).alias("qty"))


def compare_periods(sales: DataFrame, a: tuple[str, str], b: tuple[str, str]) -> DataFrame:
    """Volume and value of two periods, with daily means, in one scan."""
    day = F.col("sale_date")
    span = lambda p: day.between(F.lit(p[0]).cast("date"), F.lit(p[1]).cast("date"))
    period = F.when(span(a), "A").when(span(b), "B")
    length = lambda p: F.date_diff(F.lit(p[1]).cast("date"), F.lit(p[0]).cast("date")) + 1
    days = F.when(F.col("period") == "A", length(a)).otherwise(length(b))
    return (
        sales.where(span(a) | span(b)).groupBy(period.alias("period"))
        .agg(big(F.sum("qty")).alias("qty"), total("net").alias("revenue"))
        .select("period", "qty", "revenue", F.round(dbl(F.col("qty")) / days, 1).alias("daily_qty"))
    )
