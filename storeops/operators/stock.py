"""Inventory KPIs.

The inventory fact has one row per product and movement day; the current stock
of a product is its last row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeops.functions.columns import (
    big, count_big, count_where, coverage_days, dbl, divide, month_key, ratio, sum_where, top, week_start,
)

COVERAGE_BANDS = [(30, "CRITICAL"), (60, "ATTENTION")]


def latest_stock(inventory: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Last stock, sold units and day per product (and store); max_by combines
    on the map side, so no product history is ever gathered."""
    last = F.max_by(F.struct("stock", "qty_sold", "move_date"), "move_date")
    return inventory.groupBy(*(keys or ["product_id"])).agg(last.alias("s")).select(*(keys or ["product_id"]), "s.*")


def cost_or_zero() -> Column:
    return F.coalesce(F.col("unit_cost"), F.lit(0).cast("decimal(12,2)"))


def stock_value() -> Column:
    return F.col("stock") * cost_or_zero()


def inventory_kpis(snapshot: DataFrame, products: DataFrame) -> DataFrame:
    rows = snapshot.join(products, "product_id")
    mean_stock, mean_sold = divide(F.sum("stock"), count_big()), divide(F.sum("qty_sold"), count_big())
    return rows.agg(
        dbl(F.sum(stock_value())).alias("stock_value"),
        ratio(F.sum("qty_sold"), mean_stock).alias("turnover"),
        F.round(mean_stock / F.nullif(mean_sold, F.lit(0.0)) * 30, 4).alias("coverage_days"),
        count_where(F.col("stock") == 0).alias("stock_outs"),
    )


def top_stock_value(snapshot: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    per = snapshot.where(F.col("stock") > 0).join(products, "product_id").groupBy("product_type", "category").agg(
        big(F.sum("stock")).alias("stock"), dbl(F.sum(stock_value())).alias("stock_value")
    )
    return top(per, k, F.desc("stock_value"), F.asc("product_type"), F.asc("category"))


def by_product(inventory: DataFrame) -> DataFrame:
    """Inventory history reduced to one row per product."""
    return inventory.groupBy("product_id").agg(
        count_big().alias("days"), F.sum("stock").alias("stock_sum"), F.sum("qty_sold").alias("sold"),
        count_where(F.col("qty_sold") > 0).alias("selling_days"), count_where(F.col("stock") > 0).alias("stocked_days"),
    )


def turnover_by_category(inventory: DataFrame, products: DataFrame) -> DataFrame:
    per = by_product(inventory).join(products, "product_id").groupBy("category").agg(
        big(F.sum("sold")).alias("sold"), divide(F.sum("stock_sum"), F.sum("days")).alias("mean")
    )
    return per.select(
        "category", "sold", F.round("mean", 4).alias("mean_stock"),
        F.when(F.col("mean") > 0, F.round(F.col("sold") / F.col("mean"), 4)).otherwise(F.lit(0.0)).alias("turnover"),
    )


def monthly_coverage() -> Column:
    return F.when(F.col("qty_sold") > 0, F.round(dbl(F.col("stock")) / dbl(F.col("qty_sold")) * 30, 4)).otherwise(F.lit(999.0))


def critical_products(snapshot: DataFrame, products: DataFrame, max_stock: int = 10, k: int = 20) -> DataFrame:
    low = snapshot.where(F.col("stock") <= max_stock).select("product_id", "stock", "qty_sold", monthly_coverage().alias("coverage_days"))
    rows = low.join(products.select("product_id", "product_type", "category"), "product_id")
    return top(rows, k, F.asc("coverage_days"), F.asc("product_id"))


def band(coverage: Column) -> Column:
    expr = F.when(coverage < COVERAGE_BANDS[0][0], COVERAGE_BANDS[0][1]).when(coverage <= COVERAGE_BANDS[1][0], COVERAGE_BANDS[1][1])
    return expr.otherwise("OK")


def coverage_bands(snapshot: DataFrame) -> DataFrame:
    return snapshot.groupBy(band(monthly_coverage()).alias("band")).agg(count_big().alias("products"), big(F.sum("stock")).alias("stock"))


def category_coverage(snapshot: DataFrame, products: DataFrame) -> DataFrame:
    per = snapshot.join(products, "product_id").groupBy("category").agg(F.sum("stock").alias("stock"), F.sum("qty_sold").alias("qty_sold"))
    return per.select("category", monthly_coverage().alias("coverage_days"), band(monthly_coverage()).alias("band"))


def month_changes(inventory: DataFrame, products: DataFrame) -> DataFrame:
    """Per month: change of stock units, value and products out of stock,
    plus units sold.

    Month-end levels are running sums of these changes, so no product × month
    grid is built for products that did not move.
    """
    w = Window.partitionBy("product_id").orderBy("move_date")
    before = F.lag("stock").over(w)
    out_now = (F.col("stock") <= 0).cast("int")
    out_before = F.coalesce((before <= 0).cast("int"), F.lit(0))
    steps = inventory.select(
        "product_id", month_key(F.col("move_date")).alias("month"), "qty_sold",
        (F.col("stock") - F.coalesce(before, F.lit(0))).alias("d_stock"), (out_now - out_before).alias("d_out"),
    )
    per = steps.groupBy("product_id", "month").agg(*[F.sum(c).alias(c) for c in ("qty_sold", "d_stock", "d_out")])
    return per.join(products.select("product_id", "unit_cost"), "product_id").groupBy("month").agg(
        F.sum("qty_sold").alias("sold"), F.sum("d_stock").alias("d_stock"), F.sum("d_out").alias("d_out"),
        F.sum(F.col("d_stock") * cost_or_zero()).alias("d_value"),
    )


def month_levels(inventory: DataFrame, products: DataFrame) -> DataFrame:
    # one row per calendar month
    w = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    return month_changes(inventory, products).select(
        "month", big(F.col("sold")).alias("sold"), big(F.sum("d_stock").over(w)).alias("stock"),
        dbl(F.sum("d_value").over(w)).alias("stock_value"), big(F.sum("d_out").over(w)).alias("stock_outs"),
    )


def stock_and_sales(inventory: DataFrame, products: DataFrame) -> DataFrame:
    return month_levels(inventory, products).select("month", "stock", "sold")


def inventory_deltas(inventory: DataFrame, products: DataFrame) -> DataFrame:
    """Month-end value, turnover, coverage and stock-outs with their change."""
    levels = month_levels(inventory, products).select(
        "month", "stock_value", "stock_outs",
        ratio(F.col("sold"), F.col("stock")).alias("turnover"), F.round(divide(F.col("stock"), F.col("sold")) * 30, 4).alias("coverage_days"),
    )
    w = Window.orderBy("month")
    prev = lambda c: F.lag(c).over(w)
    return levels.select(
        "*",
        F.round((F.col("stock_value") - prev("stock_value")) * 100.0 / F.nullif(prev("stock_value"), F.lit(0.0)), 2).alias("value_pct"),
        F.round((F.col("turnover") - prev("turnover")) * 100.0 / F.nullif(prev("turnover"), F.lit(0.0)), 2).alias("turnover_pct"),
        F.round(F.col("coverage_days") - prev("coverage_days"), 4).alias("coverage_change"),
        (F.col("stock_outs") - prev("stock_outs")).alias("stock_out_change"),
    )


def movement_summary(movements: DataFrame, products: DataFrame) -> DataFrame:
    per = movements.where(F.col("qty_sold") > 0).groupBy("product_id", "store_id").agg(
        count_big().alias("n"), F.min("move_date").alias("a"), F.max("move_date").alias("b")
    )
    return per.join(products.select("product_id", "category"), "product_id").agg(
        big(F.sum("n")).alias("sale_rows"), F.min("a").alias("first_day"), F.max("b").alias("last_day"),
        F.count_distinct("store_id").alias("stores"), F.count_distinct("category").alias("categories"),
    )


def movement_by_store(movements: DataFrame, stores: DataFrame) -> DataFrame:
    per = movements.where(F.col("qty_sold") > 0).groupBy("store_id").agg(count_big().alias("sale_rows"), big(F.sum("qty_sold")).alias("sold"))
    return per.join(stores, "store_id").select("store_id", "store", "sale_rows", "sold")


def movement_by_category(movements: DataFrame, products: DataFrame) -> DataFrame:
    per = movements.where(F.col("qty_sold") > 0).groupBy("product_id").agg(count_big().alias("n"), F.sum("qty_sold").alias("sold"))
    return per.join(products, "product_id").groupBy("category").agg(big(F.sum("n")).alias("sale_rows"), big(F.sum("sold")).alias("sold"))


def movement_by_month(movements: DataFrame) -> DataFrame:
    return movements.where(F.col("qty_sold") > 0).groupBy(month_key(F.col("move_date")).alias("month")).agg(big(F.sum("qty_sold")).alias("sold"))


def stock_by_store(store_inventory: DataFrame, stores: DataFrame) -> DataFrame:
    """Positive stock per product and store on the last snapshot."""
    last = latest_stock(store_inventory, ["product_id", "store_id"]).where(F.col("stock") > 0)
    return last.join(stores, "store_id").select("product_id", "store_id", "store", "stock")


def stores_per_product(per_store: DataFrame) -> DataFrame:
    """Store list per product; its length is bounded by the number of stores."""
    item = F.concat(F.col("store"), F.lit(":"), F.col("stock").cast("string"))
    return per_store.groupBy("product_id").agg(
        F.array_join(F.array_sort(F.collect_list(item)), ", ").alias("stores"), big(F.sum("stock")).alias("stock")
    )


def status_histogram(products: DataFrame) -> DataFrame:
    return products.groupBy("status").agg(count_big().alias("products"))


def trailing_sales(sales: DataFrame, days: int = 90) -> DataFrame:
    """Units and selling days per product over the days before (and on) the
    last sale in the data, not before today."""
    last = sales.select(F.max("sale_date").alias("v")).scalar()
    recent = F.col("sale_date") > F.date_sub(last, days)
    per_day = sales.groupBy("product_id", "sale_date").agg(F.sum("qty").alias("qty"))
    return per_day.groupBy("product_id").agg(
        big(sum_where(recent, F.col("qty"))).alias("recent_qty"), count_where(recent).alias("recent_days"),
        F.max("sale_date").alias("last_sale"),
    )


def supplier_products(snapshot: DataFrame, products: DataFrame, suppliers: DataFrame, sales: DataFrame, days: int = 90) -> DataFrame:
    """Active products with stock: trailing velocity and coverage."""
    stocked = products.where(F.col("status") == "ACTIVE").join(snapshot.where(F.col("stock") > 0).select("product_id", "stock"), "product_id")
    rows = stocked.join(trailing_sales(sales, days), "product_id", "left").join(suppliers, "supplier_id", "left")
    velocity = dbl(F.col("recent_qty")) / days
    return rows.select(
        "product_id", "article", "category", "line", "supplier_id", "supplier", "supplier_category",
        dbl(F.col("unit_cost")).alias("unit_cost"), "stock", "last_sale",
        F.round(velocity, 4).alias("velocity"),
        F.when(velocity > 0, F.round(dbl(F.col("stock")) / velocity, 2)).alias("coverage_days"),
    )


def supplier_summary(rows: DataFrame, min_products: int = 3) -> DataFrame:
    value = F.col("stock") * F.coalesce(F.col("unit_cost"), F.lit(0.0)).cast("decimal(12,2)")
    per = rows.where(F.col("supplier_id").isNotNull()).groupBy("supplier", "supplier_category").agg(
        count_big().alias("products"), big(F.sum("stock")).alias("stock"),
        F.round(dbl(F.sum(F.col("coverage_days").cast("decimal(18,2)"))) / F.count("coverage_days"), 4).alias("mean_coverage"),
        dbl(F.sum(value)).alias("stock_value"),
    )
    return per.where(F.col("products") >= min_products)


def active(products: DataFrame) -> DataFrame:
    return products.where(F.col("status") == "ACTIVE")


def headline(snapshot: DataFrame, products: DataFrame, clothing: str) -> DataFrame:
    """Active suppliers, clothing out of stock, stock value: one row."""
    rows = active(products).join(snapshot.select("product_id", "stock"), "product_id", "left")
    empty = F.coalesce("stock", F.lit(0)) <= 0
    return rows.agg(
        F.count_distinct("supplier_id").alias("suppliers"),
        count_where((F.col("category") == clothing) & empty).alias("clothing_out_of_stock"),
        F.round(dbl(F.sum(F.coalesce("stock", F.lit(0)) * cost_or_zero())), 0).alias("stock_value"),
    )


def clothing_need(snapshot: DataFrame, products: DataFrame, sales: DataFrame, clothing: str, weeks: float = 17.0) -> DataFrame:
    """Stock against need per type and size.  Stock and sales are each reduced
    to one row per product first, so neither multiplies the other."""
    sold = sales.groupBy("product_id").agg(F.sum("qty").alias("qty"))
    rows = active(products).where(F.col("category") == clothing)
    rows = rows.join(snapshot.select("product_id", "stock"), "product_id", "left").join(sold, "product_id", "left")
    per = rows.groupBy("product_type", F.coalesce("size_code", F.lit("ONE")).alias("size")).agg(
        big(F.coalesce(F.sum("stock"), F.lit(0))).alias("stock"),
        big(F.round(dbl(F.coalesce(F.sum("qty"), F.lit(0))) * weeks / 52, 0)).alias("need"),
        F.coalesce(F.sum("qty"), F.lit(0)).alias("sold"),
    ).where((F.col("stock") > 0) | (F.col("sold") > 0))
    diff = F.col("stock") - F.col("need")
    return per.select("product_type", "size", "stock", "need", diff.alias("difference"), F.when(diff >= 0, "OK").otherwise("BUY").alias("action"))


def other_suppliers(snapshot: DataFrame, products: DataFrame, suppliers: DataFrame, clothing: str, minimum: float = 10_000) -> DataFrame:
    rows = active(products).where(F.col("category") != clothing).join(snapshot.select("product_id", "stock"), "product_id", "left")
    stock = F.coalesce(F.col("stock"), F.lit(0))
    per = rows.groupBy("supplier_id").agg(
        count_big().alias("products"), ratio(F.sum(stock), count_big(), 1).alias("mean_stock"),
        F.round(dbl(F.sum(stock * cost_or_zero())), 0).alias("stock_value"),
    )
    return per.join(suppliers, "supplier_id", "left").select(
        F.coalesce("supplier", F.lit("NO SUPPLIER")).alias("supplier"), "products", "mean_stock", "stock_value",
        F.when(F.col("stock_value") >= minimum, "YES").otherwise("NO").alias("reaches_minimum"),
    )


def weekly_mean(sales: DataFrame, products: DataFrame, weeks_ahead: int = 26) -> DataFrame:
    """Mean of the real weekly sums per category and its projection."""
    per = sales.groupBy("product_id", week_start(F.col("sale_date")).alias("week")).agg(F.sum("qty").alias("qty"))
    weekly = per.join(products.select("product_id", "category"), "product_id").groupBy("category", "week").agg(F.sum("qty").alias("qty"))
    means = weekly.where(F.col("qty") > 0).groupBy("category").agg(ratio(F.sum("qty"), count_big(), 1).alias("weekly_mean"))
    return means.withColumn("projection", F.round(F.col("weekly_mean") * weeks_ahead, 0))


def week_labels(sales: DataFrame, weeks: int = 26) -> DataFrame:
    """ISO labels of the weeks after the last sale."""
    last = sales.agg(F.max("sale_date").alias("last"))
    ahead = last.select(F.posexplode(F.sequence(F.date_add("last", 7), F.date_add("last", 7 * weeks), F.expr("interval 7 days"))).alias("i", "day"))
    iso_year = F.extract(F.lit("YEAROFWEEK"), F.col("day"))
    return ahead.select(
        (F.col("i") + 1).alias("week_ahead"), "day",
        F.concat(F.lit("W"), F.weekofyear("day").cast("string"), F.lit("/"), iso_year.cast("string")).alias("label"),
    )


def cost_statistics(products: DataFrame) -> DataFrame:
    has = F.col("unit_cost") > 0
    return products.groupBy("category").agg(
        count_big().alias("products"), ratio(F.sum(F.when(has, F.col("unit_cost"))), count_where(has), 2).alias("mean_cost"),
        count_where(F.col("unit_cost").isNull() | ~has).alias("without_cost"),
    )


def supplier_presence(products: DataFrame) -> DataFrame:
    return products.groupBy("category").agg(
        count_big().alias("products"), F.count("supplier_id").alias("with_supplier"),
        count_where(F.col("supplier_id").isNull()).alias("without_supplier"),
    )


def top_suppliers(products: DataFrame, category: str, k: int = 10) -> DataFrame:
    per = products.where((F.col("category") == category) & F.col("supplier_id").isNotNull()).groupBy("supplier_id").agg(count_big().alias("products"))
    return top(per, k, F.desc("products"), F.asc("supplier_id"))


def observed_days(inventory: DataFrame) -> DataFrame:
    """Days seen, and days with a sale."""
    per = inventory.groupBy("move_date").agg(F.max(F.col("qty_sold") > 0).alias("sold"))
    return per.agg(count_big().alias("days"), count_where(F.col("sold")).alias("selling_days"))


def velocity_comparison(inventory: DataFrame, products: DataFrame, horizon: int = 120) -> DataFrame:
    """Velocity per selling day against velocity per calendar day."""
    days = observed_days(inventory).select("days").scalar()
    sold = by_product(inventory).where(F.col("sold") > 0).withColumn("all_days", days)
    old, new = divide(F.col("sold"), F.col("selling_days")), divide(F.col("sold"), F.col("all_days"))
    return sold.select(
        "product_id", "sold", "selling_days", F.round(old, 4).alias("velocity_selling"), F.round(new, 4).alias("velocity_calendar"),
        F.round(old * horizon, 0).alias("projection_selling"), F.round(new * horizon, 0).alias("projection_calendar"),
    ).join(products.select("product_id", "product_type", "category"), "product_id")


def stocked_products(inventory: DataFrame, products: DataFrame) -> DataFrame:
    """Products that ever had stock, by category."""
    ever = by_product(inventory).where(F.col("stocked_days") > 0)
    return ever.join(products, "product_id").groupBy("category").agg(count_big().alias("products"))


def differences(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """Values found in only one of two sources, NULLs left out."""
    va = a.where(F.col(column).isNotNull()).select(column).distinct()
    vb = b.where(F.col(column).isNotNull()).select(column).distinct()
    only = lambda x, y, side: x.join(y, column, "left_anti").withColumn("only_in", F.lit(side))
    return only(va, vb, "A").unionByName(only(vb, va, "B"))


def assortment_profile(snapshot: DataFrame, products: DataFrame, sales: DataFrame, days: int = 90) -> DataFrame:
    """SKUs, cost, price per piece sold, stock, trailing units and selling days by category, line and collection."""
    sold = sales.where(F.col("qty") > 0).groupBy("product_id").agg(F.sum("net").alias("_net"), F.sum("qty").alias("_pieces"))
    rows = products.join(snapshot.select("product_id", "stock"), "product_id", "left").join(trailing_sales(sales, days), "product_id", "left").join(sold, "product_id", "left")
    return rows.groupBy("category", "line", "collection").agg(
        count_big().alias("skus"), ratio(F.sum("unit_cost"), F.count("unit_cost")).alias("mean_cost"), ratio(F.sum("_net"), F.sum("_pieces")).alias("mean_price"),
        big(F.coalesce(F.sum("stock"), F.lit(0))).alias("stock"),
        big(F.coalesce(F.sum("recent_qty"), F.lit(0))).alias("recent_qty"),
        ratio(F.sum("recent_qty"), F.lit(days) * count_where(F.col("recent_qty") > 0)).alias("velocity_per_sku"),
        big(F.coalesce(F.sum("recent_days"), F.lit(0))).alias("selling_days"),
    )


def supplier_orders(purchases: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Orders, mean quantity and value, first and last order per supplier."""
    per = purchases.groupBy("supplier_id", "order_no").agg(
        count_big().alias("n"), F.sum("qty").alias("qty"), F.sum("gross").alias("gross"), F.min("order_date").alias("day")
    )
    return per.groupBy("supplier_id").agg(
        count_big().alias("orders"), ratio(F.sum("qty"), F.sum("n")).alias("mean_qty"), ratio(F.sum("gross"), F.sum("n")).alias("mean_value"),
        F.min("day").alias("first_order"), F.max("day").alias("last_order"),
    ).join(suppliers, "supplier_id")
