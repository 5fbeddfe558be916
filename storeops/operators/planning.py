"""Purchase planning."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeops.functions.columns import big, count_big, count_where, dbl, divide, ratio, top, top_per
from storeops.operators.control import URGENCY_ORDER, urgency_rank
from storeops.functions.ranks import ranked
from storeops.session import materialize

HORIZON = 120
FLOOR_VELOCITY = 0.0001
NO_STOCK_LIMIT = 999.0
DEFAULT_COST = Decimal("15")
MIN_ORDER = 10_000
# Statuses that are never restocked.
NOT_RESTOCKED = ("DISCONTINUED", "INACTIVE", "CLEARANCE")
TARGETS = (120, 150, 180)


def observed(inventory: DataFrame) -> DataFrame:
    """One row: days observed and days on which anything was sold."""
    per = inventory.groupBy("move_date").agg(F.max(F.col("qty_sold") > 0).alias("s"))
    return per.agg(count_big().alias("all_days"), count_where(F.col("s")).alias("selling_days"))


def stock_and_sold(inventory: DataFrame) -> DataFrame:
    """Current stock and units sold per product from one scan of the fact."""
    return inventory.groupBy("product_id").agg(F.max_by("stock", "move_date").alias("stock"), F.sum("qty_sold").alias("sold"))


def velocities(inventory: DataFrame) -> DataFrame:
    """Units per chain selling day, and per observed day with a small floor."""
    days = observed(inventory).select(F.struct("selling_days", "all_days")).scalar()
    rows = stock_and_sold(inventory).withColumn("_days", days).select("*", "_days.*")
    return rows.select(
        "product_id", "stock", "sold", "selling_days", "all_days", divide(F.col("sold"), F.col("selling_days")).alias("chain_velocity"),
        F.greatest(divide(F.col("sold"), F.col("all_days")), F.lit(FLOOR_VELOCITY)).alias("velocity"),
    )


def forecast_group(mapping: dict[str, str], default: str = "OTHER") -> Column:
    """Category → forecast group."""
    expr = F.lit(default)
    for category, group in mapping.items():
        expr = F.when(F.col("category") == category, group).otherwise(expr)
    return expr


def horizon_totals(forecast: DataFrame, days: int = HORIZON) -> DataFrame:
    """Total and number of days of the first ``days`` forecast days per group."""
    first = forecast.select(F.min("ds").alias("v")).scalar()
    return forecast.where(F.date_diff(F.col("ds"), first) < days).groupBy("category").agg(F.sum("yhat").alias("total"), count_big().alias("n")).select(
        F.col("category").alias("forecast_group"), "total", divide(F.col("total"), F.col("n")).alias("daily_mean")
    )


def candidates(inventory: DataFrame, products: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Active products seen in the inventory, with velocity and forecast group."""
    rows = products.where((F.col("status") == "ACTIVE") & F.col("category").isNotNull()).join(velocities(inventory), "product_id")
    return rows.withColumn("forecast_group", forecast_group(mapping))


def need_by_velocity(rows: DataFrame, totals: DataFrame) -> DataFrame:
    """120-day need: own velocity; else a tenth of the group's daily mean; else
    an equal part of the group's forecast."""
    groups = rows.groupBy("forecast_group").agg(F.sum("sold").alias("group_sold"), count_big().alias("group_size"))
    # one row per forecast group on the right-hand side
    joined = rows.join(groups.join(totals, "forecast_group", "left"), "forecast_group")
    by_mean = F.coalesce(F.col("daily_mean"), F.lit(1.0)) * 0.1 * HORIZON
    by_part = F.greatest(F.lit(1.0), F.coalesce(F.col("total"), F.lit(0.0)) / F.col("group_size"))
    forecast = F.when(F.col("sold") > 0, F.col("chain_velocity") * HORIZON).when(F.col("group_sold") > 0, by_mean).otherwise(by_part)
    need = F.greatest(forecast - F.col("stock"), F.lit(0.0))
    cost = F.when(F.col("unit_cost") > 0, F.col("unit_cost")).otherwise(F.lit(0).cast("decimal(12,2)"))
    return joined.select(
        "product_id", "article", "product_type", "category", "line", "size_code", "supplier_id", "forecast_group", big(F.col("stock")).alias("stock"),
        F.round("chain_velocity", 4).alias("velocity"), F.round(forecast, 1).alias("forecast"), big(F.round(need, 0)).alias("quantity"), (need > 1).alias("needed"), cost.alias("unit_cost"),
    )


def proportional_need(rows: DataFrame, totals: DataFrame) -> DataFrame:
    """Share of the category forecast by velocity, else velocity · 120; never
    below zero.

    Category sums are grouped and joined back, so a category that holds most
    products is not gathered into one window partition.
    """
    slow = divide(F.col("sold"), F.col("all_days")) < FLOOR_VELOCITY
    sums = rows.groupBy("category").agg(
        F.sum(F.when(~slow, F.col("sold"))).alias("fast_sold"), count_where(slow).alias("slow_n"), F.max("all_days").alias("d"), count_big().alias("n")
    )
    sums = sums.select("category", (divide(F.coalesce("fast_sold", F.lit(0)), F.col("d")) + F.col("slow_n") * F.lit(FLOOR_VELOCITY)).alias("velocity_sum"))
    per = sums.join(totals.select(F.col("forecast_group").alias("category"), "total"), "category", "left")
    joined = rows.join(per, "category")
    forecast = F.when(F.col("total") > 0, F.col("velocity") / F.col("velocity_sum") * F.col("total")).otherwise(F.col("velocity") * HORIZON)
    return joined.withColumn("forecast", forecast).withColumn(
        "quantity", big(F.greatest(F.ceil(F.round(F.col("forecast") - F.col("stock"), 6)), F.lit(0).cast("bigint")))
    ).drop("velocity_sum", "total")


def category_costs(products: DataFrame) -> DataFrame:
    mean = F.round(divide(F.sum("unit_cost"), count_big()), 4).cast("decimal(12,4)")
    return products.where(F.col("unit_cost") > 0).groupBy("category").agg(mean.alias("category_cost"))


def with_cost(rows: DataFrame, products: DataFrame) -> DataFrame:
    """Unit cost: own, else category mean, else mean of the means, else 15."""
    means = materialize(products.sparkSession, category_costs(products), "category-costs")
    overall = means.select(F.round(dbl(F.avg("category_cost")), 4).cast("decimal(12,4)").alias("v")).scalar()
    own = F.when(F.col("unit_cost") > 0, F.col("unit_cost").cast("decimal(12,4)"))
    joined = rows.join(means, "category", "left").withColumn("_overall", overall)
    cost = F.coalesce(own, "category_cost", "_overall", F.lit(DEFAULT_COST).cast("decimal(12,4)"))
    return joined.withColumn("cost", cost).drop("category_cost", "_overall")


def coverage() -> Column:
    """Days the stock lasts at units per observed day, two decimals, rounded
    in whole numbers."""
    sold = big(F.col("sold"))
    hundredths = F.call_function("div", 200 * F.abs(F.col("stock")) * F.col("all_days") + sold, F.nullif(2 * sold, F.lit(0).cast("bigint")))
    days = F.signum(dbl(F.col("stock"))) * hundredths / 100 + 0.0
    return F.when(F.col("velocity") > FLOOR_VELOCITY, days).otherwise(F.lit(NO_STOCK_LIMIT))


def purchase_plan(inventory: DataFrame, products: DataFrame, totals: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Products to buy with quantity, cost, value and coverage."""
    rows = with_cost(proportional_need(candidates(inventory, products, mapping), totals), products)
    out = rows.withColumn("coverage_days", coverage()).withColumn("value", F.col("quantity") * F.col("cost"))
    return out.where(F.col("quantity") > 0)


def channel(clothing: str, jewellery: str) -> Column:
    """Clothing and jewellery are bought in person, the rest from suppliers."""
    return F.when(F.col("category") == clothing, "CLOTHING").when(F.col("category") == jewellery, "JEWELLERY").otherwise("SUPPLIER")


def _mean(col: str) -> Column:
    return divide(F.sum(F.col(col).cast("decimal(20,2)")), count_big())


def supplier_items(plan: DataFrame) -> DataFrame:
    """Plan lines per supplier, article and size."""
    return plan.groupBy("supplier_id", "article", "size_code").agg(
        big(F.sum("stock")).alias("stock"), big(F.sum("quantity")).alias("quantity"), F.sum("value").alias("value"),
        F.round(_mean("coverage_days"), 2).alias("coverage_days"), count_big().alias("skus"), F.max("category").alias("category"),
    )


def supplier_rollup(items: DataFrame, jewellery_suppliers: list[int], k: int | None = 20) -> DataFrame:
    """Items, quantity, value, stock, mean coverage per supplier; most urgent first."""
    tag = F.bool_or(F.upper("article").contains("RING")) | F.coalesce(F.col("supplier_id").isin(jewellery_suppliers), F.lit(False))
    per = items.groupBy("supplier_id").agg(
        count_big().alias("items"), big(F.sum("quantity")).alias("quantity"), F.round(dbl(F.sum("value")), 2).alias("value"), big(F.sum("stock")).alias("stock"),
        F.round(_mean("coverage_days"), 1).alias("coverage_days"), F.array_join(F.array_sort(F.collect_set("category")), ", ").alias("categories"), tag.alias("jewellery"),
    )
    return per if k is None else top(per, k, F.asc("coverage_days"), F.asc_nulls_first("supplier_id"))


def supplier_documents(items: DataFrame, page: int = 50) -> DataFrame:
    """One document per supplier and page of items, most urgent item first.

    Pages bound the list held in memory and keep every item; the lines of a large supplier, or of none, are ranked by
    ranges.  ``items`` is stored first, as ranking reads it several times.
    """
    stored = materialize(items.sparkSession, items, "supplier-items")
    order = [F.col("coverage_days"), -F.col("quantity"), F.col("article"), F.col("size_code")]
    placed = ranked(stored, ["supplier_id"], order, "rank").withColumn("rank", F.col("rank").cast("int"))
    paged = placed.withColumn("page", F.floor((F.col("rank") - 1) / page).cast("int"))
    entry = F.struct("rank", "article", "size_code", "stock", "quantity", dbl(F.col("value")).alias("value"), "coverage_days")
    return paged.groupBy("supplier_id", "page").agg(count_big().alias("n"), F.array_sort(F.collect_list(entry)).alias("items"))


def size_rollup(plan: DataFrame, by: str, k: int) -> DataFrame:
    """Quantity per group and size for the ``k`` groups with the largest need."""
    sizes = plan.groupBy(by, "size_code").agg(big(F.sum("stock")).alias("stock"), big(F.sum("quantity")).alias("quantity"), count_big().alias("skus"))
    sizes = materialize(plan.sparkSession, sizes, "plan-sizes")
    needed = sizes.groupBy(by).agg(F.sum("quantity").alias("total_needed"))
    return sizes.join(F.broadcast(top(needed, k, F.desc("total_needed"), F.asc(by))), by)  # k rows


def category_overview(needs: DataFrame) -> DataFrame:
    quantity = F.when(F.col("needed"), F.col("quantity")).otherwise(0)
    per = needs.groupBy("category").agg(
        count_big().alias("products"), big(F.sum("stock")).alias("stock"), F.round(dbl(F.sum(F.col("forecast").cast("decimal(18,1)"))), 1).alias("forecast"),
        big(F.sum(quantity)).alias("quantity"), F.round(dbl(F.sum(quantity * F.col("unit_cost"))), 2).alias("value"),
    )
    return per.withColumn("critical", F.col("forecast") > 2 * F.col("stock"))


def plan_totals(plan: DataFrame, clothing: str, jewellery: str) -> DataFrame:
    """Products, quantity and value per channel with the grand total."""
    return plan.withColumn("channel", channel(clothing, jewellery)).rollup("channel").agg(
        count_big().alias("products"), F.count_distinct("supplier_id").alias("suppliers"), big(F.sum("quantity")).alias("quantity"), F.round(dbl(F.sum("value")), 2).alias("value")
    ).withColumn("channel", F.coalesce("channel", F.lit("TOTAL")))


def category_need(forecast: DataFrame, snapshot: DataFrame, products: DataFrame, days: int = HORIZON) -> DataFrame:
    """Forecast of the first 120 rows per category against stock, categories
    without forecast included."""
    # one row per day and category: the window is bounded by the horizon
    first = top_per(forecast, ["category"], days, F.asc("ds"), rank="_r").groupBy("category").agg(F.round(F.sum("yhat"), 0).alias("forecast"))
    held = snapshot.join(products.where(F.col("status") == "ACTIVE"), "product_id").groupBy("category").agg(F.sum("stock").alias("stock"))
    f, s = F.coalesce("forecast", F.lit(0.0)), F.coalesce("stock", F.lit(0))
    return first.join(held, "category", "full").select(
        "category", big(s).alias("stock"), f.alias("forecast"), F.when(F.col("forecast").isNull(), 0.0).otherwise(F.greatest(f - s, F.lit(0.0))).alias("need"),
        F.when(f > 0, F.round(s / (f / days), 0)).otherwise(F.lit(NO_STOCK_LIMIT)).alias("coverage_days"),
    )


def fallback_rates(rows: DataFrame) -> DataFrame:
    """Rows with velocity and cost filled from the category, then overall mean."""
    rows = materialize(rows.sparkSession, rows, "supplier-products")  # product level, read three times
    exact = rows.withColumn("v", F.when(F.col("velocity") > 0, F.col("velocity").cast("decimal(18,4)"))).withColumn(
        "c", F.when(F.col("unit_cost") > 0, F.col("unit_cost").cast("decimal(12,2)")))
    means = materialize(rows.sparkSession, category_rates(rows), "category-rates")
    overall = lambda c: means.select(F.round(dbl(F.avg(F.col(c).cast("decimal(18,4)"))), 4).alias("m")).scalar()
    joined = exact.join(means, "category", "left").withColumn("ov", overall("category_velocity")).withColumn("oc", overall("category_cost"))
    return joined.withColumn("velocity", F.coalesce(dbl(F.col("v")), "category_velocity", "ov", F.lit(0.02))).withColumn(
        "unit_cost", F.coalesce(dbl(F.col("c")), "category_cost", "oc", F.lit(20.0))).drop("v", "c", "category_velocity", "category_cost", "ov", "oc")


def category_rates(rows: DataFrame) -> DataFrame:
    """Mean positive velocity and cost per category."""
    v = F.when(F.col("velocity") > 0, F.col("velocity").cast("decimal(18,4)"))
    c = F.when(F.col("unit_cost") > 0, F.col("unit_cost").cast("decimal(12,2)"))
    return rows.groupBy("category").agg(ratio(F.sum(v), F.count(v)).alias("category_velocity"), ratio(F.sum(c), F.count(c)).alias("category_cost"))


def escalating_orders(rows: DataFrame, alerts: DataFrame, minimum: float = MIN_ORDER) -> DataFrame:
    """Order per alerted supplier at the first target (120, 150, 180 days)
    whose cost reaches the minimum; the last target is always kept."""
    suppliers = alerts.where(F.col("supplier_id").isNotNull()).groupBy("supplier_id").agg(
        count_big().alias("alerts"), F.max(urgency_rank()).alias("urgency_rank"), F.min("coverage_days").alias("min_coverage")
    )
    each = fallback_rates(rows).join(suppliers.select("supplier_id"), "supplier_id", "left_semi")
    each = each.withColumn("target_days", F.explode(F.array(*[F.lit(t) for t in TARGETS])))
    wanted = F.col("target_days") * F.col("velocity")
    qty = F.greatest(F.floor(wanted - F.col("stock") + 0.5), F.lit(1).cast("bigint"))
    short = each.where(F.col("stock") < wanted).withColumn("qty", qty).withColumn("cost", F.round(F.col("qty") * F.col("unit_cost"), 2).cast("decimal(18,2)"))
    per = short.groupBy("supplier_id", "target_days").agg(count_big().alias("items"), big(F.sum("qty")).alias("quantity"), F.sum("cost").alias("cost"))
    fits = per.where((F.col("cost") >= minimum) | (F.col("target_days") == TARGETS[-1]))
    w = Window.partitionBy("supplier_id").orderBy("target_days")  # at most three rows
    chosen = fits.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).drop("_r")
    names = F.array(*[F.lit(u) for u in URGENCY_ORDER])
    return chosen.join(suppliers, "supplier_id").select(
        "supplier_id", "target_days", "items", "quantity", dbl(F.col("cost")).alias("cost"), (F.col("cost") >= minimum).alias("meets_minimum"), "alerts",
        F.element_at(names, F.col("urgency_rank")).alias("urgency"), "min_coverage",
    )


def ranked_orders(orders: DataFrame, k: int = 50) -> DataFrame:
    """Orders by urgency (CRITICAL, HIGH, the rest), then coverage."""
    level = F.when(F.col("urgency") == "CRITICAL", 0).when(F.col("urgency") == "HIGH", 1).otherwise(2)
    return top(orders.withColumn("level", level), k, F.asc("level"), F.asc("min_coverage"), F.asc("supplier_id"))


def supplier_urgency(alerts: DataFrame) -> DataFrame:
    """Worst urgency and smallest coverage per supplier."""
    names = F.array(*[F.lit(u) for u in URGENCY_ORDER])
    return alerts.where(F.col("supplier_id").isNotNull()).groupBy("supplier_id").agg(
        F.element_at(names, F.max(urgency_rank())).alias("urgency"), F.min("coverage_days").alias("min_coverage"), count_big().alias("alerts")
    )


def coverage_tag() -> Column:
    """Stock over forecast: below 50 % critical, up to 150 % fine, above excess."""
    share = F.col("stock") / F.nullif(F.col("forecast"), F.lit(0.0))
    return F.when(share < 0.5, "CRITICAL").when(share <= 1.5, "OK").otherwise("EXCESS")


def allowed_orders(lines: DataFrame, products: DataFrame, minimum: float = MIN_ORDER) -> DataFrame:
    """Order lines → orders that keep the rules: restockable products only,
    minimum value, one order (the largest) per supplier and month."""
    kept = lines.join(products.where(~F.col("status").isin(*NOT_RESTOCKED)).select("product_id"), "product_id", "left_semi")
    orders = kept.groupBy("supplier_id", "order_no", "order_date").agg(count_big().alias("lines"), F.sum("gross").alias("value")).where(F.col("value") >= minimum)
    orders = orders.withColumn("month", F.trunc("order_date", "month"))
    best = top_per(orders, ["supplier_id", "month"], 1, F.desc("value"), F.asc("order_no"), rank="_r").drop("_r")
    return best.withColumn("value", dbl(F.col("value")))
