"""Stock control: regimes, alerts, slow movers, stock-outs, daily log.

Velocity is kept as (sold, records) and every threshold is compared in whole
numbers, so boundaries do not depend on floating point.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeops.functions.columns import big, count_big, count_where, dbl, literal_table, percent, top, top_per
from storeops.operators.market import _int_div
from storeops.session import materialize

# Replenishment parameters per regime.
REGIME_COLUMNS = [
    "regime", "target_days", "reorder_days", "lead_days", "lead_spread", "tagging_days", "safety_days", "min_order", "pack", "reorders",
]
REGIMES = [
    ("commodity", 90, 30, 15, 5, 10, 10, 50, 12, True),
    ("fashion", 14, 7, 10, 5, 10, 3, 10, 6, True),
    ("seasonal", 180, 60, 20, 7, 10, 15, 24, 12, True),
    ("inactive", 0, 0, 0, 0, 0, 0, 0, 0, False),
]
SEASONAL_REORDER_AT = 0.70
# Days without sale (from, below) and discount.
DISCOUNTS = [(60, 90, 0.10), (90, 180, 0.20), (180, None, 0.30)]
SLOW_AFTER = 60
TAGGING_DAYS = 10
URGENCY_ORDER = ["LOW", "MEDIUM", "HIGH", "CRITICAL"]


@dataclass(frozen=True)
class RegimeRules:
    """Which categories, lines and collections decide the regime."""

    continuous: tuple[str, ...]
    fashion: tuple[str, ...]
    seasonal: tuple[str, ...]
    commodity: tuple[str, ...]
    basic_line: str


def regime(rules: RegimeRules) -> Column:
    """First rule that applies wins."""
    basic = F.col("line") == rules.basic_line
    return (
        F.when(~F.coalesce(F.upper(F.trim("status")), F.lit("")).isin("ACTIVE", ""), "inactive")
        .when(F.col("collection").isin(*rules.continuous), "commodity")
        .when(F.col("category").isin(*rules.fashion), "fashion")
        .when(F.col("category").isin(*rules.seasonal) & basic, "commodity")
        .when(F.col("category").isin(*rules.seasonal), "seasonal")
        .when(F.col("category").isin(*rules.commodity), "commodity")
        .otherwise("fashion")
    )


def regime_parameters(spark) -> DataFrame:
    return literal_table(spark, REGIMES, REGIME_COLUMNS)


def with_regime(products: DataFrame, rules: RegimeRules) -> DataFrame:
    """Products with regime and its parameters (a four-row table)."""
    tagged = products.withColumn("regime", regime(rules))
    return tagged.join(F.broadcast(regime_parameters(products.sparkSession)), "regime")


def last_sales(sales: DataFrame) -> DataFrame:
    return sales.groupBy("product_id").agg(F.max("sale_date").alias("last_sale"))


def recent_velocity(inventory: DataFrame, records: int = 30) -> DataFrame:
    """Mean of the last sale records per product."""
    sold = inventory.where(F.col("qty_sold") > 0).select("product_id", "move_date", "qty_sold")
    last = top_per(sold, ["product_id"], records, F.desc("move_date"))
    return last.groupBy("product_id").agg(F.sum("qty_sold").alias("sold"), count_big().alias("records")).withColumn(
        "velocity", F.round(dbl(F.col("sold")) / F.col("records"), 4)
    )


def calendar_velocity(inventory: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Units of the last calendar days over their number."""
    end = F.lit(as_of).cast("date")
    rows = inventory.where(F.col("move_date").between(F.date_sub(end, days - 1), end))
    return rows.groupBy("product_id").agg(F.sum("qty_sold").alias("sold")).withColumn("velocity", F.round(dbl(F.col("sold")) / days, 4))


def sale_day_state(inventory: DataFrame, records: int = 30) -> DataFrame:
    """Every sale day of a product with its stock and velocity so far."""
    w = Window.partitionBy("product_id").orderBy("move_date").rowsBetween(-(records - 1), 0)
    rows = inventory.where(F.col("qty_sold") > 0)
    return rows.select(
        "product_id", "move_date", "stock", "qty_sold", F.sum("qty_sold").over(w).alias("sold"), F.count("qty_sold").over(w).alias("records")
    )


def needs_reorder() -> Column:
    """stock / (sold / records) ≤ reorder point, for stocked selling products."""
    return F.col("reorders") & (F.col("stock") > 0) & (F.col("stock") * F.col("records") <= F.col("reorder_days") * F.col("sold"))


def urgency() -> Column:
    within = lambda days: F.col("stock") * F.col("records") <= days * F.col("sold")
    return F.when(within(7), "CRITICAL").when(within(14), "HIGH").when(within(30), "MEDIUM").otherwise("LOW")


def order_quantity() -> Column:
    """(target − coverage + lead) · velocity, whole packs, at least the minimum."""
    needed = F.greatest(_int_div((F.col("target_days") + F.col("lead_days")) * F.col("sold") - F.col("stock") * F.col("records"), F.col("records")), F.lit(0).cast("bigint"))
    packs = _int_div(needed + F.col("pack") - 1, F.col("pack")) * F.col("pack")
    return big(F.greatest(packs, big(F.col("min_order"))))


def alerts(inventory: DataFrame, products: DataFrame, rules: RegimeRules) -> DataFrame:
    """Purchase alerts of every sale day that reaches the reorder point."""
    rows = sale_day_state(inventory).join(with_regime(products, rules), "product_id").where(needs_reorder())
    cost = F.coalesce(F.col("unit_cost"), F.lit(0).cast("decimal(12,2)"))
    coverage = dbl(F.col("stock") * F.col("records")) / dbl(F.col("sold"))
    return rows.select(
        F.col("move_date").alias("alert_date"), "product_id", "category", "line", "regime", "supplier_id", "lead_days",
        F.round(coverage, 1).alias("coverage_days"), order_quantity().alias("quantity"), urgency().alias("urgency"),
        dbl(cost).alias("unit_cost"), dbl(cost * order_quantity()).alias("total_cost"),
    )


# ---- open orders ---------------------------------------------------------------


def receipt_dates(purchases: DataFrame) -> DataFrame:
    """Order lines with arrival and end of tagging."""
    arrival = F.date_add("order_date", F.col("days_to_arrive"))
    return purchases.withColumn("arrival", arrival).withColumn("in_stock", F.date_add("arrival", TAGGING_DAYS))


def receipt_state(as_of: str) -> Column:
    day = F.lit(as_of).cast("date")
    return F.when(F.col("order_date") > day, "FUTURE").when(F.col("arrival") > day, "PENDING").when(F.col("in_stock") > day, "TAGGING").otherwise("RECEIVED")


def receipt_timeline(purchases: DataFrame, as_of: str, on_time_days: int = 45) -> DataFrame:
    return receipt_dates(purchases).select(
        "order_no", "line_no", "product_id", "supplier_id", "qty", "order_date", "arrival", "in_stock", receipt_state(as_of).alias("state"),
        (F.col("days_to_arrive") <= on_time_days).alias("on_time"),
    )


def open_per_product_day(purchases: DataFrame) -> DataFrame:
    """Changes of the number of open orders per product and day (+ at order,
    − when put in stock), summed before anything is sorted."""
    rows = receipt_dates(purchases)
    steps = F.array(F.struct(F.col("order_date").alias("day"), F.lit(1).alias("d")), F.struct(F.col("in_stock").alias("day"), F.lit(-1).alias("d")))
    return rows.select("product_id", F.inline(steps)).groupBy("product_id", "day").agg(F.sum("d").alias("change"))


def without_open_order(alert_rows: DataFrame, purchases: DataFrame) -> DataFrame:
    """Alerts of products that have no pending or tagging order that day.

    Alerts and order changes of a product are merged by day and the changes
    summed up, instead of a range join between alerts and orders.
    """
    rows = alert_rows.withColumn("_day", F.col("alert_date")).withColumn("_alert", F.lit(1))
    steps = open_per_product_day(purchases).withColumnRenamed("day", "_day").withColumn("_alert", F.lit(0))
    merged = rows.unionByName(steps, allowMissingColumns=True)
    # per product: at most one change per day, and its alerts
    w = Window.partitionBy("product_id").orderBy("_day", "_alert").rowsBetween(Window.unboundedPreceding, 0)
    is_open = F.coalesce(F.sum("change").over(w), F.lit(0)) > 0
    return merged.withColumn("_open", is_open).where((F.col("_alert") == 1) & ~F.col("_open")).select(*alert_rows.columns)


def open_orders_per_day(purchases: DataFrame, days: DataFrame) -> DataFrame:
    """Pending and tagging orders at the end of each calendar day."""
    rows = receipt_dates(purchases)
    step = lambda day, p, t: F.struct(F.col(day).alias("day"), F.lit(p).alias("p"), F.lit(t).alias("t"))
    changes = rows.select(F.inline(F.array(step("order_date", 1, 0), step("arrival", -1, 1), step("in_stock", 0, -1)))).groupBy("day").agg(
        F.sum("p").alias("p"), F.sum("t").alias("t")
    )
    # one row per calendar day
    w = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return days.join(changes, "day", "left").select(
        "day", big(F.coalesce(F.sum("p").over(w), F.lit(0))).alias("pending"), big(F.coalesce(F.sum("t").over(w), F.lit(0))).alias("tagging")
    )


def expected_arrivals(alert_rows: DataFrame, tiers: DataFrame) -> DataFrame:
    """Expected arrival: alert day plus the supplier's lead time, else the regime's."""
    lead = F.coalesce(F.col("lead_mean"), F.col("lead_days"))
    return alert_rows.join(tiers.select("supplier_id", "lead_mean"), "supplier_id", "left").withColumn("lead_time", lead).withColumn(
        "expected_date", F.date_add("alert_date", lead)
    ).drop("lead_mean", "lead_days")


def enrich_alerts(alert_rows: DataFrame, products: DataFrame, purchases: DataFrame) -> DataFrame:
    """Product name and earliest pending arrival on the alert day.

    Orders are classed by the power of two that their open days reach, so each
    lies in at most two periods of its class's length; alerts look into their
    own period of every class present.  One very long order adds one class.
    """
    orders = receipt_dates(purchases).select("product_id", "order_date", "arrival").where(F.col("arrival") > F.col("order_date")).distinct()
    orders = materialize(purchases.sparkSession, orders.withColumn("class", F.ceil(F.log2(F.date_diff("arrival", "order_date").cast("double"))).cast("int")), "receipts")
    period = lambda d: F.floor(F.unix_date(d) / F.pow(F.lit(2.0), F.col("class")))
    spread = orders.withColumn("period", F.explode(F.array(period("order_date"), period("order_date") + 1)))
    classes = orders.select(F.collect_set("class").alias("v")).scalar()
    rows = materialize(purchases.sparkSession, alert_rows.distinct(), "alerts")
    asked = rows.select("product_id", "alert_date").withColumn("class", F.explode(classes))
    a, o = asked.withColumn("period", period("alert_date")).alias("a"), spread.alias("o")
    is_open = (F.col("o.order_date") <= F.col("a.alert_date")) & (F.col("o.arrival") > F.col("a.alert_date"))
    met = a.join(o, (F.col("a.product_id") == F.col("o.product_id")) & (F.col("a.class") == F.col("o.class")) & (F.col("a.period") == F.col("o.period")) & is_open)
    # both days in one number, arrival first: only product, day and this number move
    days = F.shiftleft(F.unix_date("o.arrival").cast("bigint"), 32) + F.unix_date("o.order_date").cast("bigint") + F.lit(1 << 31)
    first = met.groupBy(F.col("a.product_id").alias("product_id"), F.col("a.alert_date").alias("alert_date")).agg(F.min(days).alias("_f"))
    arrival = F.date_from_unix_date(F.shiftright("_f", 32).cast("int"))
    ordered = F.date_from_unix_date((F.col("_f").bitwiseAND(F.lit((1 << 32) - 1)) - F.lit(1 << 31)).cast("int"))
    rows = rows.join(first, ["product_id", "alert_date"], "left").select(
        *alert_rows.columns, arrival.alias("pending_arrival"), ordered.alias("pending_order_date")
    ).join(products.select("product_id", "article"), "product_id", "left")
    return rows.withColumn("has_pending", F.col("pending_arrival").isNotNull()).withColumn("days_to_arrival", F.date_diff("pending_arrival", "alert_date"))


def risk_score() -> Column:
    """Risk from coverage and lead time; rules in this order."""
    c, lead = F.col("coverage_days"), F.coalesce(F.col("lead_time"), F.lit(20))
    return (
        F.when(c < 7, "CRITICAL").when(c < 15, "HIGH").when(c >= 30, "LOW").when(c < lead, "HIGH")
        .when(c > lead + 5, "LOW").when(c >= lead, "MEDIUM").otherwise("HIGH")
    )


def arrives_in_time() -> Column:
    return F.when(~F.col("has_pending"), "-").when(F.col("days_to_arrival") < F.col("coverage_days"), "YES").otherwise("NO")


def coverage_label() -> Column:
    c = F.col("coverage_days")
    return F.when(c <= 3, "CRITICAL").when(c <= 7, "VERY LOW").when(c <= 14, "LOW").when(c <= 30, "MEDIUM").when(c <= 60, "GOOD").otherwise("COMFORTABLE")


def urgency_rank(col: str = "urgency") -> Column:
    return F.array_position(F.array(*[F.lit(u) for u in URGENCY_ORDER]), F.col(col)).cast("int")


def alert_statistics(rows: DataFrame, performance: DataFrame) -> DataFrame:
    """Totals of scored alerts and the least reliable supplier among them."""
    per = rows.groupBy("supplier_id").agg(
        count_big().alias("n"), count_where(F.col("risk").isin("HIGH", "CRITICAL")).alias("hc"), count_where(F.col("in_time") == "NO").alias("no"), F.max("alert_date").alias("d")
    ).join(performance.select("supplier_id", "compliance"), "supplier_id", "left")
    return per.agg(
        big(F.sum("n")).alias("alerts"), big(F.sum("hc")).alias("high_or_critical"), percent(F.sum("hc"), F.sum("n"), 1).alias("high_or_critical_pct"),
        big(F.sum("no")).alias("ruptures"), F.count("supplier_id").alias("suppliers"), F.max("d").alias("latest"),
        F.min(F.when(F.col("compliance").isNotNull(), F.struct("compliance", "supplier_id"))).getField("supplier_id").alias("worst_supplier"),
    )


def buyer_kpis(rows: DataFrame) -> DataFrame:
    """Alert cost, critical alerts on the last day and in the last week, coverage up to 5 days."""
    last = rows.select(F.max("alert_date").alias("v")).scalar()
    critical = F.col("urgency") == "CRITICAL"
    return rows.withColumn("last", last).agg(
        F.round(dbl(F.sum(F.col("total_cost").cast("decimal(18,2)"))), 2).alias("alert_cost"), count_where(critical).alias("critical"),
        count_where(critical & (F.col("alert_date") == F.col("last"))).alias("critical_last_day"),
        count_where(critical & (F.col("alert_date") > F.date_sub("last", 7))).alias("critical_last_week"),
        count_where(F.col("coverage_days") <= 5).alias("rupture_risk"),
    )


def slice_alerts(rows: DataFrame, day: str | None = None, urgencies: list[str] | None = None, suppliers: list | None = None, categories: list[str] | None = None) -> DataFrame:
    if day:
        rows = rows.where(F.col("alert_date") == F.lit(day).cast("date"))
    if urgencies:
        rows = rows.where(F.col("urgency").isin(urgencies))
    if suppliers:
        rows = rows.where(F.col("supplier_id").isin(suppliers))
    return rows.where(F.col("category").isin(categories)) if categories else rows


def latest_alerts(rows: DataFrame, k: int = 200) -> DataFrame:
    return top(rows, k, F.desc("alert_date"), F.asc("product_id"))


def urgent_alerts(rows: DataFrame, k: int = 10) -> DataFrame:
    return top(rows, k, F.desc(urgency_rank()), F.asc("coverage_days"), F.desc("alert_date"), F.asc("product_id"))


# ---- slow movers and stock-outs --------------------------------------------------


def suggested_discount(days: Column) -> Column:
    """Largest discount among the tiers that contain ``days``."""
    inside = [F.when((days >= low) & (F.lit(True) if high is None else days < high), F.lit(d)) for low, high, d in DISCOUNTS]
    return F.greatest(*inside)


def slow_movers(inventory: DataFrame, as_of: str) -> DataFrame:
    """Longest run without a sale while stocked, per product, with discount.

    A run lasts from a sale day to the day before the next one (or ``as_of``).
    """
    end = F.lit(as_of).cast("date")
    sold = inventory.where((F.col("qty_sold") > 0) & (F.col("move_date") <= end)).select("product_id", "move_date", "stock")
    nxt = F.lead("move_date").over(Window.partitionBy("product_id").orderBy("move_date"))
    runs = sold.withColumn("days_without_sale", F.date_diff(F.coalesce(F.date_sub(nxt, 1), end), F.col("move_date")))
    runs = runs.where((F.col("stock") > 0) & (F.col("days_without_sale") >= SLOW_AFTER))
    worst = runs.groupBy("product_id").agg(F.max(F.struct("days_without_sale", F.col("move_date").alias("last_sale"), "stock")).alias("r")).select("product_id", "r.*")
    return worst.withColumn("discount", suggested_discount(F.col("days_without_sale")))


def stock_outs(inventory: DataFrame) -> DataFrame:
    """Days on which stock falls from above zero to zero or less, with the
    next receipt."""
    w = Window.partitionBy("product_id").orderBy("move_date")
    receipt = F.when(F.col("qty_in") > 0, F.col("move_date"))
    rows = inventory.select(
        "product_id", "move_date", "stock", F.lag("stock").over(w).alias("before"),
        F.min(receipt).over(w.rowsBetween(1, Window.unboundedFollowing)).alias("restocked"),
    )
    return rows.where((F.col("before") > 0) & (F.col("stock") <= 0)).select(
        "product_id", F.col("move_date").alias("stock_out_date"), "restocked", F.date_diff("restocked", "move_date").alias("days_until_restock")
    )


def first_stock_out(inventory: DataFrame) -> DataFrame:
    first = F.min(F.struct("stock_out_date", "restocked", "days_until_restock"))
    return stock_outs(inventory).groupBy("product_id").agg(first.alias("f"), count_big().alias("stock_outs")).select("product_id", "f.*", "stock_outs")


def sell_through(inventory: DataFrame, products: DataFrame, rules: RegimeRules) -> DataFrame:
    """Sold over opening plus received for seasonal SKUs; reorder at 70 %."""
    first = F.min_by(F.col("stock") - F.col("qty_in") + F.col("qty_sold"), "move_date")
    per = inventory.groupBy("product_id").agg(first.alias("opening"), F.sum("qty_in").alias("received"), F.sum("qty_sold").alias("sold"))
    rows = per.join(products.withColumn("regime", regime(rules)).where(F.col("regime") == "seasonal").select("product_id", "category"), "product_id")
    available = F.col("opening") + F.col("received")
    return rows.select(
        "product_id", "category", "opening", "received", "sold", F.round(dbl(F.col("sold")) / F.nullif(dbl(available), F.lit(0.0)), 4).alias("sell_through"),
        ((F.col("sold") * 10 >= available * int(SEASONAL_REORDER_AT * 10)) & (available > 0)).alias("reorder"),
    )


def ledger(movements: DataFrame, opening: Column, counted: DataFrame, keys: list[str]) -> DataFrame:
    """Book stock (opening + in − out, transfers and adjustments included when
    present) after every movement day and on every counted day.

    Days without a count have neither counted stock nor difference; a count on a day without movement meets the stock of the
    last movement before it, or the opening stock.
    """
    has = lambda c: F.col(c) if c in movements.columns else F.lit(0)
    net = F.col("qty_in") - F.col("qty_sold") + has("qty_transfer_in") - has("qty_transfer_out") + has("qty_adjust_up") - has("qty_adjust_down")
    at = [*keys, "move_date"]
    moved = movements.groupBy(*at).agg(F.sum(net).alias("_net")).withColumn("_count", F.lit(0))
    counts = counted.select(*at, "counted_stock").withColumn("_count", F.lit(1))
    # per key: one row per movement day and the counts
    rows = moved.unionByName(counts, allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy("move_date").rangeBetween(Window.unboundedPreceding, 0)
    day = Window.partitionBy(*keys).orderBy("move_date").rangeBetween(0, 0)
    book = rows.withColumn("book_stock", big(opening + F.coalesce(F.sum("_net").over(w), F.lit(0)))).withColumn("_counts", F.sum("_count").over(day))
    kept = book.where((F.col("_count") == 1) | (F.col("_counts") == 0))  # the counts of a day take the place of its movement
    return kept.select(*at, "book_stock", "counted_stock", (F.col("counted_stock") - F.col("book_stock")).alias("difference"))


# ---- daily log ---------------------------------------------------------------------

LOG = ["stock", "sales_qty", "stock_outs", "receipts", "alerts", "slow_movers"]


def daily_log(inventory: DataFrame, sales: DataFrame, products: DataFrame, rules: RegimeRules, days: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Operations per calendar day (and category, line): stock, sales, value,
    stock-outs, receipts, alerts, slow movers.

    Every product day turns into dated changes; stock and the number of slow
    movers are running sums of changes, so no product × day grid exists.
    """
    by = by or []
    w = Window.partitionBy("product_id").orderBy("move_date")
    before = F.lag("stock").over(w)
    is_sale = F.col("qty_sold") > 0
    next_sale = F.min(F.when(is_sale, F.col("move_date"))).over(w.rowsBetween(1, Window.unboundedFollowing))
    # velocity of the last 30 sale days: a range over the running number of sales
    counted = inventory.withColumn("_sales", F.count_if(is_sale).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    last_sales = Window.partitionBy("product_id").orderBy("_sales").rangeBetween(-29, 0)
    rows = counted.select(
        "product_id", "move_date", "stock", "qty_sold", "qty_in", before.alias("before"), next_sale.alias("next_sale"), is_sale.alias("is_sale"),
        F.sum("qty_sold").over(last_sales).alias("sold"), F.count_if(is_sale).over(last_sales).alias("records"),
    ).join(with_regime(products, rules), "product_id")
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("bigint")
    zero = F.lit(0).cast("bigint")
    slow_from = F.date_add("move_date", SLOW_AFTER)
    slow = F.coalesce((F.col("qty_sold") > 0) & (F.col("stock") > 0) & (F.col("next_sale").isNull() | (F.col("next_sale") > slow_from)), F.lit(False))
    change = lambda day, *vals: F.struct(day.alias("day"), *[big(v).alias(n) for n, v in zip(LOG, vals)])
    moved = change(
        F.col("move_date"), F.col("stock") - F.coalesce(F.col("before"), zero), F.col("qty_sold"), flag((F.col("before") > 0) & (F.col("stock") <= 0)),
        flag(F.col("qty_in") > 0), flag(F.col("is_sale") & needs_reorder()), zero,
    )
    begins = change(slow_from, zero, zero, zero, zero, zero, F.lit(1))
    ends = change(F.col("next_sale"), zero, zero, zero, zero, zero, F.lit(-1))
    events = F.when(slow & F.col("next_sale").isNotNull(), F.array(moved, begins, ends)).when(slow, F.array(moved, begins)).otherwise(F.array(moved))
    per_day = rows.select(*by, F.inline(events)).groupBy("day", *by).agg(*[F.sum(c).alias(c) for c in LOG])
    sold = sales.select("product_id", F.col("sale_date").alias("day"), "net")
    if by:
        sold = sold.groupBy("product_id", "day").agg(F.sum("net").alias("net")).join(products.select("product_id", *by), "product_id")
    value = sold.groupBy("day", *by).agg(F.sum("net").alias("net"))
    frame = days
    if by:
        edge = lambda f: days.select(f("day").alias("v")).scalar()
        frame = products.select(*by).distinct().withColumn("day", F.explode(F.sequence(edge(F.min), edge(F.max))))
    run = Window.partitionBy(*by).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    filled = lambda c: big(F.coalesce(c, F.lit(0)))
    return frame.join(per_day, ["day", *by], "left").join(value, ["day", *by], "left").select(
        "day", *by, filled(F.sum("stock").over(run)).alias("total_stock"), filled(F.col("sales_qty")).alias("sales_qty"),
        dbl(F.coalesce("net", F.lit(0).cast("decimal(12,2)"))).alias("sales_value"), filled(F.col("stock_outs")).alias("stock_outs"),
        filled(F.col("receipts")).alias("receipts"), filled(F.col("alerts")).alias("alerts"), filled(F.sum("slow_movers").over(run)).alias("slow_movers"),
    )


def log_by_month(log: DataFrame) -> DataFrame:
    value = F.col("sales_value").cast("decimal(18,2)")
    return log.groupBy(F.date_format("day", "yyyy-MM").alias("month")).agg(
        big(F.sum("sales_qty")).alias("sales_qty"), dbl(F.sum(value)).alias("sales_value"), F.round(dbl(F.sum("sales_qty")) / count_big(), 1).alias("daily_qty"),
        F.round(dbl(F.sum(value)) / count_big(), 2).alias("daily_value"), big(F.sum("stock_outs")).alias("stock_outs"), big(F.sum("alerts")).alias("alerts"), count_big().alias("days"),
    )


def log_totals(log: DataFrame) -> DataFrame:
    value = F.col("sales_value").cast("decimal(18,2)")
    return log.agg(
        count_big().alias("days"), F.min("day").alias("first_day"), F.max("day").alias("last_day"), big(F.sum("sales_qty")).alias("sales_qty"),
        dbl(F.sum(value)).alias("sales_value"), F.round(dbl(F.sum("sales_qty")) / count_big(), 1).alias("daily_qty"), F.round(dbl(F.sum(value)) / count_big(), 2).alias("daily_value"),
        big(F.sum("stock_outs")).alias("stock_outs"), big(F.sum("alerts")).alias("alerts"), big(F.sum("receipts")).alias("receipts"),
        F.max_by("total_stock", "day").alias("final_stock"),
    )


def every_nth_day(log: DataFrame, n: int = 7) -> DataFrame:
    """Plotting sample: every n-th day counted from the first one."""
    first = log.select(F.min("day").alias("v")).scalar()
    return log.where(F.date_diff(F.col("day"), first) % n == 0)


def regime_distribution(products: DataFrame, rules: RegimeRules) -> DataFrame:
    return products.groupBy(regime(rules).alias("regime")).agg(count_big().alias("products"))
