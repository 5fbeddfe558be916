"""The buyer's day as nested documents: totals, labelled alerts, open orders, slow movers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeops.functions.columns import big, top
from storeops.functions.ranks import ranked
from storeops.operators.control import coverage_label, receipt_dates, urgency_rank
from storeops.session import materialize

PAGE_SIZE = 200  # entries of a list in one document
SLOW_SHOWN = 5
ALERT, ORDER = "ALERT", "ORDER"


def open_order_days(purchases: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """Each order line on each day of the span on which it is pending or being tagged, with the days that remain.

    A line is open for its days to arrive and the tagging days, so it gives a bounded number of rows.
    """
    first, last = F.lit(first_day).cast("date"), F.lit(last_day).cast("date")
    rows = receipt_dates(purchases).where((F.col("order_date") <= last) & (F.col("in_stock") > first))
    begins, ends = F.greatest("order_date", first), F.least(F.date_sub("in_stock", 1), last)
    daily = rows.where(begins <= ends).withColumn("day", F.explode(F.sequence(begins, ends)))
    pending = F.col("arrival") > F.col("day")
    return daily.select(
        "day", "order_no", "line_no", "product_id", "supplier_id", "qty", F.when(pending, "PENDING").otherwise("TAGGING").alias("state"),
        F.date_diff(F.when(pending, F.col("arrival")).otherwise(F.col("in_stock")), "day").alias("days_remaining"),
    )


PLACE = ["first", "coverage_days", "order_no", "line_no", "product_id", "supplier_id", "quantity"]  # order of a list


def _entries(alert_rows: DataFrame, purchases: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """Alerts and open orders under one schema: day, section, the columns of PLACE, label (urgency or state).

    ``first`` is the rank of the urgency, most urgent first, or the days that remain.  Each value stands there once, as these rows are sorted.
    """
    numbers = lambda *names: [big(F.col(n)).alias(n) for n in names]
    alerts = alert_rows.where(F.col("alert_date").between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))).select(
        F.col("alert_date").alias("day"), F.lit(ALERT).alias("section"), (-urgency_rank()).alias("first"),
        F.col("coverage_days").cast("double").alias("coverage_days"), *numbers("product_id", "supplier_id", "quantity"), F.col("urgency").alias("label"),
    )
    orders = open_order_days(purchases, first_day, last_day).select(
        "day", F.lit(ORDER).alias("section"), F.col("days_remaining").alias("first"), *numbers("order_no", "line_no", "product_id", "supplier_id"),
        big(F.col("qty")).alias("quantity"), F.col("state").alias("label"),
    )
    return alerts.unionByName(orders, allowMissingColumns=True)


def day_documents(
    log: DataFrame, alert_rows: DataFrame, purchases: DataFrame, slow: DataFrame, first_day: str, last_day: str, page_size: int = PAGE_SIZE,
) -> DataFrame:
    """day, page, totals, alerts, open_orders, slow_movers: the documents of each day from ``first_day`` to ``last_day``.

    Each list is numbered over the whole day and cut into pages, so a document holds at most ``page_size`` entries of a list
    however many a day has, and no task gathers a day.  Totals and slow movers (the longest without a sale) stand on page 0,
    which every day of ``log`` has.  Totals, slow movers and entries are stored one after the other, so that what is shuffled
    for one is gone before the next; the entries move twice more, to be numbered and to come to their page.
    """
    spark = alert_rows.sparkSession
    days = log.where(F.col("day").between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date")))
    totals = materialize(spark, days.select("day", F.struct(*[c for c in days.columns if c != "day"]).alias("totals")), "day-totals")
    shown = materialize(spark, top(slow, SLOW_SHOWN, F.desc("days_without_sale"), F.asc("product_id")), "slow-shown")
    entries = materialize(spark, _entries(alert_rows, purchases, first_day, last_day), "day-entries")
    numbered = ranked(entries, ["day", "section"], [F.col(c) for c in PLACE], "position")
    paged = numbered.withColumn("page", F.floor((F.col("position") - 1) / page_size).cast("int"))
    alert = ["product_id", "supplier_id", "quantity", F.col("label").alias("urgency"), "coverage_days", coverage_label().alias("coverage_label")]
    order = ["order_no", "line_no", "product_id", "supplier_id", "quantity", F.col("label").alias("state"), F.col("first").alias("days_remaining")]
    listed = lambda section, fields: F.sort_array(F.collect_list(F.when(F.col("section") == section, F.struct(big(F.col("position")).alias("position"), *fields))))
    # the totals take part as rows of page 0, so nothing meets them by day
    pages = paged.unionByName(totals.withColumn("page", F.lit(0)), allowMissingColumns=True).groupBy("day", "page").agg(
        F.first("totals", ignorenulls=True).alias("totals"), listed(ALERT, alert).alias("alerts"), listed(ORDER, order).alias("open_orders"))
    listing = F.sort_array(F.collect_list(F.struct(
        (-F.col("days_without_sale")).alias("_order"), big(F.col("product_id")).alias("product_id"), big(F.col("stock")).alias("stock"), "days_without_sale", "discount")))
    shown_fields = lambda r: F.struct(*[r[f].alias(f) for f in ("product_id", "stock", "days_without_sale", "discount")])
    worst = shown.agg(F.transform(listing, shown_fields).alias("v")).scalar()
    return pages.select("day", "page", "totals", "alerts", "open_orders", F.when(F.col("page") == 0, worst).alias("slow_movers"))


def flat_documents(documents: DataFrame) -> DataFrame:
    """One row per total, alert, order and slow mover of the documents, with its place in its list."""
    null = lambda kind: F.lit(None).cast(kind)
    row = lambda section, position, product, supplier, quantity, label, days: F.struct(
        F.lit(section).alias("section"), position.cast("bigint").alias("position"), product.cast("bigint").alias("product_id"), supplier.cast("bigint").alias("supplier_id"),
        quantity.cast("bigint").alias("quantity"), label.cast("string").alias("label"), days.cast("int").alias("days"))
    parts = F.concat(
        F.when(F.col("totals").isNotNull(), F.array(row("TOTALS", F.lit(0), null("bigint"), null("bigint"), F.col("totals.sales_qty"), null("string"), null("int")))).otherwise(F.array()),
        F.transform("alerts", lambda a: row(ALERT, a["position"], a["product_id"], a["supplier_id"], a["quantity"], a["coverage_label"], null("int"))),
        F.transform("open_orders", lambda o: row(ORDER, o["position"], o["product_id"], o["supplier_id"], o["quantity"], o["state"], o["days_remaining"])),
        F.coalesce(F.transform("slow_movers", lambda s, i: row("SLOW", i + 1, s["product_id"], null("bigint"), s["stock"], s["discount"], s["days_without_sale"])), F.array()),
    )
    return documents.select("day", "page", F.inline(parts))
