"""Star-schema view of the driver's tables.

Each method is a lazy DataFrame.  Derived attributes follow the fixture notes;
``storeops.plans.oracle`` holds the same definitions as SQL.
"""

from __future__ import annotations

import os
from decimal import Decimal
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storeops.functions.columns import cents_of, count_big, from_cents, money, money_of, percent_of_cents, scalar_of
from storeops.functions.ranks import ranked
from storeops.session import materialize, size_shuffles
from storeops.sources.tables import read_source

LINE_ORDER = (
    "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_shipdate", "l_returnflag", "l_linestatus",
)


GOLD_FACTS = ("fact_sales", "fact_inventory", "fact_store_inventory", "fact_purchases", "fact_returns")


class Mart:
    """Dimensions and facts below ``path``.

    With ``gold`` set, facts are read from the tables stored there by
    ``storeops.sources.loads.store_gold``; otherwise each is derived on use.
    """

    def __init__(self, spark: SparkSession, path: str, gold: str | None = None):
        self.spark = spark
        self.path = path
        self.gold = gold

    def raw(self, name: str) -> DataFrame:
        if name == "lineitem":
            self._sized  # noqa: B018
        return read_source(self.spark, self.path, name)

    @cached_property
    def _sized(self) -> int:
        """Rows of the largest fact (from the file footers), by which its shuffles are sized."""
        rows = read_source(self.spark, self.path, "lineitem").count()
        size_shuffles(self.spark, rows)
        return rows

    def __getattribute__(self, name: str):
        if name in GOLD_FACTS and object.__getattribute__(self, "gold"):
            fact = self.spark.read.parquet(os.path.join(self.gold, name))
            size_shuffles(self.spark, fact.count())
            return fact
        return object.__getattribute__(self, name)

    # ---- dimensions ------------------------------------------------------

    @cached_property
    def dim_product(self) -> DataFrame:
        n_sup = scalar_of(self.raw("supplier"), count_big())
        key = F.col("p_partkey")
        pick = lambda k, names: F.element_at(F.array(*[F.lit(n) for n in names]), (key % k + 1).cast("int"))
        return self.raw("part").select(
            key.alias("product_id"),
            F.col("p_name").alias("article"),
            F.col("p_type").alias("category"),
            F.concat(F.lit("LINE-"), (F.col("p_size") % 5).cast("string")).alias("line"),
            (F.col("p_size") % 4).cast("string").alias("size_code"),
            F.col("p_brand").alias("product_type"),
            pick(4, ["CONTINUOUS", "SEMI-CONTINUOUS", "SUMMER", "WINTER"]).alias("collection"),
            pick(10, ["ACTIVE"] * 7 + ["CLEARANCE", "INACTIVE", "DISCONTINUED"]).alias("status"),
            F.when(key % 13 != 0, key % n_sup).alias("supplier_id"),
            F.when(key % 11 != 0, money((1 + key % 40) * F.lit(Decimal("0.53")))).alias("unit_cost"),
        )

    @cached_property
    def dim_store(self) -> DataFrame:
        return self.raw("nation").join(F.broadcast(self.raw("region")), F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
            F.col("n_nationkey").alias("store_id"),
            F.col("n_name").alias("store"),
            F.col("r_name").alias("city"),
        )

    @cached_property
    def dim_supplier(self) -> DataFrame:
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("supplier_id"),
            F.col("s_name").alias("supplier"),
            F.concat(F.lit("SEG-"), (F.col("s_nationkey") % 5).cast("string")).alias("supplier_category"),
        )

    @cached_property
    def dim_customer(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_mktsegment").alias("segment"),
            F.col("c_nationkey").alias("store_id"),
        )

    @cached_property
    def date_span(self) -> DataFrame:
        """One row: first and last day over orders and shipments."""
        spans = (
            self.raw("orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
            .unionByName(self.raw("lineitem").agg(F.min("l_shipdate").alias("a"), F.max("l_shipdate").alias("b")))
        )
        return spans.agg(F.min("a").cast("date").alias("first_day"), F.max("b").cast("date").alias("last_day"))

    @cached_property
    def calendar(self) -> DataFrame:
        """Every day of the span, stored once: checks read it several times."""
        days = self.date_span.select(F.explode(F.sequence("first_day", "last_day")).alias("day"))
        return materialize(self.spark, days, "calendar")

    # ---- facts -----------------------------------------------------------

    @cached_property
    def lines(self) -> DataFrame:
        """Order lines with a unique item number (``l_linenumber`` repeats).

        Only queries that use ``item_no`` pay for the window; Catalyst drops
        it from all others.
        """
        w = Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)
        return self.raw("lineitem").withColumn("item_no", F.row_number().over(w))

    @cached_property
    def numbered_lines(self) -> DataFrame:
        """``lines``, numbered so that an order of any size is sorted by ranges, not by one task.

        Rows that agree in all of LINE_ORDER are interchangeable.  Costs a count and a sample when it is built.
        """
        return ranked(self.raw("lineitem"), ["l_orderkey"], [F.col(c) for c in LINE_ORDER], "item_no")

    @cached_property
    def _tickets(self) -> DataFrame:
        """Order header with its store; joined before the lines so that the
        large side is shuffled once, on the order key.

        Lines and tickets are both facts.  The merge hint keeps Spark from
        broadcasting one of them because compressed files look small; AQE
        still splits a hot order key.
        """
        return self.raw("orders").join(self.raw("customer"), F.col("o_custkey") == F.col("c_custkey")).hint("merge")

    @cached_property
    def fact_sales(self) -> DataFrame:
        return self._sales(self.lines)

    @cached_property
    def numbered_sales(self) -> DataFrame:
        """``fact_sales`` for uses that need the item number of very large tickets."""
        return self._sales(self.numbered_lines)

    def _sales(self, lines: DataFrame) -> DataFrame:
        gross = cents_of(F.col("l_extendedprice"))
        kept = 100 - cents_of(F.col("l_discount"))
        return lines.join(self._tickets, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("o_orderdate").cast("date").alias("sale_date"),
            F.col("c_nationkey").alias("store_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("o_custkey").alias("customer_id"),
            (F.col("l_orderkey") % 40).alias("seller_id"),
            F.col("l_orderkey").alias("ticket"),
            F.col("item_no"),
            F.col("l_quantity").cast("int").alias("qty"),
            from_cents(gross).alias("gross"),
            from_cents(percent_of_cents(gross, kept)).alias("net"),
            from_cents(percent_of_cents(gross, 60)).alias("cost"),
        )

    def _moves(self, *extra) -> DataFrame:
        """Units in, sold and exchanged per product, day and ``extra`` keys.

        Grouped straight from the lines, so a product that owns most rows
        reaches later steps with at most one row per day and key.
        """
        flag = lambda f: F.sum(F.when(F.col("l_returnflag") == f, F.col("l_quantity").cast("bigint")).otherwise(0))
        return (
            self.raw("lineitem")
            .groupBy(
                F.col("l_partkey").alias("product_id"), *extra, F.col("l_shipdate").cast("date").alias("move_date"),
            )
            .agg(flag("N").alias("qty_in"), flag("A").alias("qty_sold"), flag("R").alias("qty_exchanged"))
        )

    @cached_property
    def movements(self) -> DataFrame:
        n_store = scalar_of(self.raw("nation"), count_big())
        return self._moves((F.col("l_suppkey") % n_store).cast("int").alias("store_id"))

    @cached_property
    def fact_inventory(self) -> DataFrame:
        """Chain stock per product and movement day."""
        return running_stock(self._moves(), ["product_id"], 50 * (F.col("product_id") % 10))

    @cached_property
    def fact_store_inventory(self) -> DataFrame:
        return running_stock(self.movements, ["product_id", "store_id"], 10 * (F.col("product_id") % 10))

    @cached_property
    def stock_book(self) -> DataFrame:
        """Daily stock per product and store with all ten measures.

        Line 6 of an order stands for transfers, line 7 for adjustments; stock is counted on the first three days of a month.
        """
        n_store = scalar_of(self.raw("nation"), count_big())
        line, qty = F.col("l_linenumber"), F.col("l_quantity").cast("bigint")
        of = lambda flag, cond: F.sum(F.when((F.col("l_returnflag") == flag) & cond, qty).otherwise(0))
        daily = self.raw("lineitem").groupBy(
            F.col("l_partkey").alias("product_id"), (F.col("l_suppkey") % n_store).cast("int").alias("store_id"), F.col("l_shipdate").cast("date").alias("move_date"),
        ).agg(
            of("N", line < 6).alias("qty_in"), of("A", line < 6).alias("qty_sold"), of("R", F.lit(True)).alias("qty_exchanged"),
            of("N", line == 6).alias("qty_transfer_in"), of("A", line == 6).alias("qty_transfer_out"),
            of("N", line > 6).alias("qty_adjust_up"), of("A", line > 6).alias("qty_adjust_down"),
        )
        net = F.col("qty_in") - F.col("qty_sold") + F.col("qty_transfer_in") - F.col("qty_transfer_out") + F.col("qty_adjust_up") - F.col("qty_adjust_down")
        w = Window.partitionBy("product_id", "store_id").orderBy("move_date").rowsBetween(Window.unboundedPreceding, 0)
        stock = daily.withColumn("stock", 10 * (F.col("product_id") % 10) + F.sum(net).over(w))
        return stock.withColumn("stock_open", F.col("stock") - net).withColumn("counted", F.when(F.dayofmonth("move_date") <= 3, F.col("stock")))

    @cached_property
    def fact_purchases(self) -> DataFrame:
        return self._purchases(self.lines)

    @cached_property
    def numbered_purchases(self) -> DataFrame:
        """``fact_purchases`` for uses that need the item number of very large orders."""
        return self._purchases(self.numbered_lines)

    def _purchases(self, lines: DataFrame) -> DataFrame:
        qty = F.col("l_quantity").cast("int")
        arrive = (10 + (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 3) % 60).cast("int")
        return lines.join(self._tickets, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("l_orderkey").alias("order_no"),
            F.col("item_no"),
            F.col("l_linenumber").alias("line_no"),
            F.col("c_nationkey").alias("store_id"),
            F.col("l_suppkey").alias("supplier_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("o_orderpriority").alias("order_type"),
            qty.alias("qty"),
            money_of(F.col("l_extendedprice")).alias("gross"),
            arrive.alias("days_to_arrive"),
        )

    @cached_property
    def fact_returns(self) -> DataFrame:
        """Returned (R) and substitute (A) items of an exchange."""
        items = self.raw("lineitem").where(F.col("l_returnflag").isin("R", "A"))
        returned = F.col("l_returnflag") == "R"
        return items.join(self._tickets, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("l_orderkey").alias("exchange_id"),
            F.col("o_orderdate").cast("date").alias("exchange_date"),
            F.col("c_nationkey").alias("store_id"),
            F.when(returned, F.col("l_partkey")).otherwise(F.lit(-1)).alias("returned_id"),
            F.when(~returned, F.col("l_partkey")).alias("substitute_id"),
            F.when(returned, "RETURNED").otherwise("SUBSTITUTE").alias("item_kind"),
            F.col("l_quantity").cast("int").alias("qty"),
            money_of(F.col("l_extendedprice")).alias("gross"),
        )


def running_stock(daily: DataFrame, keys: list[str], opening) -> DataFrame:
    """Opening stock plus received minus sold, after each movement day.

    One row per key and day, so a window partition is bounded by the calendar.
    """
    w = Window.partitionBy(*keys).orderBy("move_date").rowsBetween(Window.unboundedPreceding, 0)
    return daily.withColumn("stock", opening + F.sum(F.col("qty_in") - F.col("qty_sold")).over(w))

