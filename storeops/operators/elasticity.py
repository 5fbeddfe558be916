"""Price elasticity on category and month aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeops.functions.columns import big, count_big, count_where, dbl, divide, month_start, percent
from storeops.operators.market import unit_price_cents


def month_aggregates(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Quantity, mean net value and their logs per category and month."""
    valid = sales.where((F.col("qty") > 0) & (F.col("net") > 0))
    per = valid.groupBy("product_id", month_start(F.col("sale_date")).alias("month")).agg(
        F.sum("qty").alias("qty"), F.sum("net").alias("net"), count_big().alias("n")
    )
    cat = per.join(products.where(F.col("category").isNotNull()).select("product_id", "category"), "product_id").groupBy("category", "month").agg(
        dbl(F.sum("qty")).alias("qty"), divide(F.sum("net"), F.sum("n")).alias("price"), big(F.sum("n")).alias("transactions")
    )
    return cat.withColumn("ln_qty", F.ln("qty")).withColumn("ln_price", F.ln("price"))


def _regression() -> list[Column]:
    y, x = F.col("ln_qty"), F.col("ln_price")
    return [
        count_big().alias("n"), F.regr_slope(y, x).alias("elasticity"), F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"), F.corr(y, x).alias("r"),
    ]


def elasticity_by_category(months: DataFrame, min_months: int = 3) -> DataFrame:
    """ln(quantity) on ln(price), all categories in one grouping."""
    return months.groupBy("category").agg(
        *_regression(), F.avg("price").alias("mean_price"), F.sum("qty").alias("qty"), F.count_distinct("month").alias("months")
    ).where((F.col("n") >= min_months) & F.col("elasticity").isNotNull())


def pooled_elasticity(months: DataFrame) -> DataFrame:
    return months.agg(*_regression())


# Lower bound of the coefficient and its reading.
READINGS = [
    (0.5, "ELASTIC (POSITIVE, MIX EFFECT)"), (0.1, "SLIGHTLY ELASTIC (POSITIVE)"), (-0.1, "NEAR-UNIT ELASTIC"),
    (-0.5, "SLIGHTLY INELASTIC"), (-1.0, "INELASTIC"), (-2.0, "ELASTIC"),
]


def reading(beta: Column) -> Column:
    expr = F
    for bound, label in READINGS:
        expr = expr.when(beta > bound, label)
    return expr.otherwise("HIGHLY ELASTIC")


def revenue_effect(elasticities: DataFrame, changes: list[float]) -> DataFrame:
    """Quantity and revenue effect of price changes, in percent."""
    rows = elasticities.select("category", "elasticity", F.explode(F.array(*[F.lit(c) for c in changes])).alias("price_change"))
    qty = 1 + F.col("elasticity") * F.col("price_change")
    return rows.select(
        "category", F.round(F.col("price_change") * 100, 1).alias("price_pct"), F.round((qty - 1) * 100, 2).alias("qty_pct"),
        F.round((qty * (1 + F.col("price_change")) - 1) * 100, 2).alias("revenue_pct"),
    )


def price_variation(sales: DataFrame, min_sales: int = 50) -> DataFrame:
    """How many SKUs sold at a single price, how many allow a fit of their own."""
    prices = sales.where(F.col("qty") > 0).groupBy("product_id", unit_price_cents().alias("price")).agg(count_big().alias("n"))
    per = prices.groupBy("product_id").agg(count_big().alias("prices"), F.sum("n").alias("sales"))
    return per.agg(
        count_big().alias("products"), count_where(F.col("prices") == 1).alias("single_price"),
        percent(count_where(F.col("prices") == 1), count_big()).alias("single_price_pct"),
        count_where((F.col("sales") >= min_sales) & (F.col("prices") >= 2)).alias("fit_candidates"),
    )
