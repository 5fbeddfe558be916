"""Column helpers shared by the operators."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def money(col: Column) -> Column:
    """Amount as DECIMAL(12,2), so that sums do not depend on row order."""
    return col.cast("decimal(12,2)")


def cents_of(amount: Column) -> Column:
    """Whole cents of a DOUBLE amount with two decimals."""
    return F.rint(amount * 100).cast("bigint")


def from_cents(cents: Column) -> Column:
    """Whole cents as DECIMAL(12,2)."""
    return (cents.cast("decimal(12,0)") * F.lit(Decimal("0.01"))).cast("decimal(12,2)")


def money_of(amount: Column) -> Column:
    """DOUBLE amount with two decimals as DECIMAL(12,2).  Long arithmetic up to
    the last step costs a fraction of casting each double to a decimal."""
    return from_cents(cents_of(amount))


def percent_of_cents(cents: Column, pct: Column | int) -> Column:
    """pct percent of non-negative cents, half up, in whole cents."""
    return F.call_function("div", cents * pct + 50, F.lit(100).cast("bigint"))


def dbl(col: Column) -> Column:
    return col.cast("double")


def big(col: Column) -> Column:
    return col.cast("bigint")


def total(name: str) -> Column:
    """Sum of an exact column, shown as double."""
    return dbl(F.sum(name))


def count_big() -> Column:
    return F.count(F.lit(1))


def divide(num: Column, den: Column) -> Column:
    """num / den in doubles, NULL for a zero divisor."""
    return dbl(num) / F.nullif(dbl(den), F.lit(0.0))


def ratio(num: Column, den: Column, digits: int = 4) -> Column:
    return F.round(divide(num, den), digits)


def percent(num: Column, den: Column, digits: int = 2) -> Column:
    return F.round(F.lit(100.0) * dbl(num) / F.nullif(dbl(den), F.lit(0.0)), digits)


def count_where(cond: Column) -> Column:
    """Rows that satisfy ``cond`` (0, not NULL, when there are none)."""
    return F.count_if(cond)


def sum_where(cond: Column, value: Column) -> Column:
    return F.coalesce(F.sum(F.when(cond, value)), F.lit(0))


def date_key(col: Column) -> Column:
    """YYYYMMDD integer of a date."""
    return F.date_format(col, "yyyyMMdd").cast("int")


def month_key(col: Column) -> Column:
    return F.year(col) * 100 + F.month(col)


def month_start(col: Column) -> Column:
    return F.trunc(col, "month")


def week_start(col: Column) -> Column:
    """Monday of the ISO week."""
    return F.trunc(col, "week")


def scalar_of(df: DataFrame, agg: Column) -> Column:
    """One-row aggregate as a scalar subquery (no join, no collect)."""
    return df.select(agg.alias("v")).scalar()


def days_between(later: Column, earlier: Column) -> Column:
    return F.date_diff(later, earlier)


def coverage_days(stock: Column, velocity: Column, none: float = 999.0) -> Column:
    """Days the stock lasts; ``none`` when nothing is sold."""
    return F.when(dbl(velocity) > 0, dbl(stock) / dbl(velocity)).otherwise(F.lit(none))


def banded(value: Column, bands: list[tuple[float, str]], last: str) -> Column:
    """Label by the first band whose (exclusive) upper bound exceeds value."""
    expr = None
    for upper, label in bands:
        cond = value < F.lit(upper)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return F.when(value.isNull(), F.lit(None)).otherwise(expr.otherwise(last))


def literal_table(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A few fixed rows as a JVM-side table."""
    entries = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*entries)))


def top(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """Global top k (TakeOrderedAndProject: k rows per task, then k rows)."""
    return df.orderBy(*order).limit(k)


def top_per(df: DataFrame, keys: list[str], k: int, *order: Column, rank: str = "rank") -> DataFrame:
    """First k rows per group.

    Spark pushes the rank limit below the shuffle (WindowGroupLimit), so even
    a hot group sends only k rows per map task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)
