"""Fact builders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeops.functions.columns import money
from storeops.operators.dims import one_per_key


def one_header(headers: DataFrame, on: list[str]) -> DataFrame:
    """One header per document key, chosen by value rather than by arrival."""
    if len(on) == 1:
        return one_per_key(headers, on[0])
    rest = [c for c in headers.columns if c not in on]
    return headers.groupBy(*on).agg(F.min(F.struct(*rest)).alias("r")).select(*on, "r.*")


def attach_header(items: DataFrame, headers: DataFrame, on: list[str]) -> DataFrame:
    """Items with their header columns; a duplicated header never fans out."""
    return items.join(one_header(headers, on), on)


def dedupe_inventory(rows: DataFrame, keys: list[str], sums: list[str], lasts: list[str]) -> DataFrame:
    """One row per key: movements add up, stock levels keep their maximum."""
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums], *[F.max(c).alias(c) for c in lasts])


def build_purchases(headers: DataFrame, model_lines: DataFrame, sku_lines: DataFrame) -> DataFrame:
    """Order header ⋈ article line ⋈ SKU line.

    The header joins the article lines, deduplicated; they are narrow and one per order and article from there on.  The two
    line tables meet on (order, article), which spreads a large order over tasks, so the wide SKU lines move once.
    """
    on = ["order_no", "article_code"]
    known = attach_header(model_lines.select(*on), headers, ["order_no"])
    given = [F.first(c).alias(c) for c in headers.columns if c != "order_no"]  # one header per order: all rows of a group agree
    return sku_lines.join(known.groupBy(*on).agg(*given) if given else known.distinct(), on)


def prorate(lines: DataFrame, headers: DataFrame, order: str, item: str, weight: str, amounts: list[str]) -> DataFrame:
    """Spreads header ``amounts`` over lines by ``weight``.

    Shares are rounded to cents and the last line of each order takes the
    remainder, so they add up to the header exactly.  The remainder is worked
    out per order on (order, weight, count) rows: a huge order shrinks in the
    partial aggregates and no task sorts it whole.  The lines are read twice,
    for the aggregate and for the final join, which AQE may split by skew.
    """

    def share(c: str) -> Column:
        """amount · weight / total in whole cents, half up, exactly."""
        exact = F.expr(f"(2 * cast({c} * 100 as bigint) * cast({weight} * 100 as bigint) + _total) div nullif(2 * _total, 0)")
        return F.coalesce(exact, F.lit(0).cast("bigint"))

    freq = lines.groupBy(order, weight).agg(F.count(F.lit(1)).alias("_n"), F.max(item).alias("_last"))
    totals = freq.groupBy(order).agg(F.sum((F.col(weight) * 100).cast("bigint") * F.col("_n")).alias("_total"), F.max("_last").alias("_last"))
    heads = totals.join(headers.select(order, *amounts), order)
    rest = freq.drop("_last").join(heads, order).groupBy(order).agg(
        F.max("_total").alias("_total"), F.max("_last").alias("_last"), *[F.max(c).alias(c) for c in amounts],
        *[((F.max(c) * 100).cast("bigint") - F.sum(share(c) * F.col("_n"))).alias(f"_{c}_rest") for c in amounts],
    )
    is_last = F.col(item) == F.col("_last")
    cents = lambda c: share(c) + F.when(is_last, F.col(f"_{c}_rest")).otherwise(F.lit(0).cast("bigint"))
    return lines.join(rest, order).select(*lines.columns, *[money(cents(c) / F.lit(100)).alias(f"{c}_share") for c in amounts])


def union_exchange(returned: DataFrame, substitutes: DataFrame, headers: DataFrame, on: list[str]) -> DataFrame:
    """Return fact: returned items (no substitute) and substitute items
    (returned id unknown = -1), each with its exchange header."""
    a = returned.select(
        *on, F.col("product_id").alias("returned_id"), F.lit(None).cast("bigint").alias("substitute_id"),
        F.lit("RETURNED").alias("item_kind"), "qty", "gross", "is_defect",
    )
    b = substitutes.select(
        *on, F.lit(-1).cast("bigint").alias("returned_id"), F.col("product_id").alias("substitute_id"),
        F.lit("SUBSTITUTE").alias("item_kind"), "qty", "gross", F.lit(None).cast("boolean").alias("is_defect"),
    )
    return attach_header(a.unionByName(b), headers, on)


def no_pii(df: DataFrame, allowed: list[str], code: str | None = None, salt: str = "") -> DataFrame:
    """Allow-list projection; ``code`` is replaced by its SHA-256 digest."""
    cols: list[Column] = [F.col(c) for c in allowed]
    if code:
        cols.append(F.sha2(F.concat(F.lit(salt), F.col(code).cast("string")), 256).alias(f"{code}_hash"))
    return df.select(*cols)
