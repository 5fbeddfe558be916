"""Physical layout of stored tables, chosen per table.

A table is cut into periods of its day (one folder per year, quarter or month), dealt to buckets by the hash of a column, or
both.  Files are balanced by size: the rows of a period and bucket come together, AQE cuts large ones into several writers
and puts small ones together.  Tables that share bucket column and number join and group on it without an exchange.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 20_000_000  # rows one task reads of a bucket; also the most rows a single key may have in a bucketed table


@dataclass(frozen=True)
class Layout:
    """``period`` (year, quarter or month) of the date column ``day``; ``hash_by`` dealt to at least ``least_buckets``."""

    period: str | None = None
    day: str | None = None
    hash_by: str | None = None
    least_buckets: int = 8

    @property
    def folder(self) -> str | None:
        """Name of the partition column."""
        return self.period and f"part_{self.period}"


# How each gold table is cut.
LAYOUTS = {
    "dim_product": Layout(hash_by="article", least_buckets=8),
    "dim_date": Layout("year", "day"),
    "fact_sales": Layout("month", "sale_date"),
    "fact_inventory": Layout("quarter", "move_date"),
    "fact_store_inventory": Layout("quarter", "move_date"),
    "fact_purchases": Layout("quarter", "order_date"),
    "fact_returns": Layout("quarter", "exchange_date"),
}


def period_of(period: str, day: str | Column) -> Column:
    """1997, 19972 (second quarter) or 199705 (May); null without a day."""
    day = F.col(day) if isinstance(day, str) else day
    return {"year": F.year(day), "quarter": F.year(day) * 10 + F.quarter(day), "month": F.year(day) * 100 + F.month(day)}[period]


def with_period(df: DataFrame, layout: Layout) -> DataFrame:
    return df.withColumn(layout.folder, period_of(layout.period, layout.day)) if layout.period else df


def between(df: DataFrame, layout: Layout, first: str, last: str) -> DataFrame:
    """Rows of the days ``first`` to ``last``; only folders of their periods are read."""
    bounds = [period_of(layout.period, F.lit(d).cast("date")) for d in (first, last)]
    return df.where(F.col(layout.folder).between(*bounds) & F.col(layout.day).between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def bucket_count(df: DataFrame, layout: Layout, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """Buckets for the rows of ``df``: ``least_buckets`` times a power of two, so that a bucket has at most about
    ``rows_per_bucket`` rows.  0 where one key alone has more: a bucket is read by one task, so such a table is better
    joined by a shuffle, in which AQE splits the key."""
    keys = df.groupBy(layout.hash_by).agg(F.count(F.lit(1)).alias("n"))
    rows, largest = keys.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).head()
    if largest > rows_per_bucket:
        return 0
    buckets = layout.least_buckets
    while buckets * rows_per_bucket < rows:
        buckets *= 2
    return buckets


def save(df: DataFrame, name: str, folder: str, layout: Layout, buckets: int | None = None) -> str:
    """Stores ``df`` below ``folder`` as a catalog table of its own, ``name`` with a suffix that no other run has; returns
    the table's name.  ``buckets`` None: ``bucket_count``; give tables that are to be joined the larger of their counts.

    Rows without a day lie in the folder of null.  An empty table has the schema only.
    """
    if layout.hash_by and buckets is None:
        buckets = bucket_count(df, layout)
    table = f"{name}_{uuid.uuid4().hex}"
    rows = with_period(df, layout)
    together = [layout.folder] if layout.period else []
    if buckets:
        rows = rows.withColumn("_bucket", F.pmod(F.hash(layout.hash_by), F.lit(buckets)))
        together.append("_bucket")
    if together:
        rows = rows.hint("rebalance", *together).drop("_bucket")
    writer = rows.write.option("path", os.path.join(folder, table))
    if layout.period:
        writer = writer.partitionBy(layout.folder)
    if buckets:
        writer = writer.bucketBy(buckets, layout.hash_by).sortBy(layout.hash_by)
    writer.saveAsTable(table)
    return table


def save_alike(tables: dict[str, tuple[DataFrame, Layout]], folder: str) -> dict[str, str]:
    """Stores tables that join on their ``hash_by`` with the same number of buckets; returns their catalog names.
    Where one of them has a key too large for a bucket, none is bucketed."""
    counts = [bucket_count(df, layout) for df, layout in tables.values()]
    buckets = max(counts) if all(counts) else 0
    return {name: save(df, name, folder, layout, buckets) for name, (df, layout) in tables.items()}


def drop(spark: SparkSession, table: str) -> None:
    """Forgets a stored table; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
