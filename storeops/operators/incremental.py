"""Incremental loads without MERGE."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeops.session import materialize


def replace_partitions(df: DataFrame, path: str, column: str) -> None:
    """Replaces exactly the partitions present in ``df``; repeating the call
    leaves the same table (dynamic partition overwrite)."""
    (
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(column).parquet(path)
    )


def replace_days(df: DataFrame, path: str, day: str, partition: str) -> None:
    """Replaces exactly the days present in ``df`` in a table partitioned by the
    coarser ``partition``; the other days of those partitions stay, and
    repeating the call leaves the same table.

    The partitions met are stored in full before they are overwritten.
    """
    spark = df.sparkSession
    incoming = materialize(spark, df, "incoming-days")
    existing = spark.read.parquet(path).join(F.broadcast(incoming.select(partition).distinct()), partition, "left_semi")  # one row per partition
    whole = existing.join(incoming.select(day).distinct(), day, "left_anti").unionByName(incoming)
    replace_partitions(materialize(spark, whole, "replaced-days"), path, partition)


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows replace existing rows with the same key."""
    return existing.join(incoming.select(*keys), keys, "left_anti").unionByName(incoming)


def above_mark(incoming: DataFrame, loaded: DataFrame, key: str) -> DataFrame:
    """Rows newer than the highest loaded key (all rows when none is loaded)."""
    mark = loaded.select(F.max(key).alias("v")).scalar()
    return incoming.where((F.col(key) > mark) | mark.isNull())
