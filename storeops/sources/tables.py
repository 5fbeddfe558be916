"""Readers and writers."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeops.session import shuffles_dropped


def read_source(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Source table by name: Parquet below ``path``."""
    return spark.read.parquet(os.path.join(path, f"{name}.parquet"))


def read_relational(
    spark: SparkSession, url: str, table: str, *, split_on: str | None = None,
    bounds: tuple[int, int] | None = None, parts: int = 1, env: dict[str, str] | None = None,
) -> DataFrame:
    """Relational source over JDBC, credentials from the environment.

    ``split_on`` with ``bounds`` and ``parts`` reads in parallel ranges; Spark
    pushes filters and pruned columns into each range query.
    """
    env = os.environ if env is None else env
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for option, variable in (("user", "SOURCE_DB_USER"), ("password", "SOURCE_DB_PASSWORD"), ("driver", "SOURCE_DB_DRIVER")):
        if env.get(variable):
            reader = reader.option(option, env[variable])
    if split_on and bounds:
        reader = (
            reader.option("partitionColumn", split_on).option("lowerBound", bounds[0])
            .option("upperBound", bounds[1]).option("numPartitions", parts)
        )
    return reader.option("fetchsize", 10_000).load()


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read.option("header", True)
    return reader.csv(path, schema=schema) if schema is not None else reader.csv(path, inferSchema=True)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str, compression: str = "none") -> None:
    with shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").option("compression", compression).json(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Parquet table, partitioned on low-cardinality columns.

    The rows of a partition value come together, and the rebalance hint lets AQE cut values above the advisory size into as
    many writers as they need, so neither the file count nor a hot month's share of one task grows without bound.
    """
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def flatten(df: DataFrame, array: str, keep: list[str], fields: list[str]) -> DataFrame:
    """Nested document to rows: one row per array element."""
    return df.select(*keep, F.explode(array).alias("e")).select(*keep, *[F.col(f"e.{f}").alias(f) for f in fields])


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of every table in one result."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
