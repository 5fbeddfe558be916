"""Small helpers shared by the text operators."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storeops.session import materialize, work_path

# A word is a run of characters other than space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def whole(text: str | Column = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def store(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate once to the shared folder and read it back."""
    return materialize(df.sparkSession, df, name)


def store_small(df: DataFrame, name: str) -> DataFrame:
    """As ``store``, for wide intermediates of text: a stronger codec, as these files count as disk."""
    path = work_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
