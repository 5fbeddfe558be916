"""Dimension builders and key lookup."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeops.functions.columns import date_key, month_key
from storeops.functions.numbering import dense_ids
from storeops.operators.holidays import holiday_calendar

UNKNOWN_ID = -1
UNKNOWN_DATE_ID = 19000101


def calendar(span: DataFrame) -> DataFrame:
    """Every day between ``first_day`` and ``last_day`` of a one-row span."""
    return span.select(F.explode(F.sequence("first_day", "last_day")).alias("day"))


def dim_date(span: DataFrame) -> DataFrame:
    """Date dimension with weekday (1 = Sunday), ISO week and federal holidays."""
    day = F.col("day")
    days = calendar(span)
    holidays = holiday_calendar(span).where(F.col("kind") == "FEDERAL").select("day", F.lit(True).alias("h")).distinct()
    iso_year = F.extract(F.lit("YEAROFWEEK"), day)
    return days.join(F.broadcast(holidays), "day", "left").select(
        date_key(day).alias("date_id"),
        "day",
        F.dayofweek(day).alias("weekday"),
        F.date_format(day, "EEEE").alias("weekday_name"),
        F.dayofmonth(day).alias("day_of_month"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.year(day).alias("year"),
        month_key(day).alias("year_month"),
        F.weekofyear(day).alias("week"),
        (iso_year * 100 + F.weekofyear(day)).cast("int").alias("year_week"),
        F.coalesce("h", F.lit(False)).alias("is_holiday"),
    )


def with_unknown(dim: DataFrame, values: dict[str, object]) -> DataFrame:
    """Dimension plus its unknown member; columns not given are NULL."""
    row = dim.sparkSession.range(1).select(
        *[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in dim.schema.fields]
    )
    return dim.unionByName(row)


@dataclass(frozen=True)
class Lookup:
    """Attribute table: ``code`` of the product side → ``label``."""

    table: DataFrame
    code: str
    label: str


def build_products(models: DataFrame, variants: DataFrame, lookups: list[Lookup]) -> DataFrame:
    """Model ⋈ variant with every attribute code replaced by its label.

    Lookups carry (code, label); Spark broadcasts each one whose measured size
    is below the threshold and shuffles the rest.
    """
    out = models.join(variants, "article_code")
    for lk in lookups:
        table = lk.table.select(F.col("code").alias(lk.code), F.col("label").alias(lk.label))
        out = out.join(table, lk.code, "left").drop(lk.code)
    return out


def scd_hash(cols: list[str]) -> Column:
    """Change hash; the separator keeps 'ab'+'c' apart from 'a'+'bc'."""
    return F.md5(F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]))


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """Distinct dimension rows with exactly one row per business key: the
    smallest row wins, so the choice does not depend on input order."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min(F.struct(*rest)).alias("r")).select(key, "r.*")


def distinct_members(rows: DataFrame, code: str) -> DataFrame:
    """Dimension members as a source delivers them, repeated or without code: one row per code that is given."""
    return one_per_key(rows.where(F.col(code).isNotNull() & (F.trim(code) != "")), code)


def current(dim: DataFrame, statuses: list[str] | None = None, categories: list[str] | None = None) -> DataFrame:
    """Open versions of a slowly changing dimension, optionally filtered."""
    out = dim.where(F.col("valid_to").isNull()) if "valid_to" in dim.columns else dim
    if statuses:
        out = out.where(F.col("status").isin(statuses))
    if categories:
        out = out.where(F.col("category").isin(categories))
    return out


def lookup(fact: DataFrame, dim: DataFrame, on: list[str], key: str, default: int | None = UNKNOWN_ID) -> DataFrame:
    """Adds the surrogate ``key`` of ``dim``; misses get ``default``."""
    keyed = fact.join(dim.select(*on, key), on, "left")
    return keyed if default is None else keyed.withColumn(key, F.coalesce(F.col(key), F.lit(default)))


def assign_keys(current_dim: DataFrame | None, incoming: DataFrame, bk: list[str], key: str) -> DataFrame:
    """Keeps known surrogate keys and numbers new business keys after the
    highest existing one."""
    if current_dim is None:
        return dense_ids(incoming, bk, key)
    known = incoming.join(current_dim.select(*bk, key), bk, "inner")
    fresh = incoming.join(current_dim.select(*bk), bk, "left_anti")
    highest = current_dim.select(F.coalesce(F.max(key), F.lit(0)).alias("v")).scalar()
    return known.unionByName(dense_ids(fresh, bk, key, highest))
