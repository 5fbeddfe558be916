"""Typing of raw TEXT columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts that mean "true" in the source system.
TRUE_TEXTS = ("S", "1", "TRUE", "true", "t")


def blank_to_null(col: Column) -> Column:
    return F.nullif(F.trim(col), F.lit(""))


def to_int(col: Column) -> Column:
    return blank_to_null(col).try_cast("int")


def to_key(col: Column) -> Column:
    """Key columns are wide: a source code may exceed 32 bits."""
    return blank_to_null(col).try_cast("bigint")


def to_money(col: Column) -> Column:
    return blank_to_null(col).try_cast("decimal(12,2)")


def to_date(col: Column) -> Column:
    """Date part of 'YYYY-MM-DD hh:mm:ss' (or of a bare date)."""
    return F.split_part(blank_to_null(col), F.lit(" "), F.lit(1)).try_cast("date")


def to_date_key(col: Column) -> Column:
    return F.date_format(to_date(col), "yyyyMMdd").cast("int")


def to_flag(col: Column) -> Column:
    """Flag text to boolean; NULL counts as false."""
    return F.coalesce(col.isin(*TRUE_TEXTS), F.lit(False))


def zero_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(0))


_CASTS = {"int": to_int, "key": to_key, "money": to_money, "date": to_date, "date_key": to_date_key, "flag": to_flag}


def typed(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """Typed projection of a TEXT table.

    ``spec`` maps column name to int, key, money, date, date_key, flag or text;
    columns outside the spec are dropped.
    """
    return df.select(
        *[(F.col(n) if kind == "text" else _CASTS[kind](F.col(n))).alias(n) for n, kind in spec.items()]
    )


def rejects(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """Per column: blanks and values that cannot be cast, in one pass."""
    checked = [n for n, kind in spec.items() if kind in ("int", "key", "money", "date")]
    aggs = []
    for n in checked:
        raw = blank_to_null(F.col(n))
        aggs.append(F.count_if(raw.isNull()).alias(f"{n}__blank"))
        aggs.append(F.count_if(raw.isNotNull() & _CASTS[spec[n]](F.col(n)).isNull()).alias(f"{n}__bad"))
    one = df.agg(F.count(F.lit(1)).alias("total_rows"), *aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("column_name"),
                F.col("total_rows"),
                F.col(f"{n}__blank").alias("blank_rows"),
                F.col(f"{n}__bad").alias("rejected_rows"),
            )
            for n in checked
        ]
    )
    return one.select(F.inline(rows))
