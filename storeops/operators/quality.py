"""Data-quality checks.  Every check is a DataFrame; nothing is collected
until ``enforce``."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeops.functions.columns import big, count_big, count_where, date_key, dbl, percent

BLOCK, WARN = "BLOCK", "WARN"


def verdict(ok: Column, bad: str = "FAIL") -> Column:
    return F.when(ok, "PASS").otherwise(bad)


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def check_unique(name: str, df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows, distinct keys and PASS/FAIL.  Keys are counted by grouping, so a
    repeated key collapses before the shuffle."""
    keys = df.groupBy(*cols).agg(count_big().alias("n"))
    return keys.agg(
        big(F.coalesce(F.sum("n"), F.lit(0))).alias("total_rows"), count_big().alias("distinct_keys")
    ).select(
        F.lit(name).alias("check_name"), "total_rows", "distinct_keys",
        verdict(F.col("total_rows") == F.col("distinct_keys")).alias("status"),
    )


def duplicate_keys(name: str, df: DataFrame, cols: list[str]) -> DataFrame:
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in cols])
    return df.groupBy(*cols).agg(count_big().alias("occurrences")).where(F.col("occurrences") > 1).select(
        F.lit(name).alias("table_name"), key.alias("key_value"), "occurrences"
    )


@dataclass(frozen=True)
class Reference:
    """Foreign key column → key column of a dimension."""

    column: str
    target: str
    dim: DataFrame
    key: str
    nullable: bool = False


def _key_usage(fact: DataFrame, refs: list[Reference]) -> DataFrame:
    """(column, value, rows) for all foreign keys from one pass over the fact;
    partial counts shrink a hot key to one row per task."""
    pairs = F.array(*[
        F.struct(F.lit(r.column).alias("fk_column"), F.col(r.column).cast("bigint").alias("fk_value")) for r in refs
    ])
    return fact.select(F.inline(pairs)).groupBy("fk_column", "fk_value").agg(count_big().alias("n"))


def _known_keys(refs: list[Reference]) -> DataFrame:
    return union_all([
        r.dim.select(F.lit(r.column).alias("fk_column"), F.col(r.key).cast("bigint").alias("fk_value")).distinct()
        for r in refs
    ]).withColumn("known", F.lit(True))


def fk_report(fact_name: str, fact: DataFrame, refs: list[Reference]) -> DataFrame:
    """Rows, distinct values, nulls, orphans and status of each foreign key."""
    usage = _key_usage(fact, refs).join(_known_keys(refs), ["fk_column", "fk_value"], "left")
    orphan = F.col("known").isNull()
    labels = F.create_map(*[x for r in refs for x in (F.lit(r.column), F.lit(f"{fact_name}.{r.column} -> {r.target}"))])
    nullable = [r.column for r in refs if r.nullable]
    optional = F.col("fk_column").isin(nullable) if nullable else F.lit(False)
    null_value = F.col("fk_value").isNull()
    bad = orphan & ~(optional & null_value)
    return usage.groupBy("fk_column").agg(
        big(F.sum("n")).alias("fact_rows"),
        count_where(~null_value).alias("distinct_values"),
        big(F.coalesce(F.sum(F.when(null_value, F.col("n"))), F.lit(0))).alias("null_rows"),
        big(F.coalesce(F.sum(F.when(bad, F.col("n"))), F.lit(0))).alias("orphans"),
    ).select(
        labels[F.col("fk_column")].alias("check_name"), "fact_rows", "distinct_values", "null_rows", "orphans",
        verdict(F.col("orphans") == 0).alias("status"),
    )


def orphan_values(fact_name: str, fact: DataFrame, refs: list[Reference]) -> DataFrame:
    """Values without a dimension row and how often they occur."""
    usage = _key_usage(fact, refs).where(F.col("fk_value").isNotNull())
    return usage.join(_known_keys(refs), ["fk_column", "fk_value"], "left_anti").select(
        F.lit(fact_name).alias("fact"), "fk_column", "fk_value", F.col("n").alias("occurrences")
    )


def orphan_rows(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    return fact.join(dim.select(key), key, "left_anti")


def null_profile(name: str, df: DataFrame, cols: list[str], warn_above: float = 30.0) -> DataFrame:
    """Null count, percentage and WARN flag per column, in one pass."""
    one = df.agg(count_big().alias("total_rows"), *[count_where(F.col(c).isNull()).alias(f"n_{c}") for c in cols])
    rows = F.array(*[F.struct(F.lit(f"{name}.{c}").alias("check_name"), F.col("total_rows"), F.col(f"n_{c}").alias("null_count")) for c in cols])
    out = one.select(F.inline(rows)).withColumn("null_pct", percent(F.col("null_count"), F.col("total_rows")))
    return out.withColumn("status", F.when(F.col("null_pct") > warn_above, WARN).otherwise("PASS"))


def date_range(name: str, df: DataFrame, day: str) -> DataFrame:
    return df.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), count_big().alias("days")).select(
        F.lit(name).alias("table_name"), "first_day", "last_day", "days"
    )


def dates_outside(name: str, fact: DataFrame, day: str, dates: DataFrame) -> DataFrame:
    """Fact dates before or after the calendar, and dates it does not hold.

    Built on the fact's own date with a left join, so a date missing from the
    calendar is seen; rows are counted per day first.
    """
    per_day = fact.groupBy(F.col(day).alias("day")).agg(count_big().alias("n"))
    first = dates.select(F.min("day").alias("v")).scalar()
    last = dates.select(F.max("day").alias("v")).scalar()
    known = dates.select("day", F.lit(True).alias("known"))
    d = F.col("day")
    rows = lambda cond: big(F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)))
    return per_day.join(known, "day", "left").withColumn("lo", first).withColumn("hi", last).agg(
        F.min(d).alias("first_day"), F.max(d).alias("last_day"), big(F.sum("n")).alias("total_rows"),
        rows(d < F.col("lo")).alias("before_calendar"), rows(d > F.col("hi")).alias("after_calendar"),
        rows(F.col("known").isNull()).alias("not_in_calendar"),
    ).select(F.lit(name).alias("table_name"), "*")


def unused_members(name: str, dim: DataFrame, key: str, used: list[DataFrame]) -> DataFrame:
    """Dimension members that no fact refers to; ``used`` holds one-column frames."""
    keys = union_all([u.toDF(key).distinct() for u in used])
    return dim.select(key).join(keys, key, "left_anti").agg(count_big().alias("unused_count")).select(
        F.lit(name).alias("check_name"), "unused_count"
    )


def share_check(name: str, df: DataFrame, cond: Column, limit_pct: float) -> DataFrame:
    """Share of rows meeting ``cond``; WARN above the limit."""
    return df.agg(count_big().alias("total_rows"), count_where(cond).alias("bad_rows")).select(
        F.lit(name).alias("check_name"), "total_rows", "bad_rows",
        percent(F.col("bad_rows"), F.col("total_rows"), 4).alias("bad_pct"),
    ).withColumn("status", F.when(F.col("bad_pct") > limit_pct, WARN).otherwise("PASS"))


def future_rows(fact: DataFrame, day: str, today: str) -> DataFrame:
    return fact.where(F.col(day) > F.lit(today).cast("date"))


def missing_columns(name: str, df: DataFrame, expected: T.StructType) -> DataFrame:
    """Expected columns that are absent or have another type, with row count."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    missing = sorted(f.name for f in expected.fields if actual.get(f.name) != f.dataType)
    return df.agg(count_big().alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count", F.lit(len(expected.fields)).alias("expected_columns"),
        F.lit(", ".join(missing)).alias("missing"), F.lit("PASS" if not missing else BLOCK).alias("status"),
    )


def row_count_trend(df: DataFrame, day: str, window: int = 7, limit: float = 0.5) -> DataFrame:
    """Rows per load day against the mean of the previous loads."""
    per_day = df.groupBy(F.col(day).alias("day")).agg(count_big().alias("row_count"))
    # one row per load day: the ordered window is bounded by the calendar
    before = Window.orderBy("day").rowsBetween(-window, -1)
    mean = F.avg(dbl(F.col("row_count"))).over(before)
    change = F.abs(F.col("row_count") - mean) / mean
    return per_day.select(
        "day", "row_count", F.round(mean, 4).alias("previous_mean"),
        F.when(change > limit, WARN).otherwise("PASS").alias("status"),
    )


def without_header(items: DataFrame, headers: DataFrame, on: list[str]) -> DataFrame:
    return items.join(headers.select(*on), on, "left_anti")


def placeholder_dates(name: str, fact: DataFrame, day: str, placeholder: Column) -> DataFrame:
    return fact.agg(count_big().alias("total_rows"), count_where(F.col(day) == placeholder).alias("placeholder_rows")).select(
        F.lit(name).alias("check_name"), "total_rows", "placeholder_rows"
    )


def reconcile(left: DataFrame, right: DataFrame, keys: list[str], value: str, ok: float, alert: float) -> DataFrame:
    """Two totals per group: OK within ``ok`` percent, ALERT within ``alert``,
    CRITICAL beyond or when one side lacks the group."""
    a = left.groupBy(*keys).agg(dbl(F.sum(value)).alias("left_value"))
    b = right.groupBy(*keys).agg(dbl(F.sum(value)).alias("right_value"))
    diff = F.abs(F.col("left_value") - F.col("right_value")) * 100.0 / F.nullif(F.abs("left_value"), F.lit(0.0))
    both = F.col("left_value").isNotNull() & F.col("right_value").isNotNull()
    level = F.when(~both, "CRITICAL").when(F.col("left_value") == F.col("right_value"), "OK").when(diff <= ok, "OK").when(diff <= alert, "ALERT").otherwise("CRITICAL")
    return a.join(b, keys, "full").select(*keys, "left_value", "right_value", F.round(diff, 4).alias("diff_pct"), level.alias("status"))


def reconcile_levels(left: DataFrame, right: DataFrame, keys: list[str], value: str, total_pct: float = 0.5, group_pct: float = 1.0) -> DataFrame:
    """Totals of two sources on two levels: the whole within ``total_pct`` percent, each group within ``group_pct``.

    Within its tolerance a level is OK, up to twice that ALERT, beyond or with one side missing CRITICAL.  Both levels come
    from one grouping a side; group rows are few when the totals are added up from them.
    """
    side = lambda df, name: df.rollup(*keys).agg(F.sum(value).cast("double").alias(name), F.grouping_id().cast("int").alias("_level")).where(
        F.col("_level").isin(0, 2 ** len(keys) - 1))
    a, b = side(left, "left_value").alias("a"), side(right, "right_value").alias("b")
    same = F.col("a._level") == F.col("b._level")
    for k in keys:
        same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    diff = F.abs(F.col("left_value") - F.col("right_value")) * 100.0 / F.nullif(F.abs("left_value"), F.lit(0.0))
    whole = F.coalesce("a._level", "b._level") > 0
    limit = F.when(whole, total_pct).otherwise(group_pct)
    both = F.col("left_value").isNotNull() & F.col("right_value").isNotNull()
    status = F.when(~both, "CRITICAL").when((F.col("left_value") == F.col("right_value")) | (diff <= limit), "OK").when(diff <= 2 * limit, "ALERT").otherwise("CRITICAL")
    return a.join(b, same, "full").select(
        F.when(whole, "TOTAL").otherwise("GROUP").alias("level"), *[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in keys],
        "left_value", "right_value", F.round(diff, 4).alias("diff_pct"), limit.alias("tolerance_pct"), status.alias("status"),
    )


def suite_row(name: str, severity: str, df: DataFrame, value: Column, threshold: float, fail_when: Column) -> DataFrame:
    """One check in report form: check, severity, value, threshold, status."""
    return df.agg(dbl(value).alias("value")).select(
        F.lit(name).alias("check_name"), F.lit(severity).alias("severity"), "value", F.lit(float(threshold)).alias("threshold"),
        F.when(fail_when, severity).otherwise("PASS").alias("status"),
    )


def run_suite(checks: list[DataFrame]) -> DataFrame:
    return union_all(checks)


class QualityError(RuntimeError):
    """A BLOCK check failed."""


def enforce(report: DataFrame) -> DataFrame:
    """Raises when a BLOCK check failed; the report has one row per check."""
    failed = [r["check_name"] for r in report.where(F.col("status") == BLOCK).select("check_name").collect()]
    if failed:
        raise QualityError(", ".join(failed))
    return report


