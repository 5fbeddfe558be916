"""Exact quantiles per group by histogram refinement: no task holds the values of a group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeops.session import materialize

BINS = 1024  # bins of one round; three rounds reach any value below 2^30 above the least


def _same(names: list[str]) -> Column:
    """Null-safe equality of the group columns of tables ``r`` and ``s``."""
    return reduce(lambda a, b: a & b, [F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}")) for c in names], F.lit(True))


def group_quantiles(df: DataFrame, by: list[str], value: Column, probabilities: dict[str, float], weight: Column | None = None, bins: int = BINS) -> DataFrame:
    """by, the named quantiles of a whole-number ``value`` (interpolated, as ``percentile_cont``), in doubles.

    ``weight`` is the number of times a row counts (once, without it).  Null values and weights below one do not count; a
    group without values has no row.  Equal values are counted first.  Each round counts the values in the ranges that hold
    the wanted ranks, ``bins`` bins a range, and narrows them until a range is one value; the ranges are few per group, the
    counts at most ``bins`` rows each, whatever the size of the group.  Rounds grow with the logarithm of the widest range.
    """
    counted = df.select(*by, value.cast("bigint").alias("_v"), (F.lit(1) if weight is None else weight).cast("bigint").alias("_w"))
    freq = counted.where(F.col("_v").isNotNull() & (F.col("_w") > 0)).groupBy(*by, "_v").agg(F.sum("_w").alias("_f"))
    freq = materialize(df.sparkSession, freq, "value-counts")
    groups = freq.groupBy(*by).agg(F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.sum("_f").alias("_n"))
    # the two ranks around each quantile, from 0
    at = {name: (F.col("_n") - 1) * F.lit(float(p)) for name, p in probabilities.items()}
    wanted = F.array(*[
        F.struct(F.lit(name).alias("_name"), F.lit(side).alias("_side"), of(at[name]).cast("bigint").alias("_need"), (at[name] - F.floor(at[name])).alias("_part"))
        for name in probabilities for side, of in (("lo", F.floor), ("hi", F.ceil))
    ])
    span = groups.agg(F.max(F.col("_high").cast("decimal(20,0)") - F.col("_low") + 1)).first()[0]
    state = groups.select(*by, "_low", F.inline(wanted))
    key = [*by, "_name", "_side", "_part"]
    width = int(span or 1)
    while width > 1:
        step = -(-width // bins)
        above = F.col("_v") - F.col("_low")
        held = freq.alias("r").join(state.alias("s"), _same(by)).where((F.col("_v") >= F.col("_low")) & (above < width) & (above >= 0))
        bin_of = F.call_function("div", above, F.lit(step).cast("bigint")).alias("_bin")
        counts = held.groupBy(*[F.col(f"s.{c}").alias(c) for c in by], "_name", "_side", "_part", "_low", "_need", bin_of).agg(F.sum("_f").alias("_f"))
        upto = F.sum("_f").over(Window.partitionBy(*key).orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0))  # at most ``bins`` rows
        found = counts.withColumn("_upto", upto).where((F.col("_upto") > F.col("_need")) & (F.col("_upto") - F.col("_f") <= F.col("_need")))
        state = found.select(*key, (F.col("_low") + F.col("_bin") * F.lit(step).cast("bigint")).alias("_low"), (F.col("_need") - F.col("_upto") + F.col("_f")).alias("_need"))
        width = step
    pick = lambda name, side: F.max(F.when((F.col("_name") == name) & (F.col("_side") == side), F.col("_low")))
    part = lambda name: F.max(F.when(F.col("_name") == name, F.col("_part")))
    between = lambda name: pick(name, "lo") + (pick(name, "hi") - pick(name, "lo")) * part(name)
    return state.groupBy(*by).agg(*[between(name).cast("double").alias(name) for name in probabilities])
