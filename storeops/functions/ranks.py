"""Row numbers inside groups of any size: no task has to sort a whole hot group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeops.session import materialize

SPLIT_ROWS = 5_000  # rows one task sorts of a group, as far as the sample can tell
SAMPLE_ROWS = 100_000  # sampled order keys of the whole table
LEAST_SAMPLES = 20  # sampled keys a split stands for, at least
FINE = 32  # cuts below one coarse cut; a group has at most FINE * FINE splits


def _same(names: list[str], left: str, right: str) -> Column:
    """Null-safe equality of columns in the tables aliased ``left`` and ``right``; true without columns."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in names], F.lit(True))


def _cuts(rows: DataFrame, by: list[str], total: int, split_rows: int) -> DataFrame:
    """by, _cuts, _every: sorted order keys that part each group of more than ``split_rows`` rows, and every FINE-th of them.

    Stored, since a sample drawn again after a lost executor could differ.  At most SAMPLE_ROWS / LEAST_SAMPLES groups
    are large enough for a row, and they hold as many cuts together.
    """
    fraction = min(1.0, SAMPLE_ROWS / total)
    sample = rows.select(*by, "_key").sample(fraction, 7) if fraction < 1 else rows.select(*by, "_key")
    least = max(2 * LEAST_SAMPLES, split_rows * fraction)
    big = sample.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.collect_list("_key").alias("_keys")).where(F.col("_n") >= least)
    parts = F.least(F.ceil(F.col("_n") / max(LEAST_SAMPLES, split_rows * fraction)), F.lit(FINE * FINE)).cast("int")
    sorted_keys = big.select(*by, "_n", parts.alias("_parts"), F.array_sort("_keys").alias("_keys")).where("_parts > 1")
    picked = F.expr("array_distinct(transform(sequence(1, _parts - 1), i -> _keys[cast(i * _n div _parts as int)]))")
    every = F.expr(f"filter(_cuts, (x, i) -> i % {FINE} = {FINE - 1})")
    cuts = sorted_keys.select(*by, picked.alias("_cuts")).withColumn("_every", every)
    return materialize(rows.sparkSession, cuts, "cuts")


def ranked(df: DataFrame, by: list[str], order: list[Column], name: str, split_rows: int | None = None) -> DataFrame:
    """``df`` with row numbers ``name`` (from 1) inside each ``by`` (nulls are one group; no columns: one group of all).

    Rows are ordered by the ascending ``order`` columns, nulls first.  Groups that a sample shows to be large are cut into
    ranges of the order key; each range is sorted by its own task and shifted by the rows in the ranges before it.  Small
    groups are one range.  ``df`` is read up to four times and must give the same rows each time; rows that agree in the
    whole order key share a range, so end ``order`` with a stored row id where one key may hold very many rows.
    """
    split_rows = split_rows or SPLIT_ROWS
    total = df.count()
    rows = df.withColumn("_key", F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)]))
    kept = df.columns
    # sorted by the columns themselves: the key, which repeats them, does not move with the rows
    whole = Window.partitionBy(*by).orderBy(*order)
    if total <= split_rows:
        return df.withColumn(name, F.row_number().over(whole)).select(*kept, name)
    cuts = _cuts(rows, by, total, split_rows)
    if not cuts.head(1):
        return df.withColumn(name, F.row_number().over(whole)).select(*kept, name)
    # the position of a key among the cuts: first among every FINE-th of them, then among the FINE below
    key = F.col("_key")
    coarse = F.size(F.filter("_every", lambda x: x <= key))  # picked once a group: a row compares 2 * FINE keys, not all cuts
    fine = F.size(F.filter(F.slice("_cuts", F.col("_coarse") * FINE + 1, F.lit(FINE)), lambda x: x <= key))
    if by:
        found = rows.alias("r").join(F.broadcast(cuts).alias("c"), _same(by, "r", "c"), "left").select("r.*", "_cuts", "_every")  # at most SAMPLE_ROWS / LEAST_SAMPLES rows
    else:
        found = rows.withColumn("_cuts", cuts.select("_cuts").scalar()).withColumn("_every", cuts.select("_every").scalar())
    placed = found.withColumn("_coarse", F.when(F.col("_cuts").isNotNull(), coarse))
    placed = placed.withColumn("_split", F.when(F.col("_coarse").isNotNull(), F.col("_coarse") * FINE + fine).otherwise(0)).drop("_cuts", "_every", "_key")
    sizes = placed.where("_coarse is not null").groupBy(*by, "_split").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)  # at most FINE * FINE rows
    offsets = sizes.select(*by, "_split", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = placed.withColumn("_at", F.row_number().over(Window.partitionBy(*by, "_split").orderBy(*order)))
    joined = numbered.alias("r").join(F.broadcast(offsets).alias("o"), _same([*by, "_split"], "r", "o"), "left")  # one row per cut
    return joined.select(*[F.col(f"r.{c}") for c in kept], (F.col("_at") + F.coalesce("_before", F.lit(0))).alias(name))
