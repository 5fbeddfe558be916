"""Slowly changing dimension, type 2.  ``valid_to`` is the last valid day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeops.operators.dims import UNKNOWN_ID, assign_keys, scd_hash


def initial_load(rows: DataFrame, start: Column, attrs: list[str]) -> DataFrame:
    return rows.select(
        "*", start.cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"), scd_hash(attrs).alias("change_hash"),
    )


def _last_of_day(marks: DataFrame, bk: list[str], order: list[str]) -> DataFrame:
    """One mark per key and day: the last by ``order``."""
    nxt = F.lead("valid_from").over(Window.partitionBy(*bk).orderBy("valid_from", *order))
    return marks.withColumn("_next", nxt).where(F.col("_next").isNull() | (F.col("_next") > F.col("valid_from"))).drop("_next", *order)


def _timeline(marks: DataFrame, bk: list[str]) -> DataFrame:
    """Versions from marks (one per key and day): a mark whose hash differs from the one before opens a version, which ends
    the day before the next one; a mark without hash means that the key is gone from that day on."""
    by_start = Window.partitionBy(*bk).orderBy("valid_from")
    hashed = F.coalesce("change_hash", F.lit(""))
    starts = marks.withColumn("_before", F.lag(hashed).over(by_start)).where(F.col("_before").isNull() | (F.col("_before") != hashed)).drop("_before")
    ended = starts.withColumn("valid_to", F.date_sub(F.lead("valid_from").over(by_start), 1)).withColumn("is_current", F.col("valid_to").isNull())
    return ended.where(F.col("change_hash").isNotNull())


def apply_changes(
    current: DataFrame, incoming: DataFrame, bk: list[str], attrs: list[str], as_of: date | str | Column,
    sequence: str | None = None, log: DataFrame | None = None,
) -> DataFrame:
    """``current`` with the changes spliced into each key's timeline.

    ``as_of`` is the day of the changes, or a column of ``incoming`` where each row has its own.  A change cuts the version
    that covers its day and lasts until the next later version, which stays; on the first day of a version it replaces it;
    equal neighbours become one version.  Of several rows of a key and day the one with the largest ``sequence`` counts, of
    equal ones the largest attributes.

    Versions do not tell on which days an unchanged row was seen again.  With ``log``, all rows received so far (bk, attrs,
    valid_from and, if used, the sequence), a late change also ends where the old state was seen next, and changes applied
    in any order give the same table as ``rebuild``.  One shuffle, by key.
    """
    seq = lambda c: (F.col(c) if c else F.lit(None)).cast("bigint").alias("_seq")
    fields = [*bk, *attrs, "valid_from", "change_hash"]
    day = as_of if isinstance(as_of, Column) else F.lit(as_of)
    new = incoming.select(*bk, *attrs, day.cast("date").alias("valid_from"), scd_hash(attrs).alias("change_hash"), F.lit(2).alias("_rank"), seq(sequence))
    first = current.select(*fields, F.lit(1).alias("_rank"), seq(None))
    types = {f.name: f.dataType for f in current.schema.fields}
    gone = current.where(F.col("valid_to").isNotNull()).select(
        *bk, *[F.lit(None).cast(types[c]).alias(c) for c in attrs], F.date_add("valid_to", 1).alias("valid_from"),
        F.lit(None).cast("string").alias("change_hash"), F.lit(0).alias("_rank"), seq(None),
    )
    marks = first.unionByName(gone).unionByName(new)
    if log is not None:  # received rows rank among themselves by sequence
        marks = marks.where("_rank = 0").unionByName(new.unionByName(log.select(*bk, *attrs, "valid_from", scd_hash(attrs).alias("change_hash"), F.lit(2).alias("_rank"), seq(sequence))))
    order = [f"_by{i}" for i in range(2 + len(attrs))]
    keyed = marks.withColumns(dict(zip(order, [F.col("_rank"), F.col("_seq"), *[F.col(c) for c in attrs]]))).drop("_rank", "_seq")
    return _timeline(_last_of_day(keyed, bk, order), bk).select(*bk, *attrs, "valid_from", "valid_to", "is_current", "change_hash")


def rebuild(history: DataFrame, bk: list[str], attrs: list[str], day: str, sequence: str | None = None) -> DataFrame:
    """Versions from the full change history; of several rows of a key and day the largest sequence, then the largest
    attributes count."""
    marks = history.select(*bk, *attrs, F.col(day).alias("valid_from"), scd_hash(attrs).alias("change_hash"), (F.col(sequence) if sequence else F.lit(None)).cast("bigint").alias("_seq"))
    order = [f"_by{i}" for i in range(1 + len(attrs))]
    keyed = marks.withColumns(dict(zip(order, [F.col("_seq"), *[F.col(c) for c in attrs]]))).drop("_seq")
    return _timeline(_last_of_day(keyed, bk, order), bk).select(*bk, *attrs, "valid_from", "valid_to", "is_current", "change_hash")


def with_version_keys(versions: DataFrame, given: DataFrame | None, bk: list[str], key: str) -> DataFrame:
    """Versions with a surrogate key of their own.

    ``given`` (bk, valid_from, key) holds every key ever handed out: a version keeps its key as long as it starts on the
    same day, however its end moves, and no key is used again.
    """
    return assign_keys(given, versions, [*bk, "valid_from"], key)


def lookup_as_of(fact: DataFrame, versions: DataFrame, bk: list[str], day: str, key: str, default: int = UNKNOWN_ID) -> DataFrame:
    """Adds the key of the version valid on each fact row's own day, ``default`` where there is none.

    Equality on the key with the period as residual: versions of a key do not overlap, so no row is doubled.
    """
    v = versions.select(*[F.col(c).alias(f"_{c}") for c in bk], F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"), key)
    on = [F.col(c) == F.col(f"_{c}") for c in bk] + [F.col(day) >= F.col("_from"), F.col("_to").isNull() | (F.col(day) <= F.col("_to"))]
    return fact.join(v, on, "left").select(*fact.columns, F.coalesce(key, F.lit(default)).alias(key))


def as_of(dim: DataFrame, day: date | str) -> DataFrame:
    """Versions valid on one day."""
    d = F.lit(day).cast("date")
    return dim.where((F.col("valid_from") <= d) & (F.col("valid_to").isNull() | (F.col("valid_to") >= d)))


def join_as_of(fact: DataFrame, dim: DataFrame, bk: list[str], day: str) -> DataFrame:
    """Fact rows with the version valid on their own day: equality on the key,
    range as residual.  Aggregate the fact per key and day first."""
    inside = (F.col(day) >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col(day) <= F.col("valid_to")))
    return fact.join(dim, bk).where(inside)


def overlaps(dim: DataFrame, bk: list[str], version: str) -> DataFrame:
    """Versions of one key whose periods overlap (inclusive ends).

    Per key, sorted by start, a version overlaps an earlier one when it starts
    no later than the latest end seen so far; O(n log n) instead of all pairs.
    """
    end = F.coalesce("valid_to", F.lit("9999-12-31").cast("date"))
    w = Window.partitionBy(*bk).orderBy("valid_from", version).rowsBetween(Window.unboundedPreceding, -1)
    latest = F.max(F.struct(end.alias("end"), F.col(version).alias("v"))).over(w)
    return (
        dim.withColumn("_latest", latest).where(F.col("valid_from") <= F.col("_latest.end"))
        .select(*bk, F.col(version), "valid_from", "valid_to", F.col("_latest.v").alias("overlaps_with"))
    )
