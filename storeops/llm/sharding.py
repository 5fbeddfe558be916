"""Shards of nearly equal size by sampled splitters.

Records are ordered by a hash of their text, so equal texts lie together.  A size-weighted sample of keys gives quantile
boundaries; ranges and then single keys that hold too much are subdivided, and the resulting cells are dealt to the shards
in order by their exact byte sums.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeops.llm.common import store, whole

N_RANGES = 256
SAMPLES = 4096  # expected number of size-weighted draws, whatever the input
CELLS = 2048  # a cell aims at this share of all bytes ...
CELL_ROWS = 1_000_000  # ... and at no more rows than this
STEP = 16  # boundaries per block of the two-step lookup


def key_sample(records: DataFrame, total: int) -> list[tuple[int, int]]:
    """(key, draws) of about ``SAMPLES`` draws with chance proportional to size; decided by a hash, so reruns agree."""
    unit = F.pmod(F.xxhash64("id", "crc", F.lit(17)), F.lit(1 << 40)) / float(1 << 40)
    expected = F.col("size") * (SAMPLES / total)
    draws = (F.floor(expected) + F.when(unit < expected - F.floor(expected), 1).otherwise(0)).cast("int")
    rows = records.select("key", draws.alias("draws")).where("draws > 0").collect()
    return sorted((r.key, r.draws) for r in rows)


def splitters(sample: list[tuple[int, int]], n_ranges: int = N_RANGES) -> list[int]:
    """Weighted quantiles of the sample as range boundaries."""
    if not sample:
        return []
    summed = list(accumulate(d for _, d in sample))
    found, nth = [], 1
    for (key, _), upto in zip(sample, summed):
        while nth < n_ranges and upto * n_ranges >= nth * summed[-1]:
            found.append(key)
            nth += 1
    return sorted(set(found))


def range_of(key: Column, bounds: list[int]) -> Column:
    """Number of boundaries at or below the key: first among every 16th boundary, then inside that block."""
    if not bounds:
        return F.lit(0)
    array = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    below = lambda xs: F.size(F.filter(xs, lambda b: b <= key))
    block = F.greatest(below(array(bounds[::STEP])) - 1, F.lit(0))
    return block * STEP + below(F.slice(array(bounds), block * STEP + 1, F.lit(STEP)))


def shard_by_bytes(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, size (UTF-8 bytes plus one), text_crc32, shard and slot of every row of ``docs``.

    A null text has no bytes: size 1, checksum 0.  Null ids are ordinary values.  Repeated rows get slots of their own, in
    unspecified order among themselves.  Equal texts share a shard unless they alone exceed a cell.  An empty table gives
    an empty result; other columns of ``docs`` are not looked at.
    """
    text = whole(F.col(text_col))
    records = store(docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("crc"),
        F.xxhash64(text).alias("key"), F.monotonically_increasing_id().alias("row"),
    ), "shard_records")
    totals = records.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("b"), F.count("*").alias("n")).first()
    total, aim, row_aim = max(totals.b, 1), max(totals.b // CELLS, 1), CELL_ROWS
    bounds = splitters(key_sample(records, total))
    ranged = records.withColumn("range", range_of(F.col("key"), bounds))

    # an overfull range is split by key ...
    def pieces(aim_bytes):
        return F.ceil(F.greatest(F.sum("size") / aim_bytes, F.count("*") / row_aim)).cast("long")

    per_range = {r.range: r.parts for r in ranged.groupBy("range").agg(pieces(aim).alias("parts")).collect()}
    parts = F.array(*[F.lit(per_range.get(i, 1)).cast("long") for i in range(len(bounds) + 1)])
    split = ranged.withColumn("part", F.pmod(F.xxhash64("key", F.lit(5)), F.get(parts, F.col("range"))))
    # ... and a cell that is still overfull holds a heavy text, whose copies are split row by row, also those of one id
    heavy = split.groupBy("range", "part").agg(pieces(aim).alias("subs")).where("subs > 2")
    celled = (
        split.join(heavy, ["range", "part"], "left")
        .withColumn("sub", F.pmod(F.xxhash64("row", F.lit(9)), F.coalesce("subs", F.lit(1))))
        .select("id", "size", "crc", "range", "part", "sub")
    )
    # one row per cell: about CELLS, or one per million records
    in_order = Window.orderBy("range", "part", "sub")
    dealt = (
        celled.groupBy("range", "part", "sub").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
        .withColumn("upto", F.sum("bytes").over(in_order))
        .withColumn("middle", F.col("upto") - F.col("bytes") / 2)
        .withColumn("shard", F.least(F.floor(F.col("middle") * n_shards / total), F.lit(n_shards - 1)).cast("int"))
    )
    before = Window.partitionBy("shard").orderBy("range", "part", "sub")
    dealt = dealt.select("range", "part", "sub", "shard", (F.sum("rows").over(before) - F.col("rows")).alias("first"))
    within = Window.partitionBy("range", "part", "sub").orderBy("id", "crc", "size")
    return (
        celled.withColumn("nth", F.row_number().over(within) - 1)
        .join(dealt, ["range", "part", "sub"])
        .select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard", (F.col("first") + F.col("nth")).alias("slot"))
    )
