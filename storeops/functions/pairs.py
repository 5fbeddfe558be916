"""Pair operators that never enumerate a whole group.

``top_pairs``       k most frequent pairs over baskets
``banded_pairs``    pairs whose values lie within a tolerance
``nearest_other``   closest other member of the same group
``nearest_k``       k closest members among candidates
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeops.functions.ranks import ranked
from storeops.session import materialize

HEAVY_BASKET = 256   # items; larger baskets are counted by membership
PLAIN_PAIRS = 16     # pairs formed per row up to which bounds would cost more than they save
SEED_ITEMS = 64      # most frequent items whose pairs give the first lower bound
SALT_ROWS = 1024     # rows of one block of a value band; a block meets another in one task
PAIRS_PER_TASK = 2_000_000  # pairs formed by one task, about
MOST_TASKS = 10_000


def _ranking() -> list[Column]:
    return [F.desc("orders"), F.asc("a"), F.asc("b")]


def _enumerate(left: DataFrame, right: DataFrame, order: str, keep: Callable[[Column, Column], Column]) -> DataFrame:
    """(a, b, orders) over baskets; sides are distinct (order, item)."""
    sides = left.select(order, F.col("item").alias("a")).join(right.select(order, F.col("item").alias("b")), order)
    return sides.where(keep(F.col("a"), F.col("b"))).groupBy("a", "b").agg(F.count(F.lit(1)).alias("orders"))


class _Best:
    """The k best pairs found so far, stored, and what another pair must reach to displace one of them.

    ``bar`` is the count of the k-th pair, ``edge`` the largest (a, b) with that count; with fewer than k pairs every pair
    counts: ``bar`` is 1 and ``edge`` None.  Counts may be too low as long as a later merge brings the right one.
    """

    def __init__(self, pairs: DataFrame, k: int):
        found = pairs.groupBy("a", "b").agg(F.max("orders").alias("orders")).orderBy(*_ranking()).limit(k)
        self.k, self.rows = k, materialize(pairs.sparkSession, found, "best-pairs")
        n, least = self.rows.agg(F.count(F.lit(1)), F.min("orders")).head()
        self.bar, self.edge = 1, None
        if n == k:
            self.bar = least
            self.edge = self.rows.where(F.col("orders") == least).agg(F.max(F.struct("a", "b")).alias("v")).scalar()

    def merge(self, pairs: DataFrame) -> _Best:
        return _Best(self.rows.unionByName(pairs), self.k)

    def reached(self, bound: Column) -> Column:
        """A pair (a, b) in at most ``bound`` baskets may still be, or already is, among the best."""
        if self.edge is None:
            return F.lit(True)
        return (bound > self.bar) | ((bound == self.bar) & (F.struct("a", "b") <= self.edge))


def top_pairs(
    left: DataFrame, right: DataFrame, order: str, k: int, keep: Callable[[Column, Column], Column],
    heavy: int = HEAVY_BASKET, seeds: int = SEED_ITEMS,
) -> DataFrame:
    """The k pairs (a, b) found together in most orders: exact, ties by (a, b).

    ``left`` and ``right`` hold (order, item), where item is a struct.  Baskets that are all small are enumerated at once,
    if that forms few pairs per row.  Otherwise bounds decide what is counted.  A pair occurs at most as often as its rarer item,
    so the pairs of the most frequent items are counted first; their k-th count is a bar that removes rarer items.
    Of the items left, baskets of up to ``heavy`` are enumerated.  A larger basket adds one to each of its pairs: pairs
    known from smaller baskets are looked up by membership, if their bound reaches the bar.  A pair seen in larger
    baskets only must share ``bar`` of them, so each item leaves out its ``bar`` - 1 largest ones when candidates are
    formed (two items with enough in common still meet), and candidates are counted by membership.  With a bar of two or
    more, the largest basket is therefore never enumerated; pairs that could only tie with the k-th are formed with
    items up to that pair only.  Rows without order or item are left out.
    """
    spark = left.sparkSession
    same = left is right

    def stored(side: DataFrame) -> DataFrame:
        return materialize(spark, side.where(F.col(order).isNotNull() & F.col("item").isNotNull()).select(order, "item").distinct(), "basket")

    def frequency(side: DataFrame) -> DataFrame:
        return materialize(spark, side.groupBy("item").agg(F.count(F.lit(1)).alias("n")), "item-counts")

    left = stored(left)
    right = left if same else stored(right)
    sizes = (left if same else left.unionByName(right)).groupBy(order).agg(F.count(F.lit(1)).alias("m"))
    rows, formed, widest = sizes.agg(F.sum("m"), F.sum(F.col("m") * F.col("m")), F.max("m")).head()
    if rows is None or (widest <= heavy and formed <= PLAIN_PAIRS * rows):
        return _enumerate(left, right, order, keep).orderBy(*_ranking()).limit(k)

    left_n = frequency(left)
    right_n = left_n if same else frequency(right)

    def of_items(side: DataFrame, counts: DataFrame, *by: Column) -> DataFrame:
        return side.join(F.broadcast(counts.orderBy(*by).limit(seeds).select("item")), "item", "left_semi")

    by_count = [F.desc("n"), F.asc("item")]
    best = _Best(_enumerate(of_items(left, left_n, *by_count), of_items(right, right_n, *by_count), order, keep), k)
    if best.edge is None:
        best = _Best(_enumerate(of_items(left, left_n, *by_count), right, order, keep), k)

    def living(side: DataFrame, counts: DataFrame) -> DataFrame:
        return materialize(spark, side.join(counts.where(F.col("n") >= best.bar), "item").select(order, "item", "n"), "live-basket")

    left = living(left, left_n)
    right = left if same else living(right, right_n)
    both = left if same else left.unionByName(right)
    large = both.groupBy(order).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > heavy)
    large = materialize(spark, large, "large-baskets")

    a_side = lambda df, *more: df.select(order, F.col("item").alias("a"), *more)
    b_side = lambda df, *more: df.select(order, F.col("item").alias("b"), *more)
    some = bool(large.head(1))
    small = lambda df: df.join(large, order, "left_anti") if some else df
    pairs = a_side(small(left), F.col("n").alias("n_a")).join(b_side(small(right), F.col("n").alias("n_b")), order)
    pairs = pairs.where(keep(F.col("a"), F.col("b"))).where(best.reached(F.least("n_a", "n_b")))
    pairs = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("orders"))
    if not some:
        return pairs.orderBy(*_ranking()).limit(k)

    def among_large(side: DataFrame) -> DataFrame:
        """order, item, size, h (large baskets of the item), place (1: its largest)."""
        rows = side.select(order, "item").join(large, order)
        rows = materialize(spark, rows, "large-rows")
        counted = rows.join(rows.groupBy("item").agg(F.count(F.lit(1)).alias("h")), "item")
        return materialize(spark, ranked(counted, ["item"], [-F.col("size"), F.col(order)], "place"), "large-places")

    big_left = among_large(left)
    big_right = big_left if same else among_large(right)
    held = lambda side, name: side.where("place = 1").select(F.col("item").alias(name), F.col("h").alias(f"h_{name}"))

    def shared(asked: DataFrame) -> DataFrame:
        """Large baskets that hold both items of each asked pair; pairs without one are left out."""
        rows = asked.select("a", "b").join(a_side(big_left), "a").join(b_side(big_right), [order, "b"])
        return rows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("extra"))

    h = F.least(F.coalesce("h_a", F.lit(0)), F.coalesce("h_b", F.lit(0)))
    known = pairs.join(held(big_left, "a"), "a", "left").join(held(big_right, "b"), "b", "left")
    known = materialize(spark, known.where(best.reached(F.col("orders") + h)).select("a", "b", "orders"), "known-pairs")
    best = best.merge(
        known.join(shared(known), ["a", "b"], "left").select("a", "b", (F.col("orders") + F.coalesce("extra", F.lit(0))).alias("orders"))
    )
    # first items in order that can still tie with the k-th pair: brings the edge down before ties are formed
    first = big_left.where((F.col("place") == 1) & (F.col("h") >= best.bar)).select("item")
    best = best.merge(_enumerate(of_items(big_left, first, F.asc("item")), big_right.where(F.col("h") >= best.bar), order, keep))

    def meeting(least: int, up_to: Column | None = None) -> DataFrame:
        """Pairs that share a large basket outside the ``least`` - 1 largest of either item, up to the pair ``up_to``."""
        near = lambda side: side.where((F.col("h") >= least) & (F.col("place") >= least))
        rows, other = a_side(near(big_left)), b_side(near(big_right))
        if up_to is None:
            return rows.join(other, order).where(keep(F.col("a"), F.col("b"))).select("a", "b")
        rows = rows.where(F.col("a") <= up_to["a"]).join(other, order)
        return rows.where(keep(F.col("a"), F.col("b")) & (F.struct("a", "b") <= up_to)).select("a", "b")

    asked = meeting(1) if best.edge is None else meeting(best.bar + 1).unionByName(meeting(best.bar, best.edge))
    asked = materialize(spark, asked.distinct(), "formed-pairs")
    return best.merge(shared(asked).withColumnRenamed("extra", "orders")).rows.orderBy(*_ranking())


def dealt_join(left: DataFrame, right: DataFrame, on: list[str], pairs: float) -> DataFrame:
    """Inner join of about ``pairs`` rows, dealt by ``on`` to as many tasks as they need.

    Sized by what comes out: the sides are small next to it, and AQE would merge them into a few tasks.
    """
    tasks = min(MOST_TASKS, math.ceil(pairs / PAIRS_PER_TASK))
    if tasks > 1:
        left, right = left.repartition(tasks, *on), right.repartition(tasks, *on)
    return left.join(right, on)


def banded_pairs(
    df: DataFrame, keys: list[str], ident: str, value: Column, width: Column, carry: list[str],
    salt_rows: int = SALT_ROWS,
) -> DataFrame:
    """Ordered pairs of different members of a group whose values differ by at
    most about ``width`` (a positive column, constant per group).

    Values fall into bands as wide as the tolerance, so a member meets its own
    and the two neighbouring bands only.  A band is cut into blocks of about
    ``salt_rows`` members; each block meets each block of these bands on its
    own, so a crowded band is bounded in memory and spread over tasks.
    The caller applies the exact condition; the result holds ``x_`` and ``y_``
    columns for both sides.
    """
    band = F.floor(value / width)
    rows = df.where(value.isNotNull() & (width > 0)).withColumn("_band", band)
    count = F.count(F.lit(1))
    sizes = rows.groupBy(*keys, "_band").agg(count.alias("_n"), F.ceil(count / F.lit(float(salt_rows))).cast("int").alias("_blocks"))
    sizes = materialize(df.sparkSession, sizes, "band-sizes")
    pairs = 3 * (sizes.select(F.sum(F.col("_n").cast("double") * F.col("_n"))).head()[0] or 0)  # at most

    def side(s: str, other: str) -> DataFrame:
        own = rows.join(sizes.drop("_n"), [*keys, "_band"]).select(
            *keys, F.col("_band").alias(f"_band_{s}"), F.pmod(F.xxhash64(ident), F.col("_blocks")).cast("int").alias(f"_block_{s}"),
            F.explode(F.array(F.col("_band") - 1, F.col("_band"), F.col("_band") + 1)).alias(f"_band_{other}"),
            *[F.col(c).alias(f"{s}_{c}") for c in (ident, *carry)],
        )
        met = own.join(sizes.select(*keys, F.col("_band").alias(f"_band_{other}"), "_blocks"), [*keys, f"_band_{other}"])
        return met.withColumn(f"_block_{other}", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).drop("_blocks")

    at = ["_band_x", "_block_x", "_band_y", "_block_y"]
    return dealt_join(side("x", "y"), side("y", "x"), [*keys, *at], pairs).where(F.col(f"x_{ident}") != F.col(f"y_{ident}")).drop(*at)


def levels(df: DataFrame, keys: list[str], value: str, ident: str, ids: int) -> DataFrame:
    """One row per group and distinct value: members and the smallest ids."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("members"))
    w = Window.partitionBy(*keys, value).orderBy(ident)
    first = df.select(*keys, value, ident).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= ids)
    first = first.groupBy(*keys, value).agg(F.array_sort(F.collect_list(ident)).alias("ids"))
    return counts.join(first, [*keys, value])


def nearest_other(df: DataFrame, keys: list[str], value: str, ident: str) -> DataFrame:
    """(ident, diff, other): closest other member of the same group, ties by
    id; NULL when the group has one member.

    Works on distinct values in sorted order (own level, one below, one
    above), so no pair is built.
    """
    lv = levels(df, keys, value, ident, 2)
    w = Window.partitionBy(*keys).orderBy(value)
    side = lambda f: F.struct(f(value).over(w).alias("v"), f(F.element_at("ids", 1)).over(w).alias("id"))
    lv = lv.withColumn("_lo", side(F.lag)).withColumn("_hi", side(F.lead)).drop("members")
    rows = df.select(*keys, value, ident).join(lv, [*keys, value])
    own = F.when(F.col("ids")[0] != F.col(ident), F.col("ids")[0]).otherwise(F.get("ids", F.lit(1)))
    option = lambda diff, other: F.when(diff.isNotNull() & other.isNotNull(), F.struct(diff.alias("diff"), other.alias("other")))
    here = option(F.col(value) - F.col(value), own)
    below = option(F.col(value) - F.col("_lo.v"), F.col("_lo.id"))
    above = option(F.col("_hi.v") - F.col(value), F.col("_hi.id"))
    pick = F.array_min(F.filter(F.array(here, below, above), lambda x: x.isNotNull()))
    return rows.select(ident, pick.alias("_p")).select(ident, F.col("_p.diff").alias("diff"), F.col("_p.other").alias("other"))


def nearest_k(df: DataFrame, keys: list[str], value: str, ident: str, candidate: Column, k: int) -> DataFrame:
    """(keys, value, ident, options): for every member the candidates on the
    k + 1 nearest value levels below (own level included) and k above, each
    level with its k + 1 smallest ids.  The k closest candidates are among
    them; the caller filters and cuts."""
    cand = levels(df.where(candidate), keys, value, ident, k + 1).select(*keys, value, F.struct(F.col(value).alias("value"), "ids").alias("_level"))
    asked = df.select(*keys, value).distinct()
    grid = asked.join(cand, [*keys, value], "left")
    seen = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    grid = grid.withColumn("_pos", F.count("_level").over(seen))
    around = Window.partitionBy(*keys).orderBy("_pos").rangeBetween(-k, k)
    grid = grid.withColumn("_near", F.collect_list("_level").over(around))
    flat = F.flatten(F.transform("_near", lambda l: F.transform(l["ids"], lambda i: F.struct(l["value"].alias("value"), i.alias("id")))))
    return df.select(*keys, value, ident).join(grid.select(*keys, value, flat.alias("options")), [*keys, value])
