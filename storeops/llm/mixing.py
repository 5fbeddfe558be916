"""Mixing sources to target weights by hash-seeded repetition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeops.llm.common import WORD, store, whole

WEIGHTS = (5, 2, 1)  # given to the sources in order, repeating
SHARE = 1.5  # words of the mix over words of the input
CAP = 2.0  # no source is repeated more often than this
SEED = "mix"
FEW_SOURCES = 50_000  # rate tables up to this size are broadcast


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """source, source_size, target: weighted shares of ``share`` times all words, none above ``cap`` times its source.

    One row per source, from one grouped row per source.  A source is held at its cap when filling all sources up to its
    own cap-to-weight ratio takes no more than there is to share; the rest divide what remains by weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    up = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    whole_table = Window.partitionBy(F.lit(1))
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("nth"), F.lit(len(weights))) + 1).cast("int"))
    filled = (
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("nth", F.row_number().over(by_name) - 1)
        .withColumn("weight", pick)
        .withColumn("cap", F.col("source_size") * F.lit(cap))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("all_words", F.sum("source_size").over(whole_table) * F.lit(share))
        .withColumn("caps", F.sum("cap").over(up.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("rest", F.sum("weight").over(whole_table) - F.sum("weight").over(up.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("held", F.col("caps") + F.col("ratio") * F.col("rest") <= F.col("all_words"))
    )
    level = (F.col("all_words") - F.coalesce(F.sum(F.when(F.col("held"), F.col("cap"))).over(whole_table), F.lit(0.0))) / F.sum(
        F.when(~F.col("held"), F.col("weight"))
    ).over(whole_table)
    return filled.select("source", "source_size", F.when(F.col("held"), F.col("cap")).otherwise(level * F.col("weight")).alias("target"))


def unit_hash(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that only the id and the seed decide."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("-")))), 1, 12)
    return F.conv(digits, 16, 10).cast("long") / float(1 << 48)


def copies_per_document(docs: DataFrame, seed: str = SEED, **options) -> DataFrame:
    """doc_id, source, size, source_size, target, copies: the floor of the rate plus one copy by chance of its fraction.

    A null or empty text has size 0 and may still be copied.  A null source is a source of its own, last in order.  A
    source without words has target 0 and rate 0.  Repeated rows share an id and so share its fate.
    """
    sizes = docs.select("doc_id", "source", n_words(whole("text")).alias("size"))
    targets = source_targets(sizes, **options).withColumnRenamed("source", "of")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    drawn = F.when(unit_hash(F.col("doc_id"), seed) < rate - F.floor(rate), 1).otherwise(0)
    return sizes.join(targets, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "source", "size", "source_size", "target", (F.floor(rate) + drawn).cast("int").alias("copies")
    )


def mix(docs: DataFrame, seed: str = SEED, **options) -> DataFrame:
    """The rows of ``docs`` with all their columns, each as often as the mix takes it.

    Null, empty and wordless texts count no words; their source's rate still applies to them.  A long text counts whole.
    Rows of one id, repeated or not, are drawn alike, as the draw is seeded by the id; rows without id share one draw.
    A null source is a source.  An empty table gives an empty result.  Columns may have any names.
    """
    targets = source_targets(docs.select("source", n_words(whole("text")).alias("size")), **options)
    rates = targets.select(
        F.col("source").alias("of"), F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate")
    )
    rates = store(rates, "mix_rates")
    if rates.count() <= FEW_SOURCES:  # texts stay where they are; beyond this the join is left to Spark
        rates = F.broadcast(rates)
    drawn = F.when(unit_hash(F.col("row.doc_id"), seed) < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    return (
        docs.select(F.struct("*").alias("row"))  # apart from the columns added here
        .join(rates, F.col("row.source").eqNullSafe(F.col("of")))
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(int(options.get("cap", CAP)) + 1))))
        .where(F.col("copy") <= F.floor("rate") + drawn)
        .select("row.*")
    )


def oracle(docs: str = "documents", seed: str = SEED) -> str:
    """The query's rows in DuckDB SQL, reading the relation ``docs``."""
    return f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+')) AS BIGINT) AS size FROM {docs}
), per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth FROM sized GROUP BY source
), w AS (
  SELECT *, CAST(CASE nth % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS weight, source_size * 2.0::DOUBLE AS cap FROM per
), f AS (
  SELECT *, (sum(source_size) OVER ()) * 1.5::DOUBLE AS all_words,
    sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)
    + cap / weight * (sum(weight) OVER () - sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)) AS need FROM w
), t AS (
  SELECT source, source_size, CASE WHEN need <= all_words THEN cap ELSE
    (all_words - coalesce(sum(CASE WHEN need <= all_words THEN cap END) OVER (), 0.0)) / sum(CASE WHEN need > all_words THEN weight END) OVER () * weight
  END AS target FROM f
), r AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
    CAST('0x' || substr(md5('{seed}:' || coalesce(CAST(s.doc_id AS VARCHAR), '-')), 1, 12) AS BIGINT) / 281474976710656.0::DOUBLE AS u
  FROM sized s JOIN t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM r
"""
