"""From raw documents to packed training windows: five stages, each written before the next reads it.

In every stage null and empty texts are documents without words: they are not toxic by themselves, near no other document
and hold no passage; the mix takes them at the rate of their source, and packing gives them their end mark only.  A long
text is judged whole.  Repeated rows are treated alike; rows of one id with different texts are judged each by its own
text; of equal texts the smallest id stays.  Rows without id pass the stages that compare documents.  An empty table gives
an empty result.  Columns beyond those of documents are dropped by the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeops.llm import mixing, neardup, packing, substrings, toxicity
from storeops.llm.common import store, table
from storeops.llm.queries import rank_file

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
NEAR_SHINGLE = 5  # words


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not mark toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, COLUMNS, "_score").where("_score < 0.5").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates; rows without id are all kept.

    Rows that share an id are told apart by their texts, so one that stays is not lost with one that goes.
    """
    groups = neardup.near_duplicates(docs, NEAR_SHINGLE)
    gone = groups.where(~F.col("kept")).select("doc_id", "p").distinct()
    return docs.select(*COLUMNS, neardup.text_print()).join(gone, ["doc_id", "p"], "left_anti").select(*COLUMNS)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the passages an earlier one holds; untouched texts stay as they are."""
    cut = substrings.remove_passages(docs, ("text", "lang", "source", "n_chars"))
    changed = F.col("n_removed") > 0
    return cut.select(
        "doc_id", F.when(changed, F.col("kept")).otherwise(F.col("x_0")).alias("text"), F.col("x_1").alias("lang"), F.col("x_2").alias("source"),
        F.when(changed, F.length("kept").cast("long")).otherwise(F.col("x_3")).alias("n_chars"),
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs).select(*COLUMNS)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows."""
    return packing.pack(docs, rank_file())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", drop_repeated_passages),
    ("source_mixing", mix_sources),
    ("packing", pack_windows),
]

ORACLE_SQL = None  # a trained classifier and a tokenizer are not SQL; the tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
