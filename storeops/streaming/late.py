"""Streams that lose nothing: every row is kept, a repeat, or late, and late rows correct the totals already given out."""

from __future__ import annotations

import os
from hashlib import md5

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeops.session import materialize

KEPT, REPEAT, LATE = "kept", "repeat", "late"
ROWS, MARKS = "rows", "marks"


def _others(spark: SparkSession, path: str, schema: T.StructType, stream: str, batch_id: int) -> DataFrame | None:
    """What other batches left below ``path``; None before the first one."""
    places = T.StructType([*schema.fields, T.StructField("_stream", T.StringType()), T.StructField("_batch", T.LongType())])
    try:
        return spark.read.schema(places).parquet(path).where((F.col("_stream") != stream) | (F.col("_batch") != batch_id))
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def split_rows(stream: DataFrame, folder: str, key: str, ts: str, delay: str, checkpoint: str) -> None:
    """Puts every row of a stream below ``folder`` as kept, repeat or late; nothing is dropped.

    late     older than the mark less ``delay``, or without a time.  The mark is the latest event time of the batches
             before this one, whichever run or stream brought them.
    repeat   not late, and its key is kept already with a time the delay still reaches, or by an earlier row of its batch
    kept     all others; rows without key are never repeats

    ``folder`` holds ``rows`` (partitioned by day, outcome, stream and batch) and ``marks`` (one row per batch).  A batch that
    is repeated after a failure overwrites itself.  Only days within the delay of the mark are read for earlier keys, so the
    work of a batch does not grow with the history.  Streams know themselves by their checkpoint folder; let them run one
    after another.
    """
    name = md5(checkpoint.encode()).hexdigest()
    wait = F.expr(f"interval {delay}")
    rows_path, marks_path = os.path.join(folder, ROWS), os.path.join(folder, MARKS)
    placed_schema = T.StructType([*stream.schema.fields, T.StructField("_day", T.DateType()), T.StructField("_outcome", T.StringType())])

    def keep(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        staged = materialize(spark, batch.withColumn("_row", F.monotonically_increasing_id()), "batch-rows")
        marks = _others(spark, marks_path, T.StructType([T.StructField("mark", batch.schema[ts].dataType)]), name, batch_id)
        reach = None if marks is None else marks.agg(F.max("mark").alias("m")).select((F.col("m") - wait).alias("reach")).first()["reach"]
        late = F.col(ts).isNull() if reach is None else F.col(ts).isNull() | (F.col(ts) < F.lit(reach))
        placed = staged.withColumn("_late", late)
        # a hot key is one row per task before it moves
        first = placed.where(~F.col("_late") & F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(ts, "_row"))["_row"].alias("_first"))
        earlier = None if reach is None else _others(spark, rows_path, placed_schema, name, batch_id)
        if earlier is not None:
            seen = earlier.where((F.col("_day") >= F.to_date(F.lit(reach))) & (F.col("_outcome") == KEPT) & (F.col(ts) >= F.lit(reach)) & F.col(key).isNotNull())
            first = first.join(seen.select(key, F.lit(True).alias("_seen")).distinct(), key, "left")
        else:
            first = first.withColumn("_seen", F.lit(None).cast("boolean"))
        repeat = F.col("_seen").isNotNull() | (F.col("_row") != F.col("_first"))
        outcome = F.when(F.col("_late"), LATE).when(F.coalesce(repeat, F.lit(False)), REPEAT).otherwise(KEPT)
        rows = placed.join(first, key, "left").select(
            *batch.columns, F.coalesce(F.to_date(ts), F.lit("1970-01-01").cast("date")).alias("_day"), outcome.alias("_outcome"), F.lit(name).alias("_stream"), F.lit(batch_id).alias("_batch"))
        by = ["_day", "_outcome", "_stream", "_batch"]
        rows.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(rows_path)
        mark = staged.agg(F.max(ts).alias("mark")).where("mark is not null").select("mark", F.lit(name).alias("_stream"), F.lit(batch_id).alias("_batch"))
        mark.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_stream", "_batch").parquet(marks_path)

    stream.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """All rows with ``outcome``, as ``split_rows`` left them."""
    rows = spark.read.parquet(os.path.join(folder, ROWS))
    return rows.withColumnRenamed("_outcome", "outcome").drop("_day", "_stream", "_batch")


def closed_before(spark: SparkSession, folder: str, delay: str) -> Column:
    """First day that is still open: every day before it ended at least ``delay`` before the mark."""
    marks = spark.read.parquet(os.path.join(folder, MARKS))
    return marks.agg(F.to_date(F.max("mark") - F.expr(f"interval {delay}")).alias("v")).scalar()


def corrected_totals(spark: SparkSession, folder: str, key: str, ts: str, by: str, value: str, delay: str) -> DataFrame:
    """Daily totals of the closed days: as given out when the day closed, what came late, and both together.

    Late rows count once per key, and not if their key is kept or came late before; late rows without key all count.  A day
    of which all rows came late appears with nothing given out.
    """
    rows = outcomes(spark, folder).where(F.to_date(ts) < closed_before(spark, folder, delay))
    amount = F.col(value).cast("decimal(12,2)")
    lean = rows.select(key, F.col(ts).alias("_ts"), by, amount.alias("_amount"), "outcome")
    kept, late = lean.where(F.col("outcome") == KEPT), lean.where(F.col("outcome") == LATE)
    once = late.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct("_ts", by, "_amount")).alias("r")).select(key, "r.*")
    known = outcomes(spark, folder).where((F.col("outcome") == KEPT) & F.col(key).isNotNull()).select(key)
    added = once.join(known, key, "left_anti").select("_ts", by, "_amount").union(late.where(F.col(key).isNull()).select("_ts", by, "_amount"))
    every = kept.select("_ts", by, "_amount", F.lit(0).alias("_late")).union(added.withColumn("_late", F.lit(1)))
    of = lambda flag: F.col("_late") == flag
    amounts = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("_amount"))), F.lit(0).cast("decimal(12,2)")).cast("double")
    return every.groupBy(F.to_date("_ts").alias("day"), by).agg(
        F.count_if(of(0)).alias("given_events"), amounts(of(0)).alias("given_total"), F.count_if(of(1)).alias("late_events"), amounts(of(1)).alias("late_total"),
        F.count(F.lit(1)).alias("events"), amounts(F.lit(True)).alias("total"),
    )
