"""Incremental loads with Structured Streaming.

Every stream runs to the end of the available files and stops; its progress is
kept in a checkpoint below the shared folder, so the next call continues.
"""

from __future__ import annotations

from hashlib import md5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """Files of a folder as a stream; all new files form one batch.

    Set ``files_per_batch`` only for loads that do not depend on event time
    (``load_days``), or for files that arrive in event-time order: a later
    batch of older events would count as late.
    """
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(folder)


def load_days(stream: DataFrame, table: str, delivery: str, checkpoint: str) -> None:
    """Keeps every row under its ``delivery``, stream and batch; a batch that is repeated after a failure overwrites itself.

    Batch numbers count per checkpoint, so a stream is known by its checkpoint folder: streams with folders of their own add
    to the same delivery.  ``latest_days`` reads the table, ``compact_days`` drops what later deliveries replaced.
    """
    name = md5(checkpoint.encode()).hexdigest()

    def keep(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumns({"_stream": F.lit(name), "_batch": F.lit(batch_id)}).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(delivery, "_stream", "_batch").parquet(table)
        )

    query = stream.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def latest_days(rows: DataFrame, day: str, delivery: str) -> DataFrame:
    """The rows of each day's newest delivery: a day split over files, batches or streams adds up, a redelivered day
    replaces the earlier one."""
    newest = rows.groupBy(day).agg(F.max(delivery).alias("_newest"))
    return rows.join(newest, day).where(F.col(delivery) == F.col("_newest")).drop("_newest", "_stream", "_batch")


def compact_days(spark: SparkSession, table: str, target: str, day: str, delivery: str) -> None:
    """Writes the newest delivery of each day to ``target``, as one batch; load and read there from now on.

    The old table stays as it is, so a failure on the way loses nothing; it can be removed once ``target`` is in use.
    """
    rows = latest_days(spark.read.parquet(table), day, delivery).withColumns({"_stream": F.lit("compacted"), "_batch": F.lit(0)})
    rows.hint("rebalance", delivery).write.partitionBy(delivery, "_stream", "_batch").parquet(target)


def append(stream: DataFrame, table: str, checkpoint: str) -> None:
    query = (
        stream.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()


def without_duplicates(events: DataFrame, key: str, ts: str, delay: str) -> DataFrame:
    """Scans seen once: repeats within the watermark are dropped, state older
    than ``delay`` is released."""
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def daily_totals(events: DataFrame, ts: str, by: str, value: str, delay: str | None) -> DataFrame:
    """Tumbling daily count and sum.  As a stream (``delay`` given) a day is
    emitted once the watermark has passed its end; as a batch all days are."""
    rows = events.withWatermark(ts, delay) if delay else events
    per = rows.groupBy(F.window(ts, "1 day").alias("w"), by).agg(
        F.count(F.lit(1)).alias("events"), F.sum(F.col(value).cast("decimal(12,2)")).alias("total")
    )
    return per.select(F.col("w.start").cast("date").alias("day"), by, "events", F.col("total").cast("double").alias("total"))
