"""Session defaults and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings an operator relies on.  Shuffle partition counts are left to the
# cluster and only raised with the facts (``size_shuffles``); AQE coalesces or
# splits from there.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(app: str = "storeops", cores: str = "8", **conf: str) -> SparkSession:
    """Session for tests and the local benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **DEFAULTS,
        "spark.sql.shuffle.partitions": cores,
        "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    if "spark.checkpoint.dir" not in settings:  # one machine: driver and executors see the same folder
        settings["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="storeops-")
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


ROWS_PER_TASK = 250_000  # fact rows a task sorts or groups at once, about
# Spark's defaults, and what keeps the sorts and the partial sums of a task at a few hundred MB
TASK_BYTES = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": ("67108864b", str(16 << 20)),  # small shuffle partitions are merged up to it
    "spark.sql.files.maxPartitionBytes": ("134217728b", str(32 << 20)),  # read by one task
}


def size_shuffles(spark: SparkSession, rows: int) -> None:
    """Let the number of tasks grow with the facts, so that the memory of one task does not.

    The number of shuffle partitions is raised only; sizes that differ from Spark's defaults are kept.
    """
    wanted = -(-rows // ROWS_PER_TASK)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    for name, (default, less) in TASK_BYTES.items():
        if spark.conf.get(name) == default:
            spark.conf.set(name, less)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, else one in the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured or os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "storeops-work")


def work_path(spark: SparkSession, name: str) -> str:
    """Fresh path below the shared folder for one written table."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside go as soon as these are done; else they wait for the driver's garbage collection."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def materialize(spark: SparkSession, df, name: str, partition_by: list[str] | None = None):
    """Write ``df`` once to the shared folder and read it back.

    Used where one expensive intermediate feeds several branches; a written
    table survives executor loss and cuts the lineage.  What was shuffled for
    it is dropped with the write.
    """
    path = work_path(spark, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with shuffles_dropped(spark):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
