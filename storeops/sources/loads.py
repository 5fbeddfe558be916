"""Writing gold tables with an audit trail."""

from __future__ import annotations

import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from storeops.operators.quality import enforce
from storeops.sources.layout import LAYOUTS, with_period
from storeops.sources.tables import write_table


class LoadFailed(RuntimeError):
    """Some steps failed; ``audit`` holds the rows of all steps."""

    def __init__(self, audit: list[tuple]):
        super().__init__("; ".join(f"{name}: {status}" for name, _, _, status in audit if status != "OK"))
        self.audit = audit


AUDIT_SCHEMA = "step string, row_count bigint, seconds double, status string"


def load_tables(
    spark: SparkSession, steps: dict[str, DataFrame], path_of: Callable[[str], str],
    partition_by: dict[str, list[str]] | None = None,
) -> DataFrame:
    """Writes every step and returns the audit table.

    Row counts are observed while writing, so no table is read twice; a failed
    step is recorded, the others are still written, and then ``LoadFailed`` is
    raised with the audit, so an incomplete set is never taken for a whole one.
    """
    audit = []
    for name, df in steps.items():
        seen = Observation(f"load_{name}")
        start = time.time()
        try:
            write_table(df.observe(seen, F.count(F.lit(1)).alias("n")), path_of(name), (partition_by or {}).get(name))
            audit.append((name, int(seen.get["n"]), time.time() - start, "OK"))
        except Exception as exc:  # noqa: BLE001 - the audit keeps the reason
            audit.append((name, None, time.time() - start, f"FAILED: {type(exc).__name__}"))
    if any(status != "OK" for *_, status in audit):
        raise LoadFailed(audit)
    return spark.createDataFrame(audit, AUDIT_SCHEMA)


def store_gold(mart, folder: str, report: DataFrame | None = None) -> DataFrame:
    """Stores all facts, cut into the periods of ``layout.LAYOUTS``; returns the audit.

    With a ``report`` of checks (``operators.rules``), it is stored first, in ``quality_report`` below the folder, and a
    failed BLOCK check raises ``QualityError`` before any fact is written.
    """
    from storeops.sources.mart import GOLD_FACTS

    if report is not None:
        path = os.path.join(folder, "quality_report")
        report.write.mode("overwrite").parquet(path)
        enforce(mart.spark.read.parquet(path))

    steps = {name: with_period(getattr(mart, name), LAYOUTS[name]) for name in GOLD_FACTS}
    return load_tables(mart.spark, steps, lambda name: os.path.join(folder, name), {name: [LAYOUTS[name].folder] for name in steps})


def register_views(spark: SparkSession, paths: dict[str, str]) -> None:
    for name, path in paths.items():
        spark.read.parquet(path).createOrReplaceTempView(name)


def profile(name: str, df: DataFrame) -> DataFrame:
    """Columns of one table with row count and filled rows, in a single pass."""
    fields = df.schema.fields
    one = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(F.col(f.name)).alias(f"c{i}") for i, f in enumerate(fields)],
    )
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("table_name"), F.lit(i + 1).alias("position"), F.lit(f.name).alias("column_name"),
            F.col("n").alias("row_count"), F.col(f"c{i}").alias("filled_rows"),
        )
        for i, f in enumerate(fields)
    ])
    return one.select(F.inline(rows))
