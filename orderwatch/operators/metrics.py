"""Reports on metrics samples and on runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderwatch.functions.scalars import megabytes
from orderwatch.operators.prefix import with_previous


def counter_delta(
    df: DataFrame,
    counters: list[str],
    order_by: list[str],
    partition_by: list[str] | None = None,
    block: str | Sequence[str] = "1 hour",
) -> DataFrame:
    """Adds for each cumulative byte counter its growth since the previous sample, in MB.

    Null on the first sample of a series. The first of `order_by` is the time of the sample; long
    series are worked on in pieces of one `block`.
    """
    rows = with_previous(df, counters, order_by, partition_by, block)
    deltas = {f"{c}_delta_mb": megabytes(F.col(c) - F.col("previous")[c]) for c in counters}
    return rows.withColumns(deltas).drop("previous")


def success_rate(df: DataFrame, failed: Column) -> DataFrame:
    """Sent, failed and the percentage that did not fail, as one row; the rate is null if none was sent."""
    counts = df.agg(F.count("*").alias("sent"), F.count_if(failed).alias("failed"))
    rate = F.when(F.col("sent") > 0, 100.0 * (F.col("sent") - F.col("failed")) / F.col("sent"))
    return counts.withColumn("success_rate", rate)


def load_summary(df: DataFrame, by: str) -> DataFrame:
    """Processor, memory and disk-write figures of the samples of each run or load level."""
    return df.groupBy(by).agg(
        F.count("*").alias("samples"),
        F.avg("cpu_percent").alias("avg_cpu"),
        F.max("cpu_percent").alias("peak_cpu"),
        F.avg("memory_percent").alias("avg_memory"),
        F.avg("memory_used_mb").alias("avg_memory_mb"),
        F.min("disk_write_mb").alias("min_disk_write_mb"),
        F.max("disk_write_mb").alias("max_disk_write_mb"),
    )
