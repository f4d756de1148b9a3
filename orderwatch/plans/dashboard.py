"""The dashboard's panels, read from the latest view of the output tables over a time range.

Ranges are closed at the start and open at the end, so that neighbouring ranges do not share rows.
The change log would count a window once per update; pass the latest view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _within(df: DataFrame, time: str, start: str, end: str) -> DataFrame:
    kind = df.schema[time].dataType
    first, after = F.lit(start).cast(kind), F.lit(end).cast(kind)
    if "day" in df.columns:  # the compacted view is stored by day, so only the days shown are read
        df = df.filter(F.col("day").between(F.to_date(first), F.to_date(after)))
    return df.filter((F.col(time) >= first) & (F.col(time) < after))


def order_series(stats: DataFrame, start: str, end: str) -> DataFrame:
    return _within(stats, "stat_time", start, end).select("stat_time", "total_orders").orderBy("stat_time")


def sales_series(stats: DataFrame, start: str, end: str) -> DataFrame:
    rows = _within(stats, "stat_time", start, end)
    return rows.select("stat_time", "total_sales", "avg_order_value").orderBy("stat_time")


def suspicious_series(stats: DataFrame, start: str, end: str) -> DataFrame:
    """Suspicious addresses over time; needs statistics built with `enrich`."""
    return _within(stats, "stat_time", start, end).select("stat_time", "suspicious_ip_count").orderBy("stat_time")


def top_products(popular: DataFrame, start: str, end: str, k: int = 5) -> DataFrame:
    totals = (
        _within(popular, "window_start", start, end)
        .groupBy("product_name")
        .agg(F.sum("order_count").alias("order_count"), F.sum("total_sales").alias("total_sales"))
    )
    return totals.orderBy(F.desc("order_count"), "product_name").limit(k)


def suspicious_table(suspicious: DataFrame, start: str, end: str, k: int = 20) -> DataFrame:
    rows = _within(suspicious, "window_start", start, end)
    return rows.orderBy(F.desc("window_start"), F.desc("order_count"), "ip_address").limit(k)


def high_value_count(high_value: DataFrame, start: str, end: str) -> DataFrame:
    return _within(high_value, "order_time", start, end).agg(F.count("*").alias("high_value_count"))
