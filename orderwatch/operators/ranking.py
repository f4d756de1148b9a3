"""Ordering and top-k reports. Ties are settled by named columns, so that answers repeat."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sort_desc(df: DataFrame, by: str, ties: list[str]) -> DataFrame:
    return df.orderBy(F.desc(by), *ties)


def top_overall(df: DataFrame, by: str, k: int = 5, ties: list[str] | None = None) -> DataFrame:
    """The k largest rows of the whole frame. Each task keeps k rows, no full sort takes place."""
    return sort_desc(df, by, ties or ["window_start", "product_name"]).limit(k)


def top_per_window(df: DataFrame, by: str, k: int = 5, ties: list[str] | None = None) -> DataFrame:
    """The k largest rows of each window with their rank; cut to k per task before the shuffle.

    For a table, or a batch inside `foreachBatch`.
    """
    order = Window.partitionBy("window_start").orderBy(F.desc(by), *(ties or ["product_name"]))
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
