"""Single-order rules. Stateless, so they run the same on tables and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderwatch.functions.scalars import money_text


def high_value_orders(df: DataFrame, threshold: int = 500_000) -> DataFrame:
    """Orders of at least `threshold` in total, under the columns of their output table."""
    return df.filter(F.col("total_price") >= threshold).select(
        F.col("timestamp").alias("order_time"),
        "order_id",
        "product_name",
        "quantity",
        "total_price",
        "ip_address",
    )


def high_value_display(df: DataFrame, threshold: int = 500_000) -> DataFrame:
    """The same rows with the amount as text with thousands separators."""
    return high_value_orders(df, threshold).withColumn("total_price", money_text(F.col("total_price")))
