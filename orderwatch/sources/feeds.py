"""Tables in the shape of orders: the adapters from the test tables to the operators' input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PROPS = "k INT"


def orders_from_events(events: DataFrame) -> DataFrame:
    """Events as orders: the event type is the product, the user the address. Works on streams too."""
    return events.select(
        F.col("event_id").alias("order_id"),
        F.col("ts").alias("timestamp"),
        "user_id",
        F.col("event_type").alias("product_id"),
        F.col("event_type").alias("product_name"),
        F.round(F.col("value") * 100).cast("int").alias("price"),
        F.from_json("props", PROPS)["k"].alias("quantity"),
        F.col("user_id").alias("ip_address"),
        F.lit(None).cast("string").alias("payment_method"),
    )


def event_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def lineitem_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as orders: the part is the product, the supplier the address, times are whole days.

    A line number is below 8, so the id below is unique. The part table may be any size: Spark
    broadcasts it below its own limit and sorts and merges above it.
    """
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    return lines.join(parts, lines["l_partkey"] == parts["p_partkey"]).select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("order_id"),
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_orderkey").alias("user_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.round(F.col("p_retailprice") * 100).cast("int").alias("price"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_suppkey").alias("ip_address"),
        F.lit(None).cast("string").alias("payment_method"),
    )
