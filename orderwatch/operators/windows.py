"""Event-time window aggregates. Each works on a table and on a stream.

On a stream the watermark bounds the state; on a table it has no meaning and is left out. Every
aggregate is a count or a sum, so Spark combines rows before the shuffle and a hot product or address
reaches the shuffle as one row per task and window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from orderwatch.functions.scalars import interval_seconds, seconds_between
from orderwatch.operators.prefix import running_total
from orderwatch.streaming.panes import bought_in_windows


def _watermarked(df: DataFrame, delay: str | None) -> DataFrame:
    return df.withWatermark("timestamp", delay) if df.isStreaming and delay else df


def _divides(slide: str, duration: str) -> bool:
    """Whether windows of `duration` are known to consist of whole slides."""
    part, whole = interval_seconds(slide), interval_seconds(duration)
    return bool(part and whole) and whole % part == 0


def _windowed(
    df: DataFrame, keys: list[str], duration: str, slide: str | None, delay: str | None
) -> DataFrame:
    """Orders and their amount per window and keys, as `window`, the keys, `orders` and `amount`."""
    counted = [F.count("*").alias("orders"), F.sum("total_price").alias("amount")]
    if not slide:
        return _watermarked(df, delay).groupBy(F.window("timestamp", duration).alias("window"), *keys).agg(*counted)
    if df.isStreaming or not _divides(slide, duration):
        rows = _watermarked(df, delay)
        return rows.groupBy(F.window("timestamp", duration, slide).alias("window"), *keys).agg(*counted)
    # Count each row once, in the tumbling window of one slide, and copy the counts instead of the rows
    # into the overlapping windows. A stream cannot aggregate twice in its update and complete modes.
    panes = df.groupBy(F.window("timestamp", slide).alias("pane"), *keys).agg(*counted)
    return panes.groupBy(F.window("pane.start", duration, slide).alias("window"), *keys).agg(
        F.sum("orders").alias("orders"), F.sum("amount").alias("amount")
    )


def popular_products(
    df: DataFrame, duration: str = "30 seconds", slide: str | None = None, delay: str | None = "30 seconds"
) -> DataFrame:
    """Orders and sales per window and product; a `slide` makes the windows overlap."""
    return _windowed(df, ["product_name"], duration, slide, delay).select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "product_name",
        F.col("orders").alias("order_count"),
        F.col("amount").alias("total_sales"),
    )


def suspicious_ips(
    df: DataFrame,
    duration: str = "1 minute",
    slide: str | None = None,
    limit: int = 10,
    products: bool = False,
    delay: str | None = "1 minute",
) -> DataFrame:
    """Addresses with at least `limit` orders in a window, and what they spent.

    With `products`, each row also lists the bought products (see `product_lists`). That form is for
    tables; a stream hands on `ip_products`, and its sink does the rest.
    """
    if products and df.isStreaming:
        raise ValueError("on a stream use ip_products, and suspicious_ip_products in the sink")
    alerts = (
        _windowed(df, ["ip_address"], duration, slide, delay)
        .filter(F.col("orders") >= limit)
        .select(
            F.col("window.start").alias("window_start"),
            "ip_address",
            F.col("orders").alias("order_count"),
            F.col("amount").alias("total_spent"),
        )
    )
    if not products:
        return alerts
    return product_lists(_of_alerts(ip_products(df, duration, slide), alerts))


def ip_products(
    df: DataFrame, duration: str = "1 minute", slide: str | None = None, delay: str | None = "1 minute"
) -> DataFrame:
    """How many `copies` of each product an address bought in a window, and what it spent on them.

    On a stream this is for append mode, which hands on all rows of a window in one batch; where windows consist of
    whole slides, its state is a row for each pane, address and product (see `bought_in_windows`).
    """
    whole = isinstance(df.schema["total_price"].dataType, (ByteType, ShortType, IntegerType, LongType))
    if df.isStreaming and delay and whole and _divides(slide or duration, duration):
        return bought_in_windows(df, duration, slide or duration, delay)
    return _windowed(df, ["ip_address", "product_name"], duration, slide, delay).select(
        F.col("window.start").alias("window_start"),
        "ip_address",
        "product_name",
        F.col("orders").alias("copies"),
        F.col("amount").alias("spent"),
    )


def _of_alerts(bought: DataFrame, alerts: DataFrame) -> DataFrame:
    """What the addresses of `alerts` bought, a row for each product, with the totals of the alert.

    A join, so that what a hot address bought can be dealt to several tasks. Null addresses are no alerts.
    """
    rows = bought.select("window_start", "ip_address", "product_name", "copies").join(alerts, ["window_start", "ip_address"])
    return rows.select("window_start", "ip_address", "order_count", "total_spent", "product_name", "copies")


def suspicious_ip_products(bought: DataFrame, limit: int = 10) -> DataFrame:
    """The rows of `ip_products` of addresses with at least `limit` orders in the window, and their totals.

    This is the whole list of an alert whatever its length: a row for each different product and its copies.
    """
    totals = bought.groupBy("window_start", "ip_address").agg(
        F.sum("copies").alias("order_count"), F.sum("spent").alias("total_spent")
    )
    return _of_alerts(bought, totals.filter(F.col("order_count") >= limit))


def product_lists(bought: DataFrame) -> DataFrame:
    """One row for each alert of `suspicious_ip_products`, its products as an array of name and copies, by name.

    An entry stands for all copies of a product, so the array grows with the different products of an alert,
    not with its orders. Orders without a product name count in the totals and have no entry.
    """
    runs = F.sort_array(F.collect_list(F.struct("product_name", "copies")))
    named = F.filter("products", lambda run: run["product_name"].isNotNull())
    alert = ["window_start", "ip_address", "order_count", "total_spent"]
    return bought.groupBy(*alert).agg(runs.alias("products")).withColumn("products", named)


def realtime_stats(
    df: DataFrame,
    duration: str = "30 seconds",
    delay: str | None = "30 seconds",
    enrich: bool = False,
    limit: int = 10,
) -> DataFrame:
    """Orders, sales and average order value of each window, under the end of the window.

    The average is cut to a whole amount. `suspicious_ip_count` is 0, or with `enrich` the number of
    addresses with at least `limit` orders in the window; on a stream that needs append mode.
    """
    rows = _watermarked(df, delay)
    window = F.window("timestamp", duration).alias("window")
    orders, sales = F.count("*").alias("total_orders"), F.sum("total_price").alias("total_sales")
    priced = F.count("total_price").alias("priced")
    if enrich:
        per_ip = rows.groupBy(window, "ip_address").agg(orders, sales, priced)
        suspicious = F.count_if(F.col("ip_address").isNotNull() & (F.col("total_orders") >= limit))
        # The counts per address carry the names of their sums, so the filter must see them first.
        grouped = per_ip.groupBy("window").agg(
            suspicious.alias("suspicious_ip_count"),
            F.sum("total_orders").alias("total_orders"),
            F.sum("total_sales").alias("total_sales"),
            F.sum("priced").alias("priced"),
        )
    else:
        grouped = rows.groupBy(window).agg(orders, sales, priced).withColumn("suspicious_ip_count", F.lit(0))
    return grouped.select(
        F.col("window.end").alias("stat_time"),
        "total_orders",
        "total_sales",
        # Whole-number division is exact where an average held as a double would round.
        F.expr("total_sales div priced").alias("avg_order_value"),
        "suspicious_ip_count",
    )


def throughput(df: DataFrame, interval: str = "1 second", block: str | Sequence[str] = "1 day") -> DataFrame:
    """Orders per interval, the running total, and the average rate per second since the first interval.

    For a table. Intervals without orders have no row. `block` is that of `running_total`: what one task sums.
    """
    sent = df.groupBy(F.window("timestamp", interval).alias("window")).agg(F.count("*").alias("sent"))
    sent = sent.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "sent")
    # The first interval comes from the times alone, which reads one column and sorts nothing.
    begun = df.agg(F.min("timestamp").alias("first")).select(F.window("first", interval)["start"]).scalar()
    rated = running_total(sent, "sent", "window_start", "total_sent", block=block)
    rate = F.col("total_sent") / seconds_between(begun, F.col("window_end"))
    return rated.select("window_start", "sent", "total_sent", rate.alias("avg_rate"))
