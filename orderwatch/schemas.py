"""The order message, the metrics record and the four output tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# One JSON order as it travels; the time is ISO-8601 text with an offset.
ORDER_MESSAGE = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("price", T.IntegerType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("ip_address", T.StringType()),
        T.StructField("payment_method", T.StringType()),
    ]
)

# A sample of the host's metrics.
METRICS = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("cpu_percent", T.DoubleType()),
        T.StructField("memory_percent", T.DoubleType()),
        T.StructField("memory_used_mb", T.DoubleType()),
        T.StructField("disk_read_mb", T.DoubleType()),
        T.StructField("disk_write_mb", T.DoubleType()),
        T.StructField("network_sent_mb", T.DoubleType()),
        T.StructField("network_recv_mb", T.DoubleType()),
    ]
)

# The columns of the output tables.
POPULAR_PRODUCTS = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("order_count", T.IntegerType()),
        T.StructField("total_sales", T.LongType()),
    ]
)

SUSPICIOUS_IPS = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("ip_address", T.StringType()),
        T.StructField("order_count", T.IntegerType()),
        T.StructField("total_spent", T.LongType()),
    ]
)

HIGH_VALUE_ORDERS = T.StructType(
    [
        T.StructField("order_time", T.TimestampType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("total_price", T.LongType()),
        T.StructField("ip_address", T.StringType()),
    ]
)

REALTIME_STATS = T.StructType(
    [
        T.StructField("stat_time", T.TimestampType()),
        T.StructField("total_orders", T.IntegerType()),
        T.StructField("total_sales", T.LongType()),
        T.StructField("avg_order_value", T.LongType()),
        T.StructField("suspicious_ip_count", T.IntegerType()),
    ]
)

OUTPUT_TABLES = {
    "popular_products": POPULAR_PRODUCTS,
    "suspicious_ips": SUSPICIOUS_IPS,
    "high_value_orders": HIGH_VALUE_ORDERS,
    "realtime_stats": REALTIME_STATS,
}

# The columns that name one row of each table, for its latest view.
# High-value orders are appended once each and have none.
TABLE_KEYS = {
    "popular_products": ["window_start", "window_end", "product_name"],
    "suspicious_ips": ["window_start", "ip_address"],
    "realtime_stats": ["stat_time"],
}

# The time by which each table is stored and shown.
TABLE_TIMES = {
    "popular_products": "window_start",
    "suspicious_ips": "window_start",
    "high_value_orders": "order_time",
    "realtime_stats": "stat_time",
}

# The captions of the console reports.
CONSOLE_CAPTIONS = {
    "popular_products": {
        "window_start": "시작시간",
        "window_end": "종료시간",
        "product_name": "상품명",
        "order_count": "주문수",
        "total_sales": "총매출",
    },
    "suspicious_ips": {
        "window_start": "시작시간",
        "ip_address": "IP주소",
        "order_count": "주문수",
        "total_spent": "총금액",
        "products": "구매상품",
    },
    "high_value_orders": {
        "order_time": "시간",
        "order_id": "주문ID",
        "product_name": "상품명",
        "quantity": "수량",
        "total_price": "금액",
        "ip_address": "IP",
    },
}


def to_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """The contract's columns, in its order and types. A count too big for its column raises."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in contract])


def with_captions(df: DataFrame, table: str) -> DataFrame:
    """The frame under the captions of the console report, columns without a caption left out."""
    captions = CONSOLE_CAPTIONS[table]
    return df.select(*[F.col(name).alias(caption) for name, caption in captions.items() if name in df.columns])
