"""Order rows to and from JSON messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from orderwatch.functions.scalars import instant
from orderwatch.schemas import ORDER_MESSAGE

# Offset and microseconds written out, so that a decoded time equals the encoded one.
JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def decode_orders(raw: DataFrame) -> DataFrame:
    """Message values as the nine order fields. A bad field is null, a bad message is null throughout.

    The parsed struct is unpacked by a generator, which filters on the fields stay above: pushed below
    a plain projection, each filter would bring its own parse of the whole message.
    """
    parsed = F.from_json(F.col("value").cast("string"), ORDER_MESSAGE)
    return raw.select(F.inline(F.array(parsed))).withColumn("timestamp", instant(F.col("timestamp")))


def _undecodable() -> Column:
    return F.col("order_id").isNull() | F.col("timestamp").isNull() | F.col("price").isNull()


def flag_bad_records(df: DataFrame) -> DataFrame:
    """Decoded orders with `undecodable`, for counts of both kinds in one pass."""
    return df.withColumn("undecodable", _undecodable())


def split_bad_records(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Decoded orders with id, time and price, and the rest. Each row is in one of the two.

    For two sinks, each of which reads the messages; where one pass will do, use `flag_bad_records`.
    """
    return df.filter(~_undecodable()), df.filter(_undecodable())


def observe_bad_records(df: DataFrame, name: str = "bad_records") -> DataFrame:
    """The same frame, counting orders and rejects in the pass that reads it anyway.

    The counts appear in `StreamingQueryProgress.observedMetrics[name]` on a stream and through a
    query listener in batch.
    """
    return df.observe(name, F.count(F.lit(1)).alias("orders"), F.count_if(_undecodable()).alias("rejects"))


def encode_orders(df: DataFrame) -> DataFrame:
    """One message per order: the order id as key, the order as JSON value."""
    if isinstance(df.schema["timestamp"].dataType, TimestampNTZType):
        df = df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    fields = F.struct(*[F.col(name) for name in ORDER_MESSAGE.fieldNames()])
    return df.select(
        F.col("order_id").cast("string").alias("key"),
        F.to_json(fields, {"timestampFormat": JSON_TIME}).alias("value"),
    )


def publish_orders(df: DataFrame, options: dict[str, str], checkpoint: str | None = None):
    """Writes orders to a topic. A stream returns its query; without a checkpoint it is refused.

    Batching and compression are producer options: `kafka.linger.ms`, `kafka.batch.size`,
    `kafka.compression.type`.
    """
    if df.isStreaming and not checkpoint:
        raise ValueError("publishing a stream needs a checkpoint")
    messages = encode_orders(df)
    if not df.isStreaming:
        return messages.write.format("kafka").options(**options).save()
    return (
        messages.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint).start()
    )
