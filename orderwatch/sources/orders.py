"""Readers of order messages and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderwatch.schemas import METRICS

MESSAGE_FILE = "key BINARY, value BINARY"


def read_orders(
    spark: SparkSession,
    fmt: str = "kafka",
    options: dict[str, str] | None = None,
    streaming: bool = True,
) -> DataFrame:
    """Order messages as one binary column `value`, from a topic or from files.

    fmt "kafka" needs the options `kafka.bootstrap.servers` and `subscribe`; a stream starts at the
    latest offset unless `startingOffsets` says otherwise, and goes on from its checkpoint after that.
    fmt "json" reads one order per line, "parquet" reads published key and value columns; both need
    the option `path`. Limits per trigger (`maxOffsetsPerTrigger`, `maxFilesPerTrigger`) pass through.
    """
    options = dict(options or {})
    reader = spark.readStream if streaming else spark.read
    if fmt == "kafka":
        if streaming:
            options.setdefault("startingOffsets", "latest")
        return reader.format("kafka").options(**options).load().select("value")
    path = options.pop("path")
    if fmt == "json":
        return reader.format("text").options(**options).load(path).select(F.col("value").cast("binary").alias("value"))
    if fmt == "parquet":
        return reader.schema(MESSAGE_FILE).format("parquet").options(**options).load(path).select("value")
    raise ValueError(f"unknown order source {fmt!r}: use kafka, json or parquet")


def read_metrics_csv(spark: SparkSession, path: str) -> DataFrame:
    """Metrics samples with a header line and a declared schema, so that no pass infers types."""
    return spark.read.schema(METRICS).option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
