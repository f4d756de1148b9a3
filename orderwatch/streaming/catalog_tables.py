"""The output tables as tables of the session's catalog, which fill the columns that a batch does not name."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderwatch.schemas import OUTPUT_TABLES, to_contract
from orderwatch.streaming.sinks import Sink

#: Bits of an id for the row within a task's share of a batch, and for the task.
ROW_BITS, TASK_BITS = 26, 14


def create_tables(spark: SparkSession, database: str, tables: Iterable[str] = OUTPUT_TABLES, location: str = "") -> list[str]:
    """Creates the output tables that do not exist yet; returns their full names.

    Each has the columns of its contract, `id`, `created_at`, which the table fills with the time of the insert, and
    `batch_id`, by which it is stored. `location` is a folder for a new database.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}" + (f" LOCATION '{location}'" if location else ""))
    names = []
    for table in tables:
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in OUTPUT_TABLES[table])
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{table} (id BIGINT, {columns},"
            " created_at TIMESTAMP DEFAULT current_timestamp(), batch_id BIGINT) USING parquet PARTITIONED BY (batch_id)"
        )
        names.append(f"{database}.{table}")
    return names


def _id(batch_id: int) -> Column:
    """A whole number for each row of a batch, larger than all of the batches before."""
    mark = F.monotonically_increasing_id()  # the task above 33 bits, the row within it below
    task, row = F.shiftright(mark, 33), mark.bitwiseAND(F.lit((1 << 33) - 1))
    fits = (task < 1 << TASK_BITS) & (row < 1 << ROW_BITS)
    number = F.lit(batch_id << (TASK_BITS + ROW_BITS)) + F.shiftleft(task, ROW_BITS) + row
    return F.when(fits, number).otherwise(F.raise_error(F.lit("more rows than a batch has ids")))


def catalog_sink(database: str, table: str) -> Sink:
    """Adds each batch to a table of `create_tables`, naming the columns of its contract only.

    Spark's parquet tables have no numbers of their own, so the sink gives the ids: unique, and growing from batch to
    batch, with gaps. `created_at` comes from the table. A repeated batch replaces itself; one without rows adds nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, view = batch.sparkSession, f"batch_{uuid.uuid4().hex}"
        rows = to_contract(batch, OUTPUT_TABLES[table]).hint("rebalance").withColumn("id", _id(batch_id))
        rows.createOrReplaceTempView(view)
        columns = ", ".join(rows.columns)
        try:
            spark.sql(
                f"INSERT OVERWRITE TABLE {database}.{table} PARTITION (batch_id = {batch_id}) ({columns})"
                f" SELECT {columns} FROM {view}"
            )
        finally:
            spark.catalog.dropTempView(view)

    return write
