"""Running values over long series, split by time block.

A running sum or a look at the previous row needs the rows before it, which would put a whole series
into one task. Both split the series into time blocks instead: one small row per block is carried
forward and put in front of the next block's rows, and each block is then worked on its own.

A row without a time has no place in a series: it stays, its running value is null, and it counts for no other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _blocked(df: DataFrame, time: str, block: str) -> DataFrame:
    return df.withColumn("_block", F.window(time, block)["start"])


def _led_by(rows: DataFrame, carries: DataFrame) -> DataFrame:
    """The rows of each block with the block's `_carry` as one more row; that column is null on the others.

    A union, not a join: the rows are shuffled once, and null keys need no special comparison.
    """
    return rows.unionByName(carries.filter(F.col("_carry").isNotNull()), allowMissingColumns=True)


def _with_timeless(placed: DataFrame, df: DataFrame, time: str) -> DataFrame:
    """The rows of `placed`, and those of `df` that have no time."""
    added = placed.columns[-1]
    kind = placed.schema[added].dataType
    return placed.unionByName(df.filter(F.col(time).isNull()).withColumn(added, F.lit(None).cast(kind)))


def _levels(block: str | Sequence[str]) -> tuple[str, list[str]]:
    """The finest block and the coarser ones above it."""
    blocks = [block] if isinstance(block, str) else list(block)
    return blocks[-1], blocks[:-1]


def running_total(
    df: DataFrame,
    value: str,
    time: str,
    alias: str,
    partition_by: list[str] | None = None,
    ties: list[str] | None = None,
    block: str | Sequence[str] = "1 day",
) -> DataFrame:
    """Adds the sum of `value` up to and including each row, in the order of `time` and `ties`.

    `block` may name several lengths, coarse to fine: a series with very many fine blocks then has their
    sums added up by coarse block in turn. A row without a time has a null sum and adds to no other.
    """
    keys = list(partition_by or [])
    finest, coarser = _levels(block)
    rows = _blocked(df.filter(F.col(time).isNotNull()), time, finest)
    sums = rows.groupBy(*keys, "_block").agg(F.sum(value).alias("_sum"))
    if coarser:
        sums = sums.withColumnRenamed("_block", "_start")
        upto_block = running_total(sums, "_sum", "_start", "_upto", keys, block=coarser)
        before, start = F.col("_upto") - F.coalesce("_sum", F.lit(0)), F.col("_start")
    else:
        upto_block, start = sums, F.col("_block")
        earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        before = F.sum("_sum").over(earlier)
    carries = upto_block.select(*keys, start.alias("_block"), before.alias("_carry"))
    upto = (
        Window.partitionBy(*keys, "_block")
        .orderBy(F.col("_carry").isNull(), time, *(ties or []))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    total = F.coalesce(F.sum(F.coalesce("_carry", value)).over(upto), F.lit(0))
    led = _led_by(rows, carries).withColumn(alias, total)
    placed = led.filter(F.col("_carry").isNull()).select(*df.columns, alias)
    return _with_timeless(placed, df, time)


def with_previous(
    df: DataFrame,
    columns: list[str],
    order_by: list[str],
    partition_by: list[str] | None = None,
    block: str | Sequence[str] = "1 hour",
) -> DataFrame:
    """Adds `previous`, a struct of the columns in the row before, null on the first row of a series.

    The first of `order_by` is a time; the rest settle the order of equal times. `block` is as in
    `running_total`. A row without a time has a null `previous` and is previous to none.
    """
    keys = list(partition_by or [])
    finest, coarser = _levels(block)
    rows = _blocked(df.filter(F.col(order_by[0]).isNotNull()), order_by[0], finest)
    state = F.struct(*columns)
    # A plain time keeps the aggregate on hashed buffers; a struct of columns makes it sort.
    order = F.col(order_by[0]) if len(order_by) == 1 else F.struct(*order_by)
    last = rows.groupBy(*keys, "_block").agg(*[F.max_by(c, order).alias(c) for c in columns])
    if coarser:
        last = last.withColumnRenamed("_block", "_start")
        carries = with_previous(last, columns, ["_start"], keys, coarser).select(
            *keys, F.col("_start").alias("_block"), F.col("previous").alias("_carry")
        )
    else:
        before = F.lag(state).over(Window.partitionBy(*keys).orderBy("_block"))
        carries = last.select(*keys, "_block", before.alias("_carry"))
    within = Window.partitionBy(*keys, "_block").orderBy(F.col("_carry").isNull(), *order_by)
    led = _led_by(rows, carries).withColumn("previous", F.lag(F.coalesce("_carry", state)).over(within))
    placed = led.filter(F.col("_carry").isNull()).select(*df.columns, "previous")
    return _with_timeless(placed, df, order_by[0])
