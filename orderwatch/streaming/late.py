"""Orders that come after their window has closed, kept beside the windows of those that come in time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructField, StructType, TimestampType

from orderwatch.streaming.packed import ROWS, frame, packing, unpack
from orderwatch.streaming.running import ddl, with_instants, with_micros
from orderwatch.streaming.sinks import Sink

TIME = "timestamp"
END = "window_end"


class Lateness(StatefulProcessor):
    """Hands on the orders whose window the watermark of the batch has closed, or those it has not. Keeps no state."""

    def __init__(self, late: bool):
        self.late = late

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        closed = timerValues.getCurrentWatermarkInMs()
        for some in rows:
            for end, packed in zip(some[END].tolist(), some[ROWS], strict=True):
                if (end // 1000 <= closed) == self.late:
                    yield self.handed_on(unpack(packed), end)

    def handed_on(self, orders: pa.Table, end: int) -> pd.DataFrame:
        return frame(orders)

    def close(self) -> None:
        pass


class OnTime(Lateness):
    """The orders in time, their time the last moment of their window, which is never behind the watermark."""

    def handed_on(self, orders: pa.Table, end: int) -> pd.DataFrame:
        last = pa.repeat(pa.scalar(end - 1, pa.timestamp("us", "UTC")), orders.num_rows)
        return frame(orders.set_column(orders.column_names.index(TIME), TIME, last))


def _dealt(keys: int, first: int):
    """Packs the orders of a task by window, and deals them to keys in turn, from `first` on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = first + TaskContext.get().partitionId()
        for part in packing([END])(batches):
            key = pa.array((turn + np.arange(part.num_rows)) % keys, pa.int64())
            turn += part.num_rows
            yield pa.RecordBatch.from_arrays([key, *part.columns], names=["_key", *part.schema.names])

    return run


def windows_and_late(
    orders: DataFrame, build: Callable[[DataFrame], DataFrame], duration: str, delay: str, keys: int = 64
) -> DataFrame:
    """Closed windows of the orders that come in time, and the orders that come too late. For append mode.

    `build` makes tumbling windows of `duration` over `timestamp`, without a watermark of its own; its orders have the
    last moment of their window as their time. Columns: `window`, a row of `build`, or null; `late`, an order as it
    came, or null. An order is late if the watermark, `delay` behind the newest time of the batches before, has passed
    the end of its window; every order is in a window or late, and none in both. Orders without a time are in neither.
    The orders of a task are packed by window and dealt to `keys` keys in turn; nothing is kept for a key.
    """
    marked = orders.withWatermark(TIME, delay).filter(F.col(TIME).isNotNull())
    ended = marked.withColumn("_window_end", F.window(TIME, duration)["end"])
    plain = with_micros(ended).withColumnRenamed("_window_end", END)

    def dealt(first: int):
        """Dealt differently for each branch: one that reuses the other's exchange would not see the watermark."""
        return plain.mapInArrow(_dealt(keys, first), f"_key long, {END} long, {ROWS} binary").groupBy("_key")

    names, schema = orders.columns, with_micros(orders).schema
    late = dealt(0).transformWithStateInPandas(Lateness(True), ddl(schema), "append", "EventTime")
    late = with_instants(late, orders.schema)
    timed = StructType([StructField(TIME, TimestampType()) if f.name == TIME else f for f in schema])
    on_time = dealt(1).transformWithStateInPandas(OnTime(False), timed, "append", "EventTime", eventTimeColumnName=TIME)
    windows = build(with_instants(on_time, StructType([f for f in orders.schema if f.name != TIME])))
    nothing = F.lit(None)
    window, order = F.struct(*windows.columns), F.struct(*names)
    return windows.select(window.alias("window"), nothing.cast(late.select(order).schema[0].dataType).alias("late")).unionByName(
        late.select(nothing.cast(windows.select(window).schema[0].dataType).alias("window"), order.alias("late"))
    )


def divided(windows: Sink, late: Sink) -> Sink:
    """Hands the windows of a batch of `windows_and_late` to one sink and the late orders to another."""

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            windows(kept.filter("window IS NOT NULL").select("window.*"), batch_id)
            late(kept.filter("late IS NOT NULL").select("late.*"), batch_id)
        finally:
            kept.unpersist()

    return write
