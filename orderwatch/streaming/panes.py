"""What addresses bought in windows that overlap, each order kept once: in the pane of one slide."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from orderwatch.functions.scalars import interval_seconds
from orderwatch.streaming.packed import HELD, ROWS, frame, pack, packing, unpack, unpack_all

PART, PANE, START = "part", "pane", "window_start"
BOUGHT = ["ip_address", "product_name"]
SUMS = ["copies", "spent"]
MICROS, MILLIS = 1_000_000, 1000


def _added_up(rows: pa.Table, keys: list[str]) -> pa.Table:
    """The sums of each key. One that is no long any more is an error, as it is in Spark."""
    spent = rows.column("spent")
    most = max((abs(value) for value in pc.min_max(spent).as_py().values() if value is not None), default=0)
    if most * rows.num_rows >= 2**63:
        rows = rows.set_column(rows.column_names.index("spent"), "spent", spent.cast(pa.decimal128(38, 0)))
    found = rows.group_by(keys).aggregate([(name, "sum") for name in SUMS]).rename_columns([*keys, *SUMS])
    return found.set_column(found.column_names.index("spent"), "spent", found.column("spent").cast(pa.int64()))


def _dealt(parts: int):
    """Packs what a task has of each part, added up, and for every part without orders a table without rows."""

    def bought(orders: pa.Table) -> pa.Table:
        one = pa.repeat(pa.scalar(1, pa.int64()), orders.num_rows)
        return _added_up(orders.append_column("copies", one), [PART, PANE, *BOUGHT])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = False
        for packed in packing([PART], bought)(batches):
            if not told:
                others = np.setdiff1d(np.arange(parts, dtype=np.int32), packed.column(PART).to_numpy())
                nothing = pack(unpack(packed.column(ROWS)[0].as_py()).slice(0, 0))
                columns = [pa.array(others), pa.array([nothing] * len(others), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=[PART, ROWS])
                told = True
            yield packed

    return run


class PaneSums(StatefulProcessor):
    """The addresses of a part, by pane. Hands on the windows that close, and keeps panes until their last window has.

    A part has always one timer, for the next end of a window after the watermark it has seen; with it, it knows of each
    window whether an earlier batch has closed it, whatever orders it got by then.
    """

    def __init__(self, slide: int, duration: int):
        self.slide, self.duration = slide, duration

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getListState("sums", f"{ROWS} binary")
        self.marks = handle.getValueState("marks", "closed long, whole long, added long")

    def _wait(self, closed: int) -> None:
        """Sets the timer for the next end of a window; a timer is due when the watermark has reached its time."""
        end = (closed * MILLIS // self.slide + 1) * self.slide
        self.handle.registerTimer(-(-end // MILLIS))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        marks = self.marks.get()
        closed, whole, added = marks or (0, 0, 0)
        if marks is None:
            self._wait(closed)
        new = unpack_all(data for some in rows for data in some[ROWS])
        new = self._open(new, closed)
        if new.num_rows:
            packed = pack(_added_up(new, [PANE, *BOUGHT]))
            self.sums.appendList([(packed,)])
            added += len(packed)
            if added > whole > 0:
                whole, added = self._put(self._kept()), 0
            elif not whole:
                whole, added = added, 0
        if new.num_rows or marks is None:
            self.marks.update((closed, whole, added))
        return iter(())

    def _open(self, rows: pa.Table, closed: int) -> pa.Table:
        """The rows of panes that a window not closed yet lies over."""
        return rows.filter(pc.greater(rows.column(PANE), closed * MILLIS - self.duration))

    def _kept(self) -> pa.Table | None:
        packed = [row[0] for row in self.sums.get()]
        return _added_up(unpack_all(packed), [PANE, *BOUGHT]) if packed else None

    def _put(self, rows: pa.Table) -> int:
        packed = pack(rows)
        self.sums.put([(packed,)])
        return len(packed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        before, now = self.marks.get()[0], timerValues.getCurrentWatermarkInMs()
        self._wait(now)
        rows, whole = self._kept(), 0
        if rows is not None:
            yield from self._windows(rows, before * MILLIS, now * MILLIS)
            rows = self._open(rows, now)
            if rows.num_rows:
                whole = self._put(rows)
            else:
                self.sums.clear()
        self.marks.update((now, whole, 0))

    def _windows(self, rows: pa.Table, before: int, now: int) -> Iterator[pd.DataFrame]:
        """The windows that end after `before` and not after `now`, some at a time."""
        pane = rows.column(PANE).to_numpy()
        order = np.argsort(pane, kind="stable")
        rows, pane = rows.drop_columns([PANE]), pane[order]
        starts = np.unique(np.subtract.outer(np.unique(pane), np.arange(0, self.duration, self.slide)))
        ends = starts + self.duration
        starts = starts[(ends > before) & (ends <= now)]
        if not len(starts):
            return
        first, last = np.searchsorted(pane, starts), np.searchsorted(pane, starts + self.duration)
        chunk = np.cumsum(last - first) // HELD
        for some in np.split(np.arange(len(starts)), np.flatnonzero(np.diff(chunk)) + 1):
            sizes = last[some] - first[some]
            places = np.arange(sizes.sum()) + np.repeat(first[some] - (np.cumsum(sizes) - sizes), sizes)
            table = rows.take(pa.array(order[places])).append_column(START, pa.array(np.repeat(starts[some], sizes)))
            yield frame(_added_up(table, [START, *BOUGHT]))

    def close(self) -> None:
        pass


def bought_in_windows(df: DataFrame, duration: str, slide: str, delay: str, parts: int = 256) -> DataFrame:
    """`ip_products` of a stream, whose windows consist of whole slides. For append mode.

    State is a row for each pane, address and product, packed by part, of which the addresses fall into `parts` by hash;
    what a batch adds is put behind it, and all is added up again when that has doubled it or a window closes. As in
    Spark's own windows, an order counts in those of its windows that no earlier batch has closed; one that is late for all
    is left out, and is not among the rows that Spark reports as dropped.
    """
    marked = df.withWatermark("timestamp", delay)
    pane = F.window("timestamp", slide).alias("window")
    kinds = {name: df.schema[name].dataType.simpleString() for name in BOUGHT}
    rows = marked.select(pane, *BOUGHT, "total_price").select(
        F.pmod(F.xxhash64("ip_address"), F.lit(parts)).cast("int").alias(PART),
        F.unix_micros("window.start").alias(PANE),
        *BOUGHT,
        F.col("total_price").cast("long").alias("spent"),
    )
    dealt = rows.mapInArrow(_dealt(parts), f"{PART} int, {ROWS} binary").groupBy(PART)
    processor = PaneSums(interval_seconds(slide) * MICROS, interval_seconds(duration) * MICROS)
    bought = ", ".join([f"{START} long", *[f"{name} {kind}" for name, kind in kinds.items()], "copies long, spent long"])
    found = dealt.transformWithStateInPandas(processor, bought, "append", "EventTime")
    return found.select(F.timestamp_micros(START).alias(START), *BOUGHT, *SUMS)
