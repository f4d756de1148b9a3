"""What a stream carries on from batch to batch: the best rows so far, running totals, the sample before.

State is Spark's, of fixed size for each key but for samples that still wait for their turn. Times are whole microseconds in
state and between Spark and Python.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from orderwatch.functions.scalars import megabytes, seconds_between
from orderwatch.streaming.packed import ROWS, frame, pack, packing, unpack, unpack_all

MILLIS = 1000
EVERYTHING = "all"


def with_micros(df: DataFrame) -> DataFrame:
    """Instants as microseconds, all other columns as they are."""
    return df.select(*[F.unix_micros(f.name).alias(f.name) if f.dataType.typeName() == "timestamp" else f.name for f in df.schema])


def with_instants(df: DataFrame, like: StructType) -> DataFrame:
    """The columns that are instants in `like` as instants again."""
    times = {f.name for f in like if f.dataType.typeName() == "timestamp"}
    return df.select(*[F.timestamp_micros(name).alias(name) if name in times else name for name in df.columns])


def ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def _order(by: str, ties: list[str]) -> Callable:
    """Ranks rows by `by` downwards, then by `ties` upwards, nulls first."""
    return lambda row: (-row[by], *[(row[c] is not None, row[c]) for c in ties])


class BestRows(StatefulProcessor):
    """The best rows so far; all of them are handed on with their ranks whenever one changes."""

    def __init__(self, schema: StructType, by: str, ties: list[str], k: int):
        self.names, self.kind, self.order, self.k = schema.names, ddl(schema), _order(by, ties), k

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getListState("best", self.kind)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        before = [tuple(row) for row in self.best.get()]
        new = [tuple(row[c] for c in self.names) for row in rows]
        named = (dict(zip(self.names, row, strict=True)) for row in before + new)
        best = [tuple(row.values()) for row in heapq.nsmallest(self.k, named, key=self.order)]
        if best != before:
            self.best.put(best)
            for rank, row in enumerate(best, 1):
                yield Row(rank=rank, **dict(zip(self.names, row, strict=True)))

    def close(self) -> None:
        pass


def top_of_stream(closed: DataFrame, by: str, k: int = 5, ties: list[str] | None = None) -> DataFrame:
    """The k largest rows of all that a stream has handed on, with `rank`, each time they change. For append mode.

    `closed` is a stream that hands on a row once, such as an aggregate in append mode; `by` is a whole number in it and
    never null. Ties are settled by `ties`. The newest row of each rank is the answer. A task hands on k rows of a
    batch, and state is k rows for good, while complete mode keeps every window.
    """
    ties = ties or ["window_start", "product_name"]
    plain = with_micros(closed)
    schema, order = plain.schema, _order(by, ties)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            held = heapq.nsmallest(k, held + batch.to_pylist(), key=order)
            kind = batch.schema
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=kind)

    few = plain.mapInArrow(best, schema).withColumn("_of", F.lit(EVERYTHING))
    processor = BestRows(schema, by, ties, k)
    ranked = few.groupBy("_of").transformWithState(processor, f"rank int, {ddl(schema)}", "append", "None")
    return with_instants(ranked, closed.schema)


class RunningTotal(StatefulProcessor):
    """Adds up what closed intervals sent, in order of time."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.so_far = handle.getValueState("so_far", "total long, begun long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        total, begun = self.so_far.get() or (0, None)
        for row in sorted(rows, key=lambda row: row.window_start):
            total, begun = total + row.sent, row.window_start if begun is None else begun
            yield Row(window_start=row.window_start, window_end=row.window_end, sent=row.sent, total_sent=total, begun=begun)
        self.so_far.update((total, begun))

    def close(self) -> None:
        pass


def throughput_stream(df: DataFrame, interval: str = "1 second", delay: str = "10 seconds") -> DataFrame:
    """Orders per interval, the running total and the average rate, as intervals close. For append mode.

    The columns of `throughput`. An interval closes when the watermark, `delay` behind the newest time, passes its end;
    intervals close in order of time, so the total carried along is that of all before. One row per interval reaches it.
    """
    window = F.window("timestamp", interval)
    sent = df.withWatermark("timestamp", delay).groupBy(window.alias("window")).agg(F.count("*").alias("sent"))
    closed = sent.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "sent")
    kind = "window_start long, window_end long, sent long, total_sent long, begun long"
    keyed = with_micros(closed).withColumn("_of", F.lit(EVERYTHING)).groupBy("_of")
    rated = keyed.transformWithState(RunningTotal(), kind, "append", "None")
    rated = rated.withColumns({c: F.timestamp_micros(c) for c in ("window_start", "window_end", "begun")})
    rate = F.col("total_sent") / seconds_between(F.col("begun"), F.col("window_end"))
    return rated.select("window_start", "sent", "total_sent", rate.alias("avg_rate"))


class Series(StatefulProcessor):
    """Samples of the series of a part in order of time, each with the one before it in its series."""

    def __init__(self, names: list[str], counters: list[str], order_by: list[str], partition_by: list[str], grid: int):
        self.names, self.counters, self.order_by, self.partition_by, self.grid = names, counters, order_by, partition_by, grid

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", f"{ROWS} binary")
        self.last = handle.getValueState("last", f"{ROWS} binary")

    def _turns(self, rows: pa.Table) -> np.ndarray:
        """When a sample of this time is handed on, in milliseconds: at the next line of the grid."""
        return -(-rows.column(self.order_by[0]).to_numpy() // (self.grid * MILLIS)) * self.grid

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        new = unpack_all(data for some in rows for data in some[ROWS])
        turns, closed = self._turns(new), timerValues.getCurrentWatermarkInMs()
        new = new.filter(pa.array(turns > closed))
        if new.num_rows:
            self.waiting.appendList([(pack(new),)])
            self.handle.registerTimer(int(turns[turns > closed].min()))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        """Hands on all whose turn has come, so that one timer for the first of those that wait is enough."""
        packed = [row[0] for row in self.waiting.get()]
        if not packed:
            return
        rows = unpack_all(packed)
        turns = self._turns(rows)
        due = turns <= max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        if not due.any():
            return
        if due.all():
            self.waiting.clear()
        else:
            self.waiting.put([(pack(rows.filter(pa.array(~due))),)])
            self.handle.registerTimer(int(turns[~due].min()))
        yield frame(self._with_before(rows.filter(pa.array(due))))

    def _with_before(self, due: pa.Table) -> pa.Table:
        kept = list(dict.fromkeys([*self.partition_by, *self.counters]))
        last, now = self.last.get(), pa.array(np.ones(due.num_rows, bool))
        rows = due.append_column("_due", now)
        if last:
            before = unpack(last[0])
            rows = pa.concat_tables([before.append_column("_due", pa.array(np.zeros(before.num_rows, bool))), rows], promote_options="default")
        series = [f"_series{i}" for i in range(len(self.partition_by))]
        for name, column in zip(series, self.partition_by, strict=True):
            codes = rows.column(column).combine_chunks().dictionary_encode(null_encoding="encode").indices
            rows = rows.append_column(name, codes)
        keys = [(name, "ascending") for name in [*series, "_due", *self.order_by]]
        rows = rows.take(pc.sort_indices(rows, sort_keys=keys, null_placement="at_start")).combine_chunks()
        same = np.ones(rows.num_rows, bool)
        same[0] = False
        for name in series:
            codes = rows.column(name).to_numpy()
            same[1:] &= codes[1:] == codes[:-1]
        self.last.update((pack(rows.filter(pa.array(np.append(~same[1:], True))).select(kept)),))
        previous = pa.array(np.arange(-1, rows.num_rows - 1), mask=~same)
        for name in self.counters:
            rows = rows.append_column(f"{name}_before", rows.column(name).take(previous))
        return rows.filter(rows.column("_due")).select([*self.names, *[f"{name}_before" for name in self.counters]])

    def close(self) -> None:
        pass


def counter_delta_stream(
    df: DataFrame,
    counters: list[str],
    order_by: list[str],
    partition_by: list[str],
    delay: str = "1 minute",
    grid_seconds: int = 60,
    parts: int = 256,
) -> DataFrame:
    """Adds for each cumulative byte counter its growth since the previous sample, in MB. For append mode.

    The first of `order_by` is the time of a sample, an instant; samples without one are left out, and so are those that
    come after their turn. A sample waits until the watermark, `delay` behind the newest time, has passed the next line
    of a grid of `grid_seconds`, so that those that come out of order fall into place. State is the counters of one sample
    for each series and the samples that wait, packed by part, of which the series fall into `parts` by hash; a batch reads
    and writes a part once. The first of a series has no growth.
    """
    time = order_by[0]
    marked = df.withWatermark(time, delay).filter(F.col(time).isNotNull())
    plain = with_micros(marked)
    before = ", ".join(f"`{c}_before` {plain.schema[c].dataType.simpleString()}" for c in counters)
    dealt = plain.withColumn("_part", F.pmod(F.xxhash64(*partition_by), F.lit(parts)).cast("int"))
    keyed = dealt.mapInArrow(packing(["_part"]), f"_part int, {ROWS} binary").groupBy("_part")
    processor = Series(plain.columns, counters, order_by, partition_by, grid_seconds * MILLIS)
    found = keyed.transformWithStateInPandas(processor, f"{ddl(plain.schema)}, {before}", "append", "EventTime")
    deltas = {f"{c}_delta_mb": megabytes(F.col(c) - F.col(f"{c}_before")) for c in counters}
    return with_instants(found, df.schema).withColumns(deltas).drop(*[f"{c}_before" for c in counters])
