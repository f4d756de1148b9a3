"""The rolling count per address on a stream, with its past in Spark's state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from orderwatch.operators.rolling import IP, MICROS, TIME
from orderwatch.streaming.packed import ROWS, frame, pack, packing, unpack, unpack_all
from orderwatch.streaming.sinks import Sink

#: What a row tells a cell: orders of its own, orders of cells that lie wholly in every look-back, or orders of the
#: cell that a look-back begins in.
OWN, BETWEEN, OLDEST = 0, 1, 2
MESSAGE = {"cell": pa.int64(), "role": pa.int32(), "at": pa.int64(), "n": pa.int64()}


def rolling_counts(
    orders: DataFrame, look_back: int = 600, cells: int = 10, lateness: int = 600, ahead: int = 3600, parts: int = 256
) -> DataFrame:
    """A streaming plan over `orders` whose batches `counted` turns into orders with `recent_orders`.

    Columns: `order`, an order as it came, or null; `level`, how many orders an address has in its look-back at one of
    the times it ordered at in this batch, or null.

    `look_back`, `lateness` and `ahead` are in seconds. State is kept by time cell, `cells` to a look-back, and by part, of
    which the addresses fall into `parts` by hash: the orders of the cell by address and time, those of the cell one
    look-back before it, and for each address one sum of what lies between. A key is read and written once in a batch,
    for all its addresses; take several times as many parts as there are state partitions. A hot address is a key for
    each cell, and orders of one address and time are added up in the tasks that read them. A timer drops a cell once the
    watermark, `lateness` behind the newest time, has passed it; a later order opens it again without its past. A time
    more than `ahead` seconds ahead of the clock does not move the watermark, so that one wrong clock does not end the past
    of all others.
    """
    length = look_back * MICROS
    if look_back <= 0 or length % cells:
        raise ValueError(f"no {cells} whole cells in a look-back of {look_back} seconds")
    plausible = F.col(TIME) <= F.current_timestamp() + F.expr(f"INTERVAL {ahead} SECONDS")
    marked = orders.withColumn("_clock", F.when(plausible, F.col(TIME))).withWatermark("_clock", f"{lateness} seconds")
    kind = orders.schema[IP].dataType.simpleString()
    timed = marked.filter(F.col(IP).isNotNull() & F.col(TIME).isNotNull())
    part = F.pmod(F.xxhash64(IP), F.lit(parts)).cast("int").alias("part")
    moments = timed.select(part, F.col(IP).alias("ip"), F.unix_micros(TIME).alias("at"))
    messages = moments.mapInArrow(_to_cells(length // cells, cells), f"part int, cell long, {ROWS} binary")
    levels = messages.groupBy("part", "cell").transformWithStateInPandas(
        CellLevels(length, cells), f"ip {kind}, at long, recent_orders long", "append", "EventTime"
    )
    order = F.struct(*orders.columns)
    nothing = F.lit(None)
    passed = marked.select(order.alias("order"), nothing.cast(levels.select(F.struct("*")).schema[0].dataType).alias("level"))
    return passed.unionByName(
        levels.select(nothing.cast(marked.select(order).schema[0].dataType).alias("order"), F.struct("*").alias("level"))
    )


def counted(sink: Sink) -> Sink:
    """Joins the orders of a batch of `rolling_counts` to their levels and hands them on with `recent_orders`.

    An order is handed on once, in its batch: a late one is counted where it belongs, but does not change counts
    already handed on. An order without address or time has no count.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            orders = kept.filter("order IS NOT NULL").select("order.*")
            levels = kept.filter("level IS NOT NULL").select(
                F.col("level.ip").alias(IP), F.timestamp_micros("level.at").alias(TIME), "level.recent_orders"
            )
            sink(orders.join(levels, [IP, TIME], "left").select(*orders.columns, "recent_orders"), batch_id)
        finally:
            kept.unpersist()

    return write


def _to_cells(width: int, cells: int):
    """Adds orders up by address and time, and sends each sum to its own cell and those that look back on it."""

    def message(part, ip, cell, role, at, n) -> pa.Table:
        columns = {"cell": cell, "role": np.full(len(ip), role), "at": at, "n": n}
        arrays = [pa.array(columns[c], kind) if isinstance(columns[c], np.ndarray) else columns[c].cast(kind) for c, kind in MESSAGE.items()]
        return pa.Table.from_arrays([part, ip, *arrays], names=["part", "ip", *MESSAGE])

    def messages(orders: pa.Table) -> pa.Table:
        moments = orders.group_by(["part", "ip", "at"]).aggregate([([], "count_all")])
        part, ip, at, n = (moments.column(c).combine_chunks() for c in ("part", "ip", "at", "count_all"))
        cell = at.to_numpy() // width
        sent = [message(part, ip, cell, OWN, at, n), message(part, ip, cell + cells, OLDEST, at, n)]
        whole = pa.table({"part": part, "ip": ip, "cell": cell, "n": n}).group_by(["part", "ip", "cell"]).aggregate([("n", "sum")])
        part, ip, cell, n = (whole.column(c).combine_chunks() for c in ("part", "ip", "cell", "n_sum"))
        for further in range(1, cells):
            sent.append(message(part, ip, cell.to_numpy() + further, BETWEEN, pa.nulls(len(ip), pa.int64()), n))
        return pa.concat_tables(sent)

    return packing(["part", "cell"], messages)


class CellLevels(StatefulProcessor):
    """Of the addresses of a part, in one cell: the level at each time that a batch has orders of."""

    def __init__(self, length: int, cells: int):
        self.length, self.cells = length, cells

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.past = handle.getValueState("past", "moments binary, sums binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        past = self.past.get()
        if past is None:
            self.handle.registerTimer(int((key[1] + 1) * (self.length // self.cells) // 1000))
        new = unpack_all(data for some in rows for data in some[ROWS])
        role = new.column("role").to_numpy()
        sums = new.filter(pa.array(role == BETWEEN)).select(["ip", "n"])
        moments = new.select(["ip", "at", "n"]).append_column("wanted", pa.array((role == OWN).astype(np.int8)))
        moments = moments.filter(pa.array(role != BETWEEN))
        if past:
            before = unpack(past[0])
            before = before.append_column("wanted", pa.array(np.zeros(before.num_rows, np.int8)))
            moments, sums = pa.concat_tables([before, moments]), pa.concat_tables([unpack(past[1]), sums])
        moments = moments.group_by(["ip", "at"]).aggregate([("n", "sum"), ("wanted", "max")])
        moments = moments.rename_columns(["ip", "at", "n", "wanted"]).combine_chunks()
        sums = sums.group_by("ip").aggregate([("n", "sum")]).rename_columns(["ip", "n"])
        self.past.update((pack(moments.select(["ip", "at", "n"])), pack(sums)))
        if (role == OWN).any():
            yield frame(self._levels(moments, sums))

    def _levels(self, moments: pa.Table, sums: pa.Table) -> pa.Table:
        """The level at each wanted moment: the orders of the moments a look-back holds, and the sums between."""
        ip, at = moments.column("ip").combine_chunks().dictionary_encode().indices.to_numpy(), moments.column("at").to_numpy()
        order = np.lexsort((at, ip))
        ip, at, n, wanted = ip[order].astype(np.int64), at[order], moments.column("n").to_numpy()[order], moments.column("wanted").to_numpy()[order]
        times = np.unique(at)
        place = ip * (len(times) + 1) + np.searchsorted(times, at)
        upto, found = np.concatenate(([0], np.cumsum(n))), np.flatnonzero(wanted)
        first = np.searchsorted(place, ip[found] * (len(times) + 1) + np.searchsorted(times, at[found] - self.length, side="right"))
        rows = moments.select(["ip", "at"]).take(pa.array(order[found]))
        between = pc.fill_null(sums.column("n").take(pc.index_in(rows.column("ip"), sums.column("ip"))), 0)
        levels = upto[found + 1] - upto[first] + between.to_numpy()
        return rows.append_column("recent_orders", pa.array(levels, pa.int64()))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.past.clear()
        return iter(())

    def close(self) -> None:
        pass
