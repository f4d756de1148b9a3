"""Statistics of windows that are still open, with the addresses that order too often, in update mode."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from orderwatch.streaming.packed import ROWS, pack, packing, unpack, unpack_all

PART = "window_start long, window_end long, part int, orders long, sales long, priced long, suspicious long"
#: What names a row of `live_stats`; the newest row of each is the answer.
PART_KEYS = ["window_start", "window_end", "part"]


class WindowPart(StatefulProcessor):
    """Some addresses of one window: their orders, and how many of them have reached the limit."""

    def __init__(self, limit: int):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.orders = handle.getValueState("orders", f"{ROWS} binary")
        self.totals = handle.getValueState("totals", "orders long, sales long, priced long, suspicious long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        start, end, part = key
        if end // 1000 <= timerValues.getCurrentWatermarkInMs():
            return  # the window is closed
        totals = self.totals.get()
        if totals is None:
            self.handle.registerTimer(end // 1000)
        orders, sales, priced, suspicious = totals or (0, 0, 0, 0)
        new = unpack_all(row[ROWS] for row in rows)
        orders, sales, priced = (
            before + (pc.sum(new.column(name)).as_py() or 0)
            for before, name in zip((orders, sales, priced), ("n", "amount", "priced"), strict=True)
        )
        new = new.filter(pc.is_valid(new.column("ip"))).select(["ip", "n"])
        if new.num_rows:
            suspicious += self._crossed(new)
        self.totals.update((orders, sales, priced, suspicious))
        yield Row(
            window_start=start, window_end=end, part=part, orders=orders, sales=sales, priced=priced, suspicious=suspicious
        )

    def _crossed(self, new: pa.Table) -> int:
        """Adds orders to those of their addresses, and counts the addresses that reach the limit by it."""
        kept = self.orders.get()
        known = unpack(kept[0]) if kept else new.slice(0, 0)
        both = pa.concat_tables([known.append_column("before", known.column("n")), new.append_column("before", pa.repeat(pa.scalar(0, pa.int64()), new.num_rows))])
        now = both.group_by("ip").aggregate([("n", "sum"), ("before", "sum")]).rename_columns(["ip", "n", "before"])
        self.orders.update((pack(now.select(["ip", "n"])),))
        crossed = pc.and_(pc.less(now.column("before"), self.limit), pc.greater_equal(now.column("n"), self.limit))
        return pc.sum(crossed).as_py()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        self.orders.clear()
        self.totals.clear()
        return iter(())

    def close(self) -> None:
        pass


KEYS = ["window_start", "window_end", "part"]


def _added_up(rows: pa.Table) -> pa.Table:
    """Orders of a task by window and address."""
    found = rows.group_by([*KEYS, "ip"]).aggregate([([], "count_all"), ("amount", "sum"), ("amount", "count")])
    return found.rename_columns([*KEYS, "ip", "n", "amount", "priced"])


def live_stats(
    df: DataFrame, duration: str = "30 seconds", delay: str = "30 seconds", limit: int = 10, parts: int = 16
) -> DataFrame:
    """Parts of the statistics of windows, handed on each time they change; `stats_of_parts` adds them up.

    For update mode. The addresses of a window are dealt to `parts` keys, so that a busy window is many keys; an address
    is added up in each task before that. State is a number for each address of an open window, packed by part, and the
    sums of a part, which a batch reads and writes once, gone when the watermark passes the end. An address that crosses the limit changes its part, which is then handed
    on again in place of the one before. Orders of closed windows are left out.
    """
    window = F.window("timestamp", duration)
    rows = df.withWatermark("timestamp", delay).select(window.alias("window"), F.col("ip_address").alias("ip"), "total_price")
    rows = rows.select(
        F.unix_micros("window.start").alias("window_start"),
        F.unix_micros("window.end").alias("window_end"),
        F.pmod(F.xxhash64("ip"), F.lit(parts)).cast("int").alias("part"),
        "ip",
        F.col("total_price").cast("long").alias("amount"),
    )
    packed = rows.mapInArrow(packing(KEYS, _added_up), f"window_start long, window_end long, part int, {ROWS} binary")
    found = packed.groupBy(*KEYS).transformWithState(WindowPart(limit), PART, "update", "EventTime")
    return found.withColumns({c: F.timestamp_micros(c) for c in ("window_start", "window_end")})


def stats_of_parts(parts: DataFrame) -> DataFrame:
    """The statistics of each window from the newest row of each of its parts; the columns of `realtime_stats`."""
    summed = parts.groupBy("window_end").agg(
        F.sum("orders").alias("total_orders"),
        F.sum("sales").alias("sales"),
        F.sum("priced").alias("priced"),
        F.sum("suspicious").alias("suspicious_ip_count"),
    )
    sales = F.when(F.col("priced") > 0, F.col("sales"))
    return summed.select(
        F.col("window_end").alias("stat_time"),
        "total_orders",
        sales.alias("total_sales"),
        F.when(F.col("priced") > 0, F.expr("sales div priced")).alias("avg_order_value"),
        "suspicious_ip_count",
    )
