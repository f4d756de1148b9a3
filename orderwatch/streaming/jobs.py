"""Starting, running and stopping the streaming queries."""

from __future__ import annotations

import threading
import time
from collections import Counter, defaultdict, deque
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from orderwatch.operators.ranking import top_overall
from orderwatch.operators.rules import high_value_display, high_value_orders
from orderwatch.operators.windows import ip_products, popular_products, realtime_stats, suspicious_ips
from orderwatch.schemas import OUTPUT_TABLES, to_contract
from orderwatch.streaming.rolling import counted, rolling_counts
from orderwatch.streaming.sinks import Sink, adaptively, judged, report, suspicious_report

ONCE = "once"


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return root


def start(
    name: str,
    df: DataFrame,
    mode: str,
    sink: Sink,
    checkpoint: str,
    trigger: str | None = None,
) -> StreamingQuery:
    """Starts one named query with its own checkpoint.

    `trigger` is an interval such as "30 seconds", "once" to work off what is there and stop, or None
    to begin a batch as soon as the last one ends.
    """
    closing = threading.Event()
    writer = (
        df.writeStream.queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(_unless(closing, adaptively(sink)))
    )
    if trigger == ONCE:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    query = writer.start()
    CLOSING[query.runId] = closing
    return query


class Drained(Exception):
    """A batch that began after its query was told to end."""


#: Set for a run of a query that is to begin no further batch.
CLOSING: dict[str, threading.Event] = {}


def _unless(closing: threading.Event, sink: Sink) -> Sink:
    def write(batch: DataFrame, batch_id: int) -> None:
        if closing.is_set():
            raise Drained(f"batch {batch_id} waits for the next start")
        sink(batch, batch_id)

    return write


@dataclass(frozen=True)
class Query:
    """A streaming query before it starts: its plan over the orders, its output mode, its pace."""

    build: Callable[[DataFrame], DataFrame]
    mode: str
    trigger: str | None


# The queries that fill the output tables. Update mode hands on a window each time it changes.
TABLE_QUERIES: Mapping[str, Query] = {
    "popular_products": Query(popular_products, "update", "30 seconds"),
    "suspicious_ips": Query(suspicious_ips, "update", "30 seconds"),
    "high_value_orders": Query(high_value_orders, "append", None),
    "realtime_stats": Query(realtime_stats, "update", "30 seconds"),
}

# The console reports, over windows that overlap.
REPORT_QUERIES: Mapping[str, Query] = {
    "popular_products": Query(
        lambda orders: popular_products(orders, slide="10 seconds"), "complete", "10 seconds"
    ),
    "suspicious_ips": Query(
        lambda orders: ip_products(orders, slide="30 seconds"), "append", "30 seconds"
    ),
    "high_value_orders": Query(high_value_display, "append", None),
}


def fan_out(
    job: str,
    orders: DataFrame,
    queries: Mapping[str, Query],
    sinks: Mapping[str, Sink],
    checkpoints: str,
    trigger: str | None = None,
) -> list[StreamingQuery]:
    """Starts every query over the same orders. Each reads the source itself and keeps its own progress."""
    return [
        start(
            f"{job}_{name}",
            query.build(orders),
            query.mode,
            sinks[name],
            f"{checkpoints}/{name}",
            trigger or query.trigger,
        )
        for name, query in queries.items()
    ]


def run_tables(
    orders: DataFrame,
    sinks: Mapping[str, Sink],
    checkpoints: str | None = None,
    trigger: str | None = None,
    queries: Mapping[str, Query] = TABLE_QUERIES,
) -> list[StreamingQuery]:
    """The four table queries, each cut to its table's columns and types before its sink."""
    root = checkpoints or f"{checkpoint_root(orders.sparkSession)}/tables"

    def typed(name: str) -> Query:
        query = queries[name]
        contract = OUTPUT_TABLES[name]
        return Query(lambda df: to_contract(query.build(df), contract), query.mode, query.trigger)

    return fan_out("tables", orders, {name: typed(name) for name in queries}, sinks, root, trigger)


def run_reports(
    orders: DataFrame,
    checkpoints: str | None = None,
    trigger: str | None = None,
    out: Callable[[str], None] = print,
) -> list[StreamingQuery]:
    """The three console reports: top products, suspicious addresses, high-value orders."""
    root = checkpoints or f"{checkpoint_root(orders.sparkSession)}/reports"
    sinks = {
        "popular_products": report(
            "Popular products, top 5",
            5,
            order=lambda df: top_overall(df, "order_count"),
            captions="popular_products",
            out=out,
        ),
        "suspicious_ips": suspicious_report("Suspicious addresses", 20, empty="no suspicious address", out=out),
        "high_value_orders": report("High-value orders", 20, counted=True, out=out),
    }
    return fan_out("reports", orders, REPORT_QUERIES, sinks, root, trigger)


def run_alerts(
    orders: DataFrame,
    sink: Sink,
    checkpoints: str | None = None,
    look_back: int = 600,
    limit: int = 10,
    threshold: int = 500_000,
    trigger: str | None = None,
    cells: int = 10,
) -> list[StreamingQuery]:
    """A verdict for every order: too many orders from its address in the look-back, high value, or normal.

    All verdicts go to `sink`. The orders of the past are state of the query, in its checkpoint.
    """
    root = checkpoints or f"{checkpoint_root(orders.sparkSession)}/alerts"
    plan = rolling_counts(orders, look_back, cells)
    judge = counted(judged(sink, limit, threshold))
    return [start("alerts_verdicts", plan, "append", judge, f"{root}/verdicts", trigger)]


class Watch(StreamingQueryListener):
    """What the queries of a session do, by query name: rows dropped as too late, and the last batches.

    A batch is (batch id, start, rows read, orders and rejects of `observe_bad_records`, or null without it). `kept`
    batches of a query are held.
    """

    def __init__(self, kept: int = 1000) -> None:
        self.dropped: Counter[str | None] = Counter()
        self.batches: defaultdict[str | None, deque] = defaultdict(lambda: deque(maxlen=kept))

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        self.dropped[progress.name] += sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)
        counts = progress.observedMetrics.get("bad_records")
        orders, rejects = (counts.orders, counts.rejects) if counts else (None, None)
        batch = (progress.batchId, progress.timestamp, progress.numInputRows, orders, rejects)
        self.batches[progress.name].append(batch)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


def watch(spark: SparkSession) -> Watch:
    """Watches all queries of the session from now on."""
    listener = Watch()
    spark.streams.addListener(listener)
    return listener


def unwatch(spark: SparkSession, listener: Watch) -> None:
    """Ends watching, once what has happened so far has been heard."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    spark.streams.removeListener(listener)


def drain(queries: Iterable[StreamingQuery], poll_seconds: float = 0.05) -> None:
    """Ends queries that `start` began, each after the batch that it is in, so that no work is thrown away.

    A batch that begins meanwhile is turned away before its sink, and done first after a restart; the query then ends
    with `Drained` as its error.
    """
    waiting = list(queries)
    for query in waiting:
        if query.runId in CLOSING:
            CLOSING[query.runId].set()
    while waiting:
        for query in list(waiting):
            if not query.isActive or not query.status["isTriggerActive"]:
                query.stop()
                waiting.remove(query)
        if waiting:
            time.sleep(poll_seconds)


def await_any(spark: SparkSession) -> None:
    """Waits until one query ends, raising its error if it failed, and then stops the others.

    An interrupt stops them too, each after the batch that it is in.
    """
    try:
        spark.streams.awaitAnyTermination()
    except KeyboardInterrupt:
        drain(spark.streams.active)
    finally:
        for query in spark.streams.active:
            query.stop()
