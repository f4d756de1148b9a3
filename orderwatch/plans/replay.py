"""Tables run through the streaming queries, their output read back as a table."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderwatch.functions.scalars import with_total_price
from orderwatch.session import SETTINGS
from orderwatch.sources.codec import decode_orders, encode_orders
from orderwatch.sources.feeds import orders_from_events
from orderwatch.sources.orders import read_orders
from orderwatch.streaming.folders import remove
from orderwatch.streaming.jobs import ONCE, start
from orderwatch.streaming.sinks import Sink, changelog, read_changelog


TURNS = 4


def run_folder(spark: SparkSession) -> str:
    """A new folder for one run in the shared checkpoint folder; beside the warehouse's tables where none is named."""
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_replays"
    return f"{root}/replay-{uuid.uuid4().hex}"


def stream_session(spark: SparkSession) -> SparkSession:
    """A session of the same application for streaming queries, in UTC, leaving the caller's settings alone."""
    session = spark.newSession()
    for name, value in SETTINGS.items():
        session.conf.set(name, value)
    # One state partition per core; stateful stages are not resized at run time.
    session.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return session


def turns(spark: SparkSession, sf_dir: str, count: int = TURNS) -> list[Column]:
    """Conditions on `ts` that cut the events into `count` stretches of time, off every full hour."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    step = (last - first) / count
    cuts = [(first + i * step).replace(minute=37, second=11, microsecond=0) for i in range(1, count)]
    edges = [None, *[F.lit(cut).cast("timestamp_ntz") for cut in cuts], None]
    time = F.col("ts").cast("timestamp_ntz")
    whole = F.lit(True)
    return [
        (whole if low is None else time >= low) & (whole if high is None else time < high)
        for low, high in zip(edges, edges[1:], strict=False)
    ]


def event_stream(session: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """The events published under `folder` as a stream of orders. Their times become instants, as watermarks need."""
    events = session.readStream.schema(schema).parquet(f"{folder}/*")
    return with_total_price(orders_from_events(events)).withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def published(spark: SparkSession, sf_dir: str, folder: str, cuts: list[Column] | None = None) -> Iterator[StructType]:
    """Publishes the events stretch by stretch, in order of time or by `cuts`, and stops after each; gives their schema."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    for number, turn in enumerate(cuts or turns(spark, sf_dir)):
        events.filter(turn).write.parquet(f"{folder}/{number}")
        yield events.schema


def without_zone(df: DataFrame) -> DataFrame:
    """Instants as the zoneless times they came from, whatever zone the reading session has."""
    times = [f.name for f in df.schema if f.dataType.typeName() == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in times})


def replay(
    spark: SparkSession,
    sf_dir: str,
    build: Callable[[DataFrame], DataFrame],
    mode: str,
    wrap: Callable[[str, Sink], Sink] | None = None,
    output: Callable[[DataFrame], DataFrame] | None = None,
    cuts: list[Column] | None = None,
) -> DataFrame:
    """Runs one query over all events and reads back everything it handed on, with batch ids.

    The events come in TURNS stretches of time, cut within windows, or as `cuts` on `ts` says. After each the query works off what is new and
    ends, and the next starts on its checkpoint. `wrap` puts another sink before the change log, given a folder for
    its own use; `output` then gives the change log's columns from those of the query.
    """
    root, session = run_folder(spark), stream_session(spark)
    log = changelog(f"{root}/changes")
    sink = lambda batch, batch_id: log(without_zone(batch), batch_id)
    sink = wrap(f"{root}/kept", sink) if wrap else sink
    for schema in published(spark, sf_dir, f"{root}/in", cuts):
        plan = build(event_stream(session, f"{root}/in", schema))
        start(uuid.uuid4().hex, plan, mode, sink, f"{root}/checkpoint", ONCE).awaitTermination()
    kinds = without_zone(output(plan) if output else plan).schema
    remove(spark, f"{root}/in")
    remove(spark, f"{root}/checkpoint")
    remove(spark, f"{root}/kept")
    return read_changelog(spark, f"{root}/changes", kinds)


def replay_messages(
    spark: SparkSession,
    sf_dir: str,
    build: Callable[[DataFrame], DataFrame],
    mode: str,
    turns: list[Column],
) -> DataFrame:
    """Runs one query over events published as messages, some at a time, and reads back its change log.

    Each turn publishes the orders it holds for, starts the query on the checkpoint the turn before left,
    and lets it run to its end.
    """
    root = run_folder(spark)
    session = stream_session(spark)
    published = orders_from_events(session.read.parquet(f"{sf_dir}/events.parquet"))
    log = changelog(f"{root}/changes")
    for number, turn in enumerate(turns):
        messages = encode_orders(published.filter(turn))
        messages.select(*[F.col(c).cast("binary").alias(c) for c in messages.columns]).write.parquet(
            f"{root}/topic/{number}"
        )
        orders = decode_orders(read_orders(session, "parquet", {"path": f"{root}/topic/*"}))
        plan = without_zone(build(with_total_price(orders)))
        start(uuid.uuid4().hex, plan, mode, log, f"{root}/checkpoint", ONCE).awaitTermination()
    return read_changelog(spark, f"{root}/changes", plan.schema)
