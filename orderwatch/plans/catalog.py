"""Every operator as a query over the test tables: name -> (spark, folder of the tables) -> result.

The tables are sparse, so windows are hours and days here and limits are lower than the defaults.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderwatch import schemas
from orderwatch.functions import scalars
from orderwatch.functions.scalars import with_total_price
from orderwatch.operators import metrics, ranking, rolling, rules, windows
from orderwatch.operators.prefix import running_total
from orderwatch.plans import dashboard, views
from orderwatch.plans.replay import (
    event_stream,
    published,
    replay,
    replay_messages,
    run_folder,
    stream_session,
    turns,
    without_zone,
)
from orderwatch.sources import codec, feeds
from orderwatch.sources.orders import read_metrics_csv
from orderwatch.streaming import jobs, sinks
from orderwatch.streaming.catalog_tables import catalog_sink, create_tables
from orderwatch.streaming.late import divided, windows_and_late
from orderwatch.streaming.live import PART_KEYS, live_stats, stats_of_parts
from orderwatch.streaming.rolling import counted, rolling_counts
from orderwatch.streaming.running import counter_delta_stream, throughput_stream, top_of_stream

Query = Callable[[SparkSession, str], DataFrame]

FROM, TO = "2024-01-05", "2024-01-20"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_total_price(feeds.event_orders(spark, sf_dir))


def _line_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_total_price(feeds.lineitem_orders(spark, sf_dir))


def _popular(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.popular_products(_orders(spark, sf_dir), "6 hours")


def _popular_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.popular_products(_orders(spark, sf_dir), "6 hours", "2 hours")


def _suspicious(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.suspicious_ips(_orders(spark, sf_dir), "1 day", limit=5)


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.realtime_stats(_orders(spark, sf_dir), "6 hours")


def _rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling.rolling_ip_count(_orders(spark, sf_dir), "1 day", cells=24)


# Messages.


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec.encode_orders(feeds.event_orders(spark, sf_dir)).select(F.col("value").cast("binary").alias("value"))


def decode_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_zone(codec.decode_orders(_messages(spark, sf_dir)))


def bad_record_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors are sent cut off after a few characters, so that they are no JSON any more."""
    text = F.col("value").cast("string")
    broken = F.get_json_object(text, "$.product_name") == "error"
    sent = F.when(broken, F.substring(text, 1, 12)).otherwise(text).cast("binary")
    flagged = codec.flag_bad_records(codec.decode_orders(_messages(spark, sf_dir).select(sent.alias("value"))))
    kind = F.when(F.col("undecodable"), "rejects").otherwise(F.col("product_name")).alias("product_name")
    return flagged.groupBy(kind).agg(F.count("*").alias("orders"), F.sum("price").alias("price"))


def orders_encode_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = codec.encode_orders(feeds.event_orders(spark, sf_dir))
    field = {
        name: F.get_json_object("value", f"$.{name}")
        for name in ("order_id", "timestamp", "product_name", "price", "quantity", "ip_address")
    }
    return messages.select(
        "key",
        field["order_id"].alias("order_id"),
        F.to_timestamp(field["timestamp"]).cast("timestamp_ntz").alias("order_time"),
        field["product_name"].alias("product_name"),
        field["price"].cast("int").alias("price"),
        field["quantity"].cast("int").alias("quantity"),
        field["ip_address"].alias("ip_address"),
    )


# Projections, filters, scalars.


def total_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).select("order_id", "price", "quantity", "total_price")


def high_value_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.high_value_orders(_orders(spark, sf_dir))


def high_value_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.high_value_display(_orders(spark, sf_dir))


def having_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _popular(spark, sf_dir).filter(F.col("order_count") >= 20)


def window_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    popular = _popular(spark, sf_dir).withColumn("total_sales", scalars.money_text(F.col("total_sales")))
    return schemas.with_captions(popular, "popular_products")


def constant_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stats(spark, sf_dir).select("stat_time", "suspicious_ip_count")


def order_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rolling.order_verdict(_rolling(spark, sf_dir), limit=5)
    return judged.select("order_id", "recent_orders", "total_price", "verdict")


def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    time = F.col("timestamp")
    return _orders(spark, sf_dir).select(
        "order_id",
        scalars.wall_text(time).alias("time_text"),
        scalars.money_text(F.col("total_price")).alias("amount_text"),
        scalars.megabytes(F.col("total_price")).alias("mb"),
        (time - F.expr("INTERVAL 10 MINUTES")).alias("cutoff"),
    )


def session_timezone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instants and times without zone, shown in Seoul by a session that runs in New York."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "America/New_York")
    plain = F.col("timestamp").cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), plain)
    instant = F.timestamp_micros(micros)
    return _orders(session, sf_dir).select(
        "order_id",
        scalars.wall_time(plain, "Asia/Seoul").alias("seoul_time"),
        scalars.wall_time(instant, "Asia/Seoul").alias("seoul_time_of_instant"),
    )


# Aggregates over windows.


def agg_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _popular(spark, sf_dir).select("window_start", "product_name", "order_count")


def agg_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _popular(spark, sf_dir).select("window_start", "product_name", "total_sales")


def agg_avg_truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stats(spark, sf_dir).select("stat_time", "avg_order_value")


def _listed(rows: DataFrame) -> DataFrame:
    runs = F.transform("products", lambda run: F.concat(run["product_name"], F.lit(" x"), run["copies"]))
    return rows.withColumn("products", F.array_join(runs, ","))


def agg_collect_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every address of a day, with what it bought."""
    bought = windows.suspicious_ip_products(windows.ip_products(_orders(spark, sf_dir), "1 day"), limit=1)
    return _listed(windows.product_lists(bought))


def popular_products_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = _popular_sliding(spark, sf_dir).withColumn("total_sales", scalars.money_text(F.col("total_sales")))
    return ranking.sort_desc(shown, "order_count", ["window_start", "product_name"])


def suspicious_ips_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = windows.suspicious_ips(_orders(spark, sf_dir), "1 day", "6 hours", 5, products=True)
    return _listed(alerts).withColumn("total_spent", scalars.money_text(F.col("total_spent")))


def suspicious_ips_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.suspicious_ips(_line_orders(spark, sf_dir), "1 day", limit=2)


def realtime_stats_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.realtime_stats(_orders(spark, sf_dir), "1 day", enrich=True, limit=5)


def tumbling_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.popular_products(_line_orders(spark, sf_dir), "1 day")


def sliding_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.popular_products(_line_orders(spark, sf_dir), "3 days", "1 day")


# Rolling counts, ranking.


def rolling_ip_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rolling(spark, sf_dir).select("order_id", "ip_address", "timestamp", "recent_orders")


def rolling_ip_count_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = rolling.rolling_ip_count(_line_orders(spark, sf_dir), "7 days", cells=1)
    return counted.select("order_id", "ip_address", "timestamp", "recent_orders")


def rolling_ip_count_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = rolling.rolling_ip_count(_line_orders(spark, sf_dir), "7 days", "arrival", cells=1)
    return counted.select("order_id", "ip_address", "timestamp", "recent_orders")


def sort_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.sort_desc(_popular(spark, sf_dir), "order_count", ["window_start", "product_name"])


def top5_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_overall(_popular(spark, sf_dir), "order_count")


def top5_per_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = windows.popular_products(_line_orders(spark, sf_dir), "1 day")
    return ranking.top_per_window(daily, "order_count")


# Reports.


def counter_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir).select("order_id", "timestamp", "user_id", "quantity")
    counted = running_total(orders, "quantity", "timestamp", "sent_bytes", ["user_id"], ["order_id"])
    deltas = metrics.counter_delta(counted, ["sent_bytes"], ["timestamp", "order_id"], ["user_id"], block="1 day")
    return deltas.select("order_id", "sent_bytes", "sent_bytes_delta_mb")


def throughput_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = windows.throughput(feeds.event_orders(spark, sf_dir), "1 hour")
    return report.withColumn("avg_rate", F.round("avg_rate", 9))


def delivery_success_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.success_rate(feeds.event_orders(spark, sf_dir), F.col("product_name") == "error")


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the shape of metrics samples, under the event type as load level."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    value, k = F.col("value"), F.from_json("props", "k INT")["k"].cast("double")
    return events.select(
        F.col("event_type").alias("level"),
        F.col("ts").alias("timestamp"),
        k.alias("cpu_percent"),
        (k / 2).alias("memory_percent"),
        (k * 64).alias("memory_used_mb"),
        (k / 8).alias("disk_read_mb"),
        value.alias("disk_write_mb"),
        (k / 4).alias("network_sent_mb"),
        (k / 4).alias("network_recv_mb"),
    )


def load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = metrics.load_summary(_samples(spark, sf_dir), "level")
    averages = ["avg_cpu", "avg_memory", "avg_memory_mb"]
    return summary.withColumns({name: F.round(name, 9) for name in averages})


def metrics_csv_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples written as CSV with a header and read back by the source."""
    path = f"{run_folder(spark)}/metrics"
    rows = _samples(spark, sf_dir).drop("level").withColumn("timestamp", scalars.wall_text(F.col("timestamp")))
    rows.write.option("header", True).csv(path)
    return without_zone(read_metrics_csv(spark, path))


def output_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """High-value orders in the types of their table, written and read back."""
    path = f"{run_folder(spark)}/high_value_orders"
    contract = schemas.HIGH_VALUE_ORDERS
    schemas.to_contract(rules.high_value_orders(_orders(spark, sf_dir)), contract).write.parquet(path)
    return without_zone(spark.read.schema(contract).parquet(path))


def output_tables_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """High-value orders of a stream in a catalog table, which has filled the columns that the batches do not name."""
    database = f"shop_{uuid.uuid4().hex}"
    create_tables(spark, database, ["high_value_orders"], f"{run_folder(spark)}/{database}")
    sink = catalog_sink(database, "high_value_orders")
    replay(spark, sf_dir, rules.high_value_orders, "append", wrap=lambda _, log: sinks.both(log, sink))
    rows = spark.table(f"{database}.high_value_orders")
    numbered = F.count_distinct("id") == F.count(F.lit(1))
    filled = rows.agg(numbered, F.bool_and(F.col("created_at").isNotNull())).first()
    shown = rows.drop("id", "created_at", "batch_id")
    return without_zone(shown.withColumns({"numbered": F.lit(filled[0]), "timed": F.lit(filled[1])}))


#: Rows of a published file, so that many tasks write and read a batch.
FILE_ROWS = 100_000


def shutdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a listener heard of a stream of messages that was drained in its first batch and then went on.

    One batch for each of four folders, which have the same number of files; some orders are cut off, so that they are
    rejects.
    """
    root, session = run_folder(spark), stream_session(spark)
    stretches = turns(spark, sf_dir)
    sizes = spark.read.parquet(f"{sf_dir}/events.parquet").agg(*[F.count_if(turn) for turn in stretches]).first()
    # Each file has many more rows than there are files, so that dealing in turn leaves none of them out.
    files = max(1, min(sizes) // FILE_ROWS)
    text = F.col("value").cast("string")
    broken = F.get_json_object(text, "$.product_name") == "error"
    for number, turn in enumerate(stretches):
        events = spark.read.parquet(f"{sf_dir}/events.parquet").filter(turn)
        messages = codec.encode_orders(feeds.orders_from_events(events)).select(F.col("value").cast("binary").alias("value"))
        sent = messages.select(F.when(broken, F.substring(text, 1, 12)).otherwise(text).cast("binary").alias("value"))
        sent.repartition(files).write.parquet(f"{root}/topic/{number}")
    source = session.readStream.schema("value binary").option("maxFilesPerTrigger", files).parquet(f"{root}/topic/*")
    orders = codec.observe_bad_records(codec.decode_orders(source))
    heard, name, log = jobs.watch(session), uuid.uuid4().hex, sinks.changelog(f"{root}/changes")
    jobs.drain([jobs.start(name, orders, "append", log, f"{root}/checkpoint", "1 second")])
    jobs.start(name, orders, "append", log, f"{root}/checkpoint", jobs.ONCE).awaitTermination()
    jobs.unwatch(session, heard)
    facts = [(i, orders, rejects) for i, _, rows, orders, rejects in heard.batches[name] if rows]
    batches = spark.createDataFrame(facts, "batch_id long, orders long, rejects long")
    kept = spark.read.parquet(f"{root}/changes").agg(F.count_distinct("order_id")).first()[0]
    return batches.withColumn("decoded", F.lit(kept).cast("bigint"))


def compacted_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window results in four batches: without sales, some of it whole, compacted, more of it, and a tail."""
    root = run_folder(spark)
    popular = schemas.to_contract(_popular(spark, sf_dir), schemas.POPULAR_PRODUCTS)
    log = sinks.changelog(f"{root}/popular_products")
    late = F.col("window_start") >= F.lit("2024-01-16").cast("timestamp")
    log(popular.withColumn("total_sales", F.lit(0).cast("bigint")), 0)
    log(popular.filter(~late), 1)
    views.compact_tables(spark, root, ["popular_products"])
    log(popular.filter(late).withColumn("order_count", F.lit(0)), 2)
    views.compact_tables(spark, root, ["popular_products"])
    log(popular.filter(late), 3)
    return without_zone(views.latest_table(spark, root, "popular_products").drop("day"))


# Dashboard panels, over the view of a stream's change log, compacted after its second turn.


def _shown(spark: SparkSession, sf_dir: str, name: str, build: Callable[[DataFrame], DataFrame], mode: str) -> DataFrame:
    root, session = run_folder(spark), stream_session(spark)
    contract = schemas.OUTPUT_TABLES[name]
    for number, schema in enumerate(published(spark, sf_dir, f"{root}/in")):
        plan = schemas.to_contract(build(event_stream(session, f"{root}/in", schema)), contract)
        sink = sinks.changelog(f"{root}/{name}")
        jobs.start(uuid.uuid4().hex, plan, mode, sink, f"{root}/checkpoint", jobs.ONCE).awaitTermination()
        if number == 1:
            views.compact_tables(spark, root, [name])
    return without_zone(views.latest_table(spark, root, name, FROM, TO))


def _shown_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(spark, sf_dir, "realtime_stats", lambda orders: windows.realtime_stats(orders, "6 hours"), "update")


def dash_order_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counted(dashboard.order_series(_shown_stats(spark, sf_dir), FROM, TO))


def dash_sales_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.sales_series(_shown_stats(spark, sf_dir), FROM, TO)


def dash_suspicious_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    build = lambda orders: windows.realtime_stats(orders, "1 day", enrich=True, limit=5)
    rows = dashboard.suspicious_series(_shown(spark, sf_dir, "realtime_stats", build, "append"), FROM, TO)
    return rows.withColumn("suspicious_ip_count", F.col("suspicious_ip_count").cast("bigint"))


def _counted(rows: DataFrame) -> DataFrame:
    """Counts as they are before they take the type of their table."""
    return rows.withColumns({c: F.col(c).cast("bigint") for c in ("total_orders", "order_count") if c in rows.columns})


def dash_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    build = lambda orders: windows.popular_products(orders, "6 hours")
    return dashboard.top_products(_shown(spark, sf_dir, "popular_products", build, "update"), FROM, TO)


def dash_suspicious_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    build = lambda orders: windows.suspicious_ips(orders, "1 day", limit=5)
    shown = dashboard.suspicious_table(_shown(spark, sf_dir, "suspicious_ips", build, "update"), FROM, TO)
    return _counted(shown).withColumn("ip_address", F.col("ip_address").cast("bigint")).drop("day")


def dash_high_value_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _shown(spark, sf_dir, "high_value_orders", rules.high_value_orders, "append")
    return dashboard.high_value_count(rows, FROM, TO)


# Streaming runs over all events.


def _latest(changes: DataFrame, table: str) -> DataFrame:
    return sinks.latest(changes, schemas.TABLE_KEYS[table])


def stream_popular_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = replay(spark, sf_dir, lambda orders: windows.popular_products(orders, "6 hours"), "update")
    return _latest(changes, "popular_products")


def stream_suspicious_ips(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = replay(spark, sf_dir, lambda orders: windows.suspicious_ips(orders, "1 day", limit=5), "update")
    return _latest(changes, "suspicious_ips")


def stream_high_value_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay(spark, sf_dir, rules.high_value_orders, "append").drop("batch_id")


def stream_realtime_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = replay(spark, sf_dir, lambda orders: windows.realtime_stats(orders, "6 hours"), "update")
    return _latest(changes, "realtime_stats")


def stream_realtime_stats_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append mode: the windows the watermark has closed."""
    build = lambda orders: windows.realtime_stats(orders, "6 hours", enrich=True, limit=3)
    return replay(spark, sf_dir, build, "append").drop("batch_id")


def stream_suspicious_ips_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append mode: the windows the watermark has closed, with the lists of products."""
    build = lambda orders: windows.ip_products(orders, "1 day", "6 hours")
    closed = replay(spark, sf_dir, build, "append").drop("batch_id")
    return _listed(windows.product_lists(windows.suspicious_ip_products(closed, 5)))


def stream_top5_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete mode hands on every window each time, so the newest row of each is the whole answer."""
    build = lambda orders: windows.popular_products(orders, "6 hours", "2 hours")
    changes = replay(spark, sf_dir, build, "complete")
    return ranking.top_overall(_latest(changes, "popular_products"), "order_count")


def stream_decode_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    def coded(orders: DataFrame) -> DataFrame:
        messages = codec.encode_orders(orders).select(F.col("value").cast("binary").alias("value"))
        return codec.decode_orders(messages)

    return replay(spark, sf_dir, coded, "append").drop("batch_id")


def stream_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages published in two turns, the query restarted in between, in the middle of a window."""
    second = F.col("timestamp") >= F.lit("2024-01-16 03:00:00").cast("timestamp_ntz")
    build = lambda orders: windows.popular_products(orders, "6 hours")
    return _latest(replay_messages(spark, sf_dir, build, "update", [~second, second]), "popular_products")


def stream_late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first half of the month arrives after the second: its windows are closed, and it is dropped."""
    second = F.col("timestamp") >= F.lit("2024-01-16").cast("timestamp_ntz")
    build = lambda orders: windows.popular_products(orders, "6 hours")
    return _latest(replay_messages(spark, sf_dir, build, "update", [second, ~second]), "popular_products")


def _divided(spark: SparkSession, sf_dir: str, of_windows: bool) -> DataFrame:
    """The second half of the month, then the first, which is late; the closed windows, or the late orders."""
    second = F.col("ts").cast("timestamp_ntz") >= F.lit("2024-01-16").cast("timestamp_ntz")
    popular = lambda orders: windows.popular_products(orders, "6 hours", delay=None)
    ignored = lambda batch, batch_id: None
    return replay(
        spark,
        sf_dir,
        lambda orders: windows_and_late(orders, popular, "6 hours", "1 minute"),
        "append",
        wrap=lambda _, sink: divided(sink, ignored) if of_windows else divided(ignored, sink),
        output=lambda plan: plan.select("window.*" if of_windows else "late.*"),
        cuts=[second, ~second],
    ).drop("batch_id")


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The late orders themselves."""
    return _divided(spark, sf_dir, False).select("order_id", "timestamp", "product_name", "total_price")


def stream_windows_beside_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The closed windows of the orders that came in time."""
    return _divided(spark, sf_dir, True)


def stream_top5_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best of the windows that are closed, from state of five rows."""
    build = lambda orders: top_of_stream(windows.popular_products(orders, "6 hours"), "order_count")
    return sinks.latest(replay(spark, sf_dir, build, "append"), ["rank"])


def stream_top5_per_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two best of each window as it closes."""
    return replay(
        spark,
        sf_dir,
        lambda orders: windows.popular_products(orders, "6 hours", "2 hours"),
        "append",
        wrap=lambda _, sink: sinks.ranked(sink, "order_count", 2),
        output=lambda popular: popular.withColumn("rank", F.lit(0)),
    ).drop("batch_id")


def stream_stats_enriched_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update mode: open windows too, handed on again when an address crosses the limit."""
    parts = replay(spark, sf_dir, lambda orders: live_stats(orders, "1 day", limit=5, parts=4), "update")
    return stats_of_parts(sinks.latest(parts, PART_KEYS))


def stream_counter_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order's price as the sample of a counter of its user."""

    def build(orders: DataFrame) -> DataFrame:
        samples = orders.select("order_id", "timestamp", "user_id", F.col("price").cast("bigint").alias("sent_bytes"))
        return counter_delta_stream(samples, ["sent_bytes"], ["timestamp", "order_id"], ["user_id"])

    return replay(spark, sf_dir, build, "append").select("order_id", "sent_bytes", "sent_bytes_delta_mb")


def stream_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = replay(spark, sf_dir, lambda orders: throughput_stream(orders, "1 hour"), "append").drop("batch_id")
    return report.withColumn("avg_rate", F.round("avg_rate", 9))


def stream_rolling_ip_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["order_id", "ip_address", "timestamp"]
    return replay(
        spark,
        sf_dir,
        lambda orders: rolling_counts(orders.select(*columns), look_back=24 * 3600, cells=2, parts=32),
        "append",
        wrap=lambda _, sink: counted(sink),
        output=lambda plan: plan.select("order.*", "level.recent_orders"),
    ).drop("batch_id")


def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alerts job over all events, with a day to look back on."""
    root, session = run_folder(spark), stream_session(spark)
    for schema in published(spark, sf_dir, f"{root}/in"):
        orders = event_stream(session, f"{root}/in", schema)
        sink = sinks.changelog(f"{root}/verdicts")
        for query in jobs.run_alerts(orders, sink, f"{root}/alerts", 24 * 3600, limit=5, trigger=jobs.ONCE, cells=2):
            query.awaitTermination()
    verdicts = spark.read.parquet(f"{root}/verdicts")
    return verdicts.select("order_id", "recent_orders", "total_price", "verdict")


FAN_OUT = {
    "popular_products": lambda orders: windows.popular_products(orders, "6 hours"),
    "suspicious_ips": lambda orders: windows.suspicious_ips(orders, "1 day", limit=5),
    "high_value_orders": rules.high_value_orders,
    "realtime_stats": lambda orders: windows.realtime_stats(orders, "6 hours"),
}


def stream_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four table queries at once over one stream, with wider windows; rows and amount of each table."""
    root, session = run_folder(spark), stream_session(spark)
    logs = {name: sinks.changelog(f"{root}/{name}") for name in schemas.OUTPUT_TABLES}
    wider = {name: replace(jobs.TABLE_QUERIES[name], build=build) for name, build in FAN_OUT.items()}
    for schema in published(spark, sf_dir, f"{root}/in"):
        orders = event_stream(session, f"{root}/in", schema)
        for query in jobs.run_tables(orders, logs, f"{root}/checkpoints", jobs.ONCE, wider):
            query.awaitTermination()
    amounts = {
        "popular_products": "total_sales",
        "suspicious_ips": "total_spent",
        "high_value_orders": "total_price",
        "realtime_stats": "total_sales",
    }
    totals = [
        views.latest_table(spark, root, name)
        .agg(F.lit(name).alias("table_name"), F.count("*").alias("n"), F.sum(amount).alias("amount"))
        .withColumn("amount", F.coalesce("amount", F.lit(0).cast("bigint")))
        for name, amount in amounts.items()
    ]
    return reduce(DataFrame.unionByName, totals)


def stream_skip_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batches of a stream that reach a sink which skips those without rows: only two turns have any."""
    shown = lambda orders: orders.filter(_middle()).select("order_id")
    changes = replay(spark, sf_dir, shown, "append", wrap=lambda _, sink: sinks.skip_empty(_from_one(sink)))
    return changes.groupBy().agg(
        F.count_distinct("batch_id").alias("batches"), F.count("*").alias("orders")
    )


def _from_one(sink: sinks.Sink) -> sinks.Sink:
    """Numbers batches from one, as a change log keeps batch 0 even without rows."""
    return lambda batch, batch_id: sink(batch, batch_id + 1)


def _middle() -> Column:
    time = F.col("timestamp").cast("timestamp_ntz")
    return time.between(F.lit("2024-01-10").cast("timestamp_ntz"), F.lit("2024-01-20").cast("timestamp_ntz"))


QUERIES: dict[str, Query] = {
    "decode_orders": decode_orders,
    "bad_record_split": bad_record_split,
    "orders_encode_publish": orders_encode_publish,
    "metrics_csv_source": metrics_csv_source,
    "output_tables": output_tables,
    "output_tables_catalog": output_tables_catalog,
    "shutdown": shutdown,
    "total_price": total_price,
    "high_value_orders": high_value_orders,
    "high_value_display": high_value_display,
    "having_count": having_count,
    "window_fields": window_fields,
    "constant_column": constant_column,
    "order_verdict": order_verdict,
    "scalar_functions": scalar_functions,
    "session_timezone": session_timezone,
    "agg_count": agg_count,
    "agg_sum": agg_sum,
    "agg_avg_truncated": agg_avg_truncated,
    "agg_collect_products": agg_collect_products,
    "popular_products_tumbling": _popular,
    "popular_products_sliding": popular_products_sliding,
    "suspicious_ips_tumbling": _suspicious,
    "suspicious_ips_sliding": suspicious_ips_sliding,
    "suspicious_ips_lines": suspicious_ips_lines,
    "realtime_stats": _stats,
    "realtime_stats_enriched": realtime_stats_enriched,
    "tumbling_window": tumbling_window,
    "sliding_window": sliding_window,
    "rolling_ip_count": rolling_ip_count,
    "rolling_ip_count_ties": rolling_ip_count_ties,
    "rolling_ip_count_arrival": rolling_ip_count_arrival,
    "sort_desc": sort_desc,
    "top5_overall": top5_overall,
    "top5_per_window": top5_per_window,
    "counter_delta": counter_delta,
    "throughput_report": throughput_report,
    "delivery_success_rate": delivery_success_rate,
    "load_summary": load_summary,
    "compacted_latest": compacted_latest,
    "dash_order_series": dash_order_series,
    "dash_sales_series": dash_sales_series,
    "dash_suspicious_series": dash_suspicious_series,
    "dash_top_products": dash_top_products,
    "dash_suspicious_table": dash_suspicious_table,
    "dash_high_value_count": dash_high_value_count,
    "emit_update": stream_popular_products,
    "emit_append": stream_suspicious_ips_sliding,
    "emit_complete": stream_top5_complete,
    "stream_suspicious_ips": stream_suspicious_ips,
    "stream_high_value_orders": stream_high_value_orders,
    "stream_realtime_stats": stream_realtime_stats,
    "stream_realtime_stats_enriched": stream_realtime_stats_enriched,
    "stream_decode_orders": stream_decode_orders,
    "orders_source": stream_messages,
    "late_data": stream_late_data,
    "rolling_ip_count_stream": stream_rolling_ip_count,
    "late_rows": stream_late_rows,
    "windows_beside_late": stream_windows_beside_late,
    "top5_overall_stream": stream_top5_overall,
    "top5_per_window_stream": stream_top5_per_window,
    "realtime_stats_enriched_update": stream_stats_enriched_update,
    "counter_delta_stream": stream_counter_delta,
    "throughput_report_stream": stream_throughput,
    "fan_out": stream_fan_out,
    "alerts_verdicts": stream_alerts,
    "skip_empty_batch": stream_skip_empty,
}
