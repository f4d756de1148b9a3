"""Streaming runs against the golden trace and against the batch answer."""

from __future__ import annotations

import random
import time

import pytest
from feed import EPOCH, order_json, write_batch, write_trace
from pyspark.sql import functions as F

from orderwatch.__main__ import main
from orderwatch.functions.scalars import with_total_price
from orderwatch.operators.ranking import sort_desc
from orderwatch.operators.rolling import rolling_ip_count
from orderwatch.operators.windows import ip_products, popular_products, realtime_stats
from orderwatch.plans.views import latest_table
from orderwatch.schemas import OUTPUT_TABLES
from orderwatch.sources.codec import decode_orders, observe_bad_records
from orderwatch.sources.orders import read_orders
from orderwatch.streaming.catalog_tables import catalog_sink, create_tables
from orderwatch.streaming.jobs import await_any, drain, run_alerts, run_reports, run_tables, start, unwatch, watch
from orderwatch.streaming.late import divided, windows_and_late
from orderwatch.streaming.live import PART_KEYS, live_stats, stats_of_parts
from orderwatch.streaming.rolling import counted, rolling_counts
from orderwatch.streaming.running import counter_delta_stream, throughput_stream, top_of_stream
from orderwatch.streaming.sinks import both, changelog, judged, latest, read_changelog, verdict_report


def orders(spark, folder, streaming=True):
    options = {"path": str(folder)}
    if streaming:
        options["maxFilesPerTrigger"] = "1"
    return with_total_price(decode_orders(read_orders(spark, "json", options, streaming)))


def seconds(value):
    return int((value.replace(tzinfo=EPOCH.tzinfo) - EPOCH).total_seconds())


def run(df, mode, tmp_path, name="query", sink=None):
    """Rows of each batch, in order of batches, time replaced by seconds after the epoch."""
    seen = {}

    def collect(batch, batch_id):
        seen[batch_id] = [tuple(seconds(v) if hasattr(v, "tzinfo") else v for v in row) for row in batch.collect()]

    start(name, df, mode, sink or collect, str(tmp_path / f"checkpoint-{name}"), "once").awaitTermination()
    return seen


@pytest.fixture
def trace(tmp_path):
    write_trace(tmp_path / "in")
    return tmp_path / "in"


def products(spark, trace):
    return popular_products(orders(spark, trace)).drop("window_end")


UPDATES = {
    0: {(0, "p", 1, 10), (0, "q", 1, 20)},
    1: {(0, "p", 2, 20), (30, "p", 1, 10)},
    2: {(30, "q", 1, 7), (90, "p", 1, 10)},
    3: {(0, "p", 3, 1019), (90, "q", 1, 10)},
}


def full(seen):
    return {batch: set(rows) for batch, rows in seen.items() if rows}


def test_update_emits_changed_windows(spark, trace, tmp_path):
    assert full(run(products(spark, trace), "update", tmp_path)) == UPDATES


def test_append_emits_closed_windows_once(spark, trace, tmp_path):
    closed = {(0, "p", 3, 1019), (0, "q", 1, 20), (30, "p", 1, 10), (30, "q", 1, 7)}
    assert full(run(products(spark, trace), "append", tmp_path)) == {3: closed}


def test_complete_emits_every_window_sorted(spark, trace, tmp_path):
    ranked = sort_desc(products(spark, trace), "order_count", ["window_start", "product_name"])
    seen = run(ranked, "complete", tmp_path)
    assert [len(seen[batch]) for batch in range(4)] == [2, 3, 5, 6]
    assert seen[3][0] == (0, "p", 3, 1019)


def test_having_on_updates(spark, trace, tmp_path):
    frequent = products(spark, trace).filter("order_count >= 2")
    assert full(run(frequent, "update", tmp_path)) == {1: {(0, "p", 2, 20)}, 3: {(0, "p", 3, 1019)}}


def test_enriched_stats_chain_two_aggregates(spark, trace, tmp_path):
    stats = realtime_stats(orders(spark, trace), enrich=True, limit=2)
    rows = run(stats.select("stat_time", "total_orders", "suspicious_ip_count"), "append", tmp_path)
    assert full(rows) == {3: {(30, 4, 1), (60, 2, 0)}}


ROLLING = {
    0: {("x", 1, 1), ("x", 2, 2)},
    1: {("x", 5, 3), ("x", 35, 4)},
    2: {("x", 100, 1), ("y", 31, 1)},
    3: {("late", 3, 1), ("x", 105, 2)},
}


def levels_of(seen):
    def keep(batch, batch_id):
        rows = batch.select("ip_address", "timestamp", "recent_orders").collect()
        seen[batch_id] = {(ip, time and seconds(time), n) for ip, time, n in rows}

    return counted(keep)


def test_rolling_count_of_the_trace(spark, trace, tmp_path):
    seen = {}
    run(rolling_counts(orders(spark, trace), 60, 3), "append", tmp_path, sink=levels_of(seen))
    assert {i: rows for i, rows in seen.items() if rows} == ROLLING


def test_a_wrong_clock_does_not_end_the_past(spark, tmp_path):
    """An order of the year 2099, and orders without address or time; counts of the others go on over a restart."""
    folder, seen = tmp_path / "in", {}
    batches = [
        [("a", 1, "p", 10, "x")],
        [("b", 75 * 365 * 86400, "p", 10, "x"), ("c", 5, "p", 10, None)],
        [("d", 30, "p", 10, "x"), ("e", 31, "p", 10, "y")],
        [("f", 59, "p", 10, "x"), ("g", 61, "p", 10, "x")],
    ]
    for number, rows in enumerate(batches):
        write_batch(folder, number, [order_json(*row) for row in rows])
        run(rolling_counts(orders(spark, folder), 60, 3, lateness=60), "append", tmp_path, sink=levels_of(seen))
    seen = {row for rows in seen.values() for row in rows}
    far = {row for row in seen if row[1] > 1000}
    assert seen - far == {("x", 1, 1), (None, 5, None), ("x", 30, 2), ("y", 31, 1), ("x", 59, 3), ("x", 61, 3)}
    assert {n for _, _, n in far} == {1}


def rows_of_state(query):
    progress = [p for p in query.recentProgress if p.stateOperators]
    return [sum(s.numRowsTotal for s in p.stateOperators) for p in progress]


@pytest.fixture
def state_counted(spark):
    name = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    yield
    spark.conf.set(name, before)


def test_state_stays_bounded(spark, tmp_path, state_counted):
    """Orders at one rate: the state is as large after twenty batches as after eight, and every count is right."""
    for number in range(20):
        lines = [order_json(f"o{i}", i, "p", 10, f"ip{i % 2}") for i in range(number * 20, number * 20 + 20)]
        write_batch(tmp_path / "in", number, lines)
    found = {}
    sink = counted(lambda batch, i: found.update({r.order_id: r.recent_orders for r in batch.collect()}))
    plan = rolling_counts(orders(spark, tmp_path / "in"), 60, 3, lateness=20)
    query = start("bounded", plan, "append", sink, str(tmp_path / "c"), "once")
    query.awaitTermination()
    assert found == {f"o{i}": min(i // 2 + 1, 30) for i in range(400)}
    rows = rows_of_state(query)
    assert max(rows[16:]) <= max(rows[6:10]) and len(rows) >= 20


def many_orders(folder, files=4):
    """Ordered in time over the files, with equal times, one hot address, and gaps of one look-back."""
    lines = []
    for i in range(240):
        second = (i // 3) * 5
        lines.append(order_json(f"o{i:04d}", second, "pqr"[i % 3], 100 + i, "hot" if i % 3 else f"ip{i % 7}"))
    step = len(lines) // files
    for number in range(files):
        write_batch(folder, number, lines[number * step : (number + 1) * step])


@pytest.mark.parametrize("cells", [1, 6])
def test_rolling_stream_equals_batch(spark, tmp_path, cells):
    many_orders(tmp_path / "in")
    expected = rolling_ip_count(orders(spark, tmp_path / "in", False), "60 seconds", cells=3)
    found = {}

    def keep(batch, batch_id):
        for row in batch.collect():
            assert row["order_id"] not in found
            found[row["order_id"]] = tuple(row)

    run(rolling_counts(orders(spark, tmp_path / "in"), 60, cells), "append", tmp_path, sink=counted(keep))
    assert found == {row["order_id"]: tuple(row) for row in expected.collect()}


def test_best_rows_of_a_stream(spark, tmp_path, state_counted):
    """Ranks change as windows close; state is as many rows as are asked for, besides the open windows."""
    for number in range(12):
        lines = [order_json(f"o{number}-{i}", number * 30 + i, f"p{i % (number % 4 + 1)}", 10, "x") for i in range(20)]
        write_batch(tmp_path / "in", number, lines)
    popular = lambda feed: popular_products(feed, delay="1 second")
    plan, path = top_of_stream(popular(orders(spark, tmp_path / "in")), "order_count", 3), str(tmp_path / "changes")
    query = start("best", plan, "append", changelog(path), str(tmp_path / "c"), "once")
    query.awaitTermination()
    best = latest(read_changelog(spark, path, plan.schema), ["rank"]).orderBy("rank").collect()
    closed = popular(orders(spark, tmp_path / "in", False)).filter("window_end <= timestamp'2025-01-01T00:05:30Z'")
    expected = closed.orderBy(F.desc("order_count"), "window_start", "product_name").limit(3).collect()
    assert [tuple(r)[1:] for r in best] == [tuple(r) for r in expected]
    assert [r.rank for r in best] == [1, 2, 3]
    assert max(rows_of_state(query)) <= 3 + 3 * 4


def test_counter_growth_out_of_order(spark, tmp_path):
    """Samples of two series, some out of order across batches, one too late: as if they had come in order."""
    batches = [
        [("a", 10, 100, "h"), ("b", 30, 900, "h")],
        [("c", 20, 400, "h"), ("d", 15, 7, "i")],
        [("e", 200, 1000, "h"), ("f", 190, 9, "i")],
        [("g", 12, 5, "h"), ("h", 400, 0, "z")],
    ]
    for number, rows in enumerate(batches):
        write_batch(tmp_path / "in", number, [order_json(i, t, "p", price, host) for i, t, price, host in rows])
    samples = orders(spark, tmp_path / "in").select("order_id", "timestamp", "ip_address", F.col("price").cast("long").alias("sent"))
    plan = counter_delta_stream(samples, ["sent"], ["timestamp", "order_id"], ["ip_address"], "60 seconds", 10)
    found = {}
    run(plan, "append", tmp_path, sink=lambda df, i: found.update({r.order_id: r.sent_delta_mb for r in df.collect()}))
    grown = lambda bytes_: bytes_ / 1048576
    assert found == {"a": None, "c": grown(300), "b": grown(500), "e": grown(100), "d": None, "f": grown(2)}


def test_a_long_series_waits_for_one_timer(spark, tmp_path):
    """Thousands of lines of the grid pass in one batch; whole numbers beside nulls stay exact."""
    count, big = 4000, 2**53
    lines = [order_json(f"o{i:05d}", 60 * i, "p", i, None if i % 2 else "h") for i in range(count)]
    write_batch(tmp_path / "in", 0, lines[::-1])
    write_batch(tmp_path / "in", 1, [order_json("end", 60 * count + 7200, "p", 0, "z")])
    sent = F.when(F.col("price") != 6, F.col("price").cast("long") + big).alias("sent")
    samples = orders(spark, tmp_path / "in").select("order_id", "timestamp", "ip_address", sent)
    plan = counter_delta_stream(samples, ["sent"], ["timestamp", "order_id"], ["ip_address"], "60 seconds", 60)
    found = {}
    sink = lambda df, i: found.update({r.order_id: (r.sent, r.sent_delta_mb) for r in df.collect()})
    query = start("long", plan, "append", sink, str(tmp_path / "c"), "once")
    ended = query.awaitTermination(60)
    query.stop()
    assert ended and len(found) == count
    grown = {f"o{i:05d}": (None if i == 6 else i + big, None if i < 2 or i in (6, 8) else 2 / 1048576) for i in range(count)}
    assert found == grown


def test_throughput_as_intervals_close(spark, trace, tmp_path):
    found = full(run(throughput_stream(orders(spark, trace), "30 seconds", "1 second"), "append", tmp_path))
    rows = sorted(row for batch in found.values() for row in batch)
    assert rows == [(0, 3, 3, 0.1), (30, 2, 5, 5 / 60)]


def test_open_windows_change_when_an_address_crosses_the_limit(spark, trace, tmp_path):
    path = str(tmp_path / "changes")
    plan = live_stats(orders(spark, trace), "30 seconds", "100 seconds", limit=3, parts=2)
    run(plan, "update", tmp_path, sink=changelog(path))
    changes = read_changelog(spark, path, plan.schema)
    found = stats_of_parts(latest(changes, PART_KEYS)).collect()
    expected = realtime_stats(orders(spark, trace, False), enrich=True, limit=3).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, expected))
    first = [r.suspicious for r in changes.filter("orders > 0").orderBy("batch_id").collect() if r.batch_id < 2]
    assert max(first) == 1  # the third order of x came in the second batch


def test_late_orders_are_kept_beside_the_windows(spark, tmp_path):
    """Every order is in a window or late; a batch that meets both hands on both."""
    times = [[1, 2], [200, 31], [3, 210], [300, 4], [301]]
    for number, some in enumerate(times):
        write_batch(tmp_path / "in", number, [order_json(f"o{t}", t, "p", 10, "x") for t in some])
    build = lambda feed: popular_products(feed, delay=None)
    plan = windows_and_late(orders(spark, tmp_path / "in"), build, "30 seconds", "1 second")
    closed, late = {}, {}
    sink = divided(
        lambda df, i: closed.update({seconds(r.window_start): r.order_count for r in df.collect()}),
        lambda df, i: late.update({r.order_id: (i, seconds(r.timestamp), r.total_price) for r in df.collect()}),
    )
    run(plan, "append", tmp_path, sink=sink)
    assert closed == {0: 2, 30: 1, 180: 1, 210: 1}
    assert late == {"o3": (2, 3, 10), "o4": (3, 4, 10)}


def odd_orders(folder):
    """Orders with nulls, late for some or all of their windows, the watermark (20 s behind) on ends and 1 ms beside them."""
    chance = random.Random(5)
    newest = [10, 49.999, 110, 109, 139.999, 140, 141, 400, 380, 530]
    for number, last in enumerate(newest):
        times = [last, *[max(last - chance.choice([1, 15, 40, 90, 200]) * chance.random(), 0) for _ in range(30)]]
        rows = [
            (f"o{number}-{i}", second, chance.choice(["p", "q", None]), chance.choice([10, 7, None]), chance.choice(["x", "y", "z", None]))
            for i, second in enumerate(times)
        ]
        write_batch(folder, number, [order_json(*row) for row in [*rows, (f"early{number}", -2e9 - number, "p", 1, "x")]])


def test_windows_by_pane_close_as_those_of_spark(spark, tmp_path):
    odd_orders(tmp_path / "in")
    feed = orders(spark, tmp_path / "in")
    for name, slide in (("sliding", "30 seconds"), ("tumbling", None)):
        window = F.window("timestamp", "60 seconds", slide).alias("window")
        plain = feed.withWatermark("timestamp", "20 seconds").groupBy(window, "ip_address", "product_name")
        plain = plain.agg(F.count("*").alias("copies"), F.sum("total_price").alias("spent"))
        plain = plain.select("window.start", "ip_address", "product_name", "copies", "spent")
        bought = ip_products(feed, "60 seconds", slide, "20 seconds")
        assert bought.dtypes[1:] == plain.dtypes[1:]
        wanted = full(run(plain, "append", tmp_path, f"plain-{name}"))
        found = run(bought, "append", tmp_path, f"panes-{name}")
        assert len(wanted) > 3 and full(found) == wanted
        assert sum(map(len, found.values())) == sum(map(len, wanted.values()))


def test_windows_by_pane_go_on_after_a_restart(spark, tmp_path):
    """Each batch is a run of its own; the windows are those of one run."""
    odd_orders(tmp_path / "in")
    whole = run(ip_products(orders(spark, tmp_path / "in"), "60 seconds", "30 seconds", "20 seconds"), "append", tmp_path, "whole")
    found = {}
    for file in sorted((tmp_path / "in").iterdir())[:7]:
        (tmp_path / "some").mkdir(exist_ok=True)
        (tmp_path / "some" / file.name).write_bytes(file.read_bytes())
        plan = ip_products(orders(spark, tmp_path / "some"), "60 seconds", "30 seconds", "20 seconds")
        found |= run(plan, "append", tmp_path, "restarted")
    rows = [row for batch in found.values() for row in batch]
    ends = {row[0] for row in rows}
    assert len(ends) > 2 and len(set(rows)) == len(rows) and len({row[:3] for row in rows}) == len(rows)
    assert {row[:3] for row in rows} <= {row[:3] for batch in whole.values() for row in batch}


def test_an_address_and_product_is_not_state_of_its_own(spark, tmp_path, state_counted):
    """it was a row of state for each of its windows."""
    lines = [order_json(f"o{i}", i % 50, f"p{i % 7}", 10, f"ip{i}") for i in range(5000)]
    write_batch(tmp_path / "in", 0, lines)
    write_batch(tmp_path / "in", 1, [order_json("z", 1000, "p", 10, "x")])
    bought = []
    plan = ip_products(orders(spark, tmp_path / "in"), slide="30 seconds")
    query = start("packed", plan, "append", lambda df, i: bought.append(df.count()), str(tmp_path / "c"), "once")
    query.awaitTermination()
    assert sum(bought) == 10_000 and max(rows_of_state(query)) < 2500


def test_latest_of_updates_equals_batch(spark, trace, tmp_path):
    path = str(tmp_path / "changes")
    plan = popular_products(orders(spark, trace))
    run(plan, "update", tmp_path, sink=changelog(path))
    changes = read_changelog(spark, path, plan.schema)
    assert changes.count() == 8
    now = latest(changes, ["window_start", "window_end", "product_name"])
    expected = popular_products(orders(spark, trace, streaming=False))
    assert now.columns == expected.columns
    assert sorted(now.collect()) == sorted(expected.collect())


def test_restart_goes_on_without_duplicates(spark, tmp_path):
    folder, path = tmp_path / "in", str(tmp_path / "changes")
    write_trace(folder, range(2))
    for batches in (range(0), range(2, 4)):
        write_trace(folder, batches)
        run(popular_products(orders(spark, folder)), "update", tmp_path, sink=changelog(path))
    plan = popular_products(orders(spark, folder, streaming=False))
    changes = read_changelog(spark, path, plan.schema)
    assert changes.count() == 8
    now = latest(changes, ["window_start", "window_end", "product_name"])
    assert sorted(now.collect()) == sorted(plan.collect())


def test_repeated_batch_replaces_itself(spark, tmp_path):
    frame = spark.createDataFrame([(1, 2)], "k INT, v INT")
    sink = changelog(str(tmp_path / "changes"))
    sink(frame, 7)
    sink(frame, 7)
    assert [tuple(r) for r in read_changelog(spark, str(tmp_path / "changes"), frame.schema).collect()] == [(1, 2, 7)]


def test_late_orders_are_dropped_and_counted(spark, tmp_path):
    folder = tmp_path / "in"
    for number, second in enumerate([1, 200, 300, 2]):
        write_batch(folder, number, [order_json(f"o{number}", second, "p", 10, "x")])
    plan = popular_products(orders(spark, folder))
    late = watch(spark)
    query = start("late", plan, "update", lambda df, i: df.count(), str(tmp_path / "c"), "once")
    query.awaitTermination()
    unwatch(spark, late)
    assert late.dropped["late"] == 1


def test_bad_messages_are_counted_on_the_way(spark, tmp_path):
    folder = tmp_path / "in"
    write_batch(folder, 0, [order_json("a", 1, "p", 10, "x"), "junk", '{"order_id": "b", "timestamp": "nope"}'])
    decoded = observe_bad_records(decode_orders(read_orders(spark, "json", {"path": str(folder)})))
    query = start("bad", decoded, "append", lambda df, i: df.count(), str(tmp_path / "c"), "once")
    query.awaitTermination()
    counts = [p.observedMetrics["bad_records"] for p in query.recentProgress if "bad_records" in p.observedMetrics]
    assert (counts[0].orders, counts[0].rejects) == (3, 2)


def test_a_drained_query_ends_between_batches(spark, tmp_path):
    """Stopped in its second batch, which still ends; the rest follows after a restart, and nothing comes twice."""
    folder, seen = tmp_path / "in", []
    for number in range(5):
        write_batch(folder, number, [order_json(f"o{number}", number, "p", 10, "x"), "junk"])
    feed = lambda: observe_bad_records(decode_orders(read_orders(spark, "json", {"path": str(folder), "maxFilesPerTrigger": "1"})))

    def slow(batch, batch_id):
        seen.append((batch_id, sorted(r.order_id or "" for r in batch.collect())))
        time.sleep(1)

    heard = watch(spark)
    query = start("drained", feed(), "append", slow, str(tmp_path / "c"), None)
    while len(seen) < 2:
        time.sleep(0.02)
    drain([query])
    assert [i for i, _ in seen] == [0, 1] and (query.exception() is None or "Drained" in str(query.exception()))
    start("drained", feed(), "append", slow, str(tmp_path / "c"), "once").awaitTermination()
    unwatch(spark, heard)
    assert seen == [(i, ["", f"o{i}"]) for i in range(5)]
    rows = [batch for batch in heard.batches["drained"] if batch[2]]
    assert [(i, n, orders, rejects) for i, _, n, orders, rejects in rows] == [(i, 2, 2, 1) for i in range(5)]
    starts = [begun for _, begun, *_ in rows]
    assert starts == sorted(starts) and len(set(starts)) == 5


def test_catalog_tables_fill_the_other_columns(spark, tmp_path):
    names = create_tables(spark, "shop_test", location=str(tmp_path / "shop"))
    assert create_tables(spark, "shop_test") == names and len(names) == 4
    sink = catalog_sink("shop_test", "suspicious_ips")
    row = "timestamp'2025-01-01T00:00:00Z' AS window_start, CAST(id AS STRING) AS ip_address, id AS order_count, 5L AS total_spent"
    batch = lambda n: spark.range(0, n, 1, 4).selectExpr(*row.split(", "))
    for batch_id, n in ((0, 7), (1, 9), (1, 5), (2, 0), (4, 6)):
        sink(batch(n), batch_id)
    rows = spark.table("shop_test.suspicious_ips").orderBy("id").collect()
    assert [(r.batch_id, r.total_spent) for r in rows] == [(0, 5)] * 7 + [(1, 5)] * 5 + [(4, 5)] * 6
    assert len({r.id for r in rows}) == len(rows) and all(r.created_at for r in rows)
    spark.sql("DROP DATABASE shop_test CASCADE")


def test_tables_and_reports_fan_out(spark, tmp_path):
    """A feed with one address that orders far too often: it, and only it, is reported."""
    folder = tmp_path / "in"
    normal = [order_json(f"n{i}", i, "mouse", 30_000, f"10.0.0.{i}") for i in range(50)]
    bot = [order_json(f"b{i}", i, "laptop", 1_500_000, "10.9.9.9", 5) for i in range(20)]
    write_batch(folder, 0, normal + bot)
    write_batch(folder, 1, [order_json("z", 1000, "mouse", 30_000, "10.0.0.1")])
    feed = orders(spark, folder)
    paths = {name: str(tmp_path / name) for name in OUTPUT_TABLES}
    queries = run_tables(feed, {n: changelog(p) for n, p in paths.items()}, str(tmp_path / "ct"), "once")
    lines = []
    queries += run_reports(feed, str(tmp_path / "cr"), "once", out=lines.append)
    for query in queries:
        query.awaitTermination()
    read = {name: spark.read.parquet(path) for name, path in paths.items()}
    assert {(r.ip_address, r.order_count, r.total_spent) for r in read["suspicious_ips"].collect()} == {
        ("10.9.9.9", 20, 150_000_000)
    }
    assert read["high_value_orders"].count() == 20
    assert read["realtime_stats"].agg(F.sum("total_orders")).first()[0] == 71
    text = "\n".join(lines)
    assert "Popular products, top 5 (batch 0)" in text and "150,000,000" in text
    assert "laptop x20" in text and "no suspicious address" in text
    assert "20 rows" in text


def test_await_any_raises_the_failure_and_stops_the_rest(spark, trace, tmp_path):
    spark.streams.resetTerminated()

    def fail(batch, batch_id):
        raise RuntimeError("sink is gone")

    feed = orders(spark, trace)
    start("healthy", feed, "append", lambda df, i: None, str(tmp_path / "h"), "1 hour")
    start("broken", feed, "append", fail, str(tmp_path / "b"), None)
    with pytest.raises(Exception, match="sink is gone"):
        await_any(spark)
    assert not spark.streams.active
    spark.streams.resetTerminated()


def test_alerts_judge_every_order(spark, tmp_path):
    folder = tmp_path / "in"
    write_batch(folder, 0, [order_json(f"b{i:02d}", i, "mouse", 30_000, "bot") for i in range(6)])
    write_batch(folder, 1, [order_json(f"b{i:02d}", i, "mouse", 30_000, "bot") for i in range(6, 12)])
    write_batch(folder, 2, [order_json("h", 20, "laptop", 1_500_000, "x"), order_json("n", 21, "mouse", 30_000, "x")])
    path = str(tmp_path / "verdicts")
    for query in run_alerts(orders(spark, folder), changelog(path), str(tmp_path / "a"), trigger="once"):
        query.awaitTermination()
    found = {r.order_id: (r.recent_orders, r.verdict) for r in spark.read.parquet(path).collect()}
    assert found == {
        **{f"b{i:02d}": (i + 1, "macro" if i >= 9 else "normal") for i in range(12)},
        "h": (1, "high_value"),
        "n": (2, "normal"),
    }
    lines = []
    sink = judged(verdict_report(out=lines.append))
    rows = spark.read.parquet(path).drop("verdict")
    sink(rows, 5)
    assert lines[0].count("macro") == 3 and "high_value" in lines[0] and "normal" not in lines[0]
    assert lines[0].endswith("4 rows")


def test_no_verdict_is_lost(spark, tmp_path):
    """Fifty macro orders in one batch: the print shows some and says how many, the sink has all."""
    folder, path, lines = tmp_path / "in", str(tmp_path / "verdicts"), []
    write_batch(folder, 0, [order_json(f"b{i:02d}", i, "mouse", 30_000, "bot") for i in range(59)])
    sink = both(changelog(path), verdict_report(out=lines.append))
    for query in run_alerts(orders(spark, folder), sink, str(tmp_path / "a"), trigger="once"):
        query.awaitTermination()
    assert spark.read.parquet(path).filter("verdict = 'macro'").count() == 50
    assert spark.read.parquet(path).count() == 59
    assert lines[0].count("macro") == 20 and lines[0].endswith("50 rows")


def test_command_line_runs_a_job_to_its_end(spark, tmp_path, trace):
    """In the running session; the topic and the database are not reachable here."""
    source = ["--format", "json", "--option", f"path={trace}", "--option", "maxFilesPerTrigger=1", "--trigger", "once"]
    main(["tables", *source, "--output", str(tmp_path / "out"), "--checkpoints", str(tmp_path / "c")])
    assert spark.read.parquet(str(tmp_path / "out" / "popular_products")).count() == 8
    limits = ["--limit", "2", "--threshold", "900", "--look-back", "60"]
    main(["alerts", *source, *limits, "--output", str(tmp_path / "out"), "--checkpoints", str(tmp_path / "d")])
    verdicts = {r.order_id: r.verdict for r in spark.read.parquet(str(tmp_path / "out" / "verdicts")).collect()}
    assert verdicts == {**dict.fromkeys(["a1", "b0", "b1", "d1"], "macro"), "d0": "high_value", **dict.fromkeys(["a0", "c0", "c1"], "normal")}
    main(["compact", "--output", str(tmp_path / "out")])
    main(["compact", "--output", str(tmp_path / "out")])
    assert not list((tmp_path / "out" / "popular_products").glob("batch_id=*"))
    assert latest_table(spark, str(tmp_path / "out"), "popular_products").count() == 6
    for job in ("tables", "alerts", "compact"):
        with pytest.raises(SystemExit):
            main([job, *source])


def test_sinks_may_adapt_and_leave_few_files(spark, tmp_path):
    write_batch(tmp_path / "in", 0, [order_json(f"o{i}", i, f"p{i}", 10, "x") for i in range(200)])
    adaptive, path = [], tmp_path / "changes"
    write = changelog(str(path))

    def sink(batch, batch_id):
        adaptive.append(batch.sparkSession.conf.get("spark.sql.adaptive.enabled"))
        write(batch, batch_id)

    run(popular_products(orders(spark, tmp_path / "in")), "update", tmp_path, sink=sink)
    assert set(adaptive) == {"true"}
    assert len(list((path / "batch_id=0").glob("*.parquet"))) == 1
