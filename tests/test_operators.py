"""Operators on small frames, against brute force and by hand."""

from __future__ import annotations

from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderwatch.functions.scalars import megabytes, money_text, wall_text, with_total_price
from orderwatch.operators import metrics, ranking, rolling, rules, windows
from orderwatch.operators.prefix import running_total, with_previous
from orderwatch.schemas import HIGH_VALUE_ORDERS, POPULAR_PRODUCTS, to_contract

T0 = datetime(2025, 1, 1)
FEED = "order_id STRING, timestamp TIMESTAMP_NTZ, ip_address STRING, product_name STRING, total_price BIGINT, quantity INT"
FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def at(second):
    return None if second is None else T0 + timedelta(seconds=second)


def feed(spark, rows, ids="STRING"):
    """Rows of (id, second, address, product, total)."""
    data = [(i, at(t), ip, product, total, 1) for i, t, ip, product, total in rows]
    return spark.createDataFrame(data, FEED.replace("order_id STRING", f"order_id {ids}"))


def brute_rolling(rows, look_back, ties):
    counts = []
    for i, t, ip, *_ in rows:
        if t is None or ip is None:
            counts.append((i, None))
            continue
        inside = [r for r in rows if r[2] == ip and r[1] is not None and t - look_back < r[1] <= t]
        if ties == "arrival":
            inside = [r for r in inside if (r[1], r[0] is not None, r[0] or "") <= (t, i is not None, i or "")]
        counts.append((i, len(inside)))
    return sorted(counts, key=str)


MOMENTS = [0, 60, 300, 600, 601, 1200, 1500, 1800, 2400]
ORDERS = st.lists(
    st.tuples(st.sampled_from([None, *MOMENTS]), st.sampled_from(["a", "b", None])), min_size=1, max_size=60
)


@FEW
@given(
    ORDERS,
    st.sampled_from(["peers", "arrival"]),
    st.sampled_from([1, 6, 10, 600]),
    st.sampled_from([1, 3, 10_000]),
    st.sets(st.integers(0, 59)),
)
def test_rolling_equals_brute_force(spark, moments, ties, cells, crowd, nameless):
    rows = [(None if n in nameless else f"o{n:03d}", t, ip, "p", 1) for n, (t, ip) in enumerate(moments)]
    found = rolling.rolling_ip_count(feed(spark, rows), "600 seconds", ties, cells, crowd)
    assert sorted(((r.order_id, r.recent_orders) for r in found.collect()), key=str) == brute_rolling(rows, 600, ties)


def test_rolling_ranks_a_crowd_in_pieces(spark):
    """One address, one time, ids with a long constant head, and numbers far apart."""
    for ids, kind in (([f"{'head' * 9}{n:05d}" for n in range(900)], "STRING"), ([n * 40_000 for n in range(900)], "BIGINT")):
        rows = [(i, 5, "hot", "p", 1) for i in ids] + [(ids[0], 4, "hot", "p", 1)]
        df = feed(spark, rows, kind)
        found = rolling.rolling_ip_count(df, ties="arrival", crowd=100)
        assert sorted(r.recent_orders for r in found.filter("timestamp > '2025-01-01 00:00:04'").collect()) == list(range(2, 902))
        moments = df.groupBy("ip_address", "timestamp").agg(F.count("*").alias("n"))
        placed = rolling._places(df.join(moments, ["ip_address", "timestamp"]), 100)
        assert sorted(r.place for r in placed.filter("n > 1").collect()) == list(range(1, 901))


def test_rolling_counts_copies(spark):
    rows = [("same", 5, "hot", "p", 1)] * 40 + [("later", 604, "hot", "p", 1), ("out", 605, "hot", "p", 1)]
    found = rolling.rolling_ip_count(feed(spark, rows))
    assert Counter((r.order_id, r.recent_orders) for r in found.collect()) == {
        ("same", 40): 40,
        ("later", 41): 1,
        ("out", 2): 1,
    }


def test_rolling_refuses_streams_and_unknown_ties(spark):
    stream = spark.readStream.format("rate").load()
    with pytest.raises(ValueError, match="stream"):
        rolling.rolling_ip_count(stream)
    with pytest.raises(ValueError, match="whole cells"):
        rolling.rolling_ip_count(feed(spark, [("a", 1, "x", "p", 1)]), "1 second", cells=7)
    with pytest.raises(ValueError, match="ties"):
        rolling.rolling_ip_count(feed(spark, [("a", 1, "x", "p", 1)]), ties="any")


def test_verdict_prefers_macro(spark):
    rows = spark.createDataFrame(
        [(10, 900_000), (9, 500_000), (9, 499_999), (None, 500_000)], "recent_orders BIGINT, total_price BIGINT"
    )
    assert [r.verdict for r in rolling.order_verdict(rows).collect()] == ["macro", "high_value", "normal", "high_value"]


def test_total_price_does_not_overflow(spark):
    rows = spark.createDataFrame([(2_000_000_000, 2)], "price INT, quantity INT")
    assert with_total_price(rows).first().total_price == 4_000_000_000


def test_high_value_includes_the_threshold(spark):
    rows = [("a", 1, "x", "p", 499_999), ("b", 1, "x", "p", 500_000), ("c", 1, "x", "p", None)]
    found = rules.high_value_orders(feed(spark, rows))
    assert found.columns == HIGH_VALUE_ORDERS.fieldNames()
    assert [r.order_id for r in found.collect()] == ["b"]
    assert rules.high_value_display(feed(spark, rows)).first().total_price == "500,000"


def brute_windows(rows, duration, slide, key):
    groups = defaultdict(lambda: [0, 0])
    for _, t, ip, product, total in rows:
        if t is None:
            continue
        start = t // slide * slide
        while start > t - duration:
            group = groups[(start, ip if key == "ip" else product)]
            group[0] += 1
            group[1] += total
            start -= slide
    return {(at(s), k): tuple(v) for (s, k), v in groups.items()}


@FEW
@given(
    st.lists(st.tuples(st.integers(0, 300), st.sampled_from("xyz"), st.sampled_from("pq")), min_size=1, max_size=50),
    st.sampled_from([(30, None), (30, 10), (60, 30), (25, 10)]),
)
def test_windows_equal_brute_force(spark, orders, width):
    """A width that is no multiple of the slide takes the plain way, the others count by slide."""
    duration, slide = width
    rows = [(str(n), t, ip, product, n) for n, (t, ip, product) in enumerate(orders)]
    df, text = feed(spark, rows), slide and f"{slide} seconds"
    popular = windows.popular_products(df, f"{duration} seconds", text).collect()
    expected = brute_windows(rows, duration, slide or duration, "product")
    assert {(r.window_start, r.product_name): (r.order_count, r.total_sales) for r in popular} == expected
    assert all(r.window_end - r.window_start == timedelta(seconds=duration) for r in popular)
    suspicious = windows.suspicious_ips(df, f"{duration} seconds", text, limit=3).collect()
    expected = {k: v for k, v in brute_windows(rows, duration, slide or duration, "ip").items() if v[0] >= 3}
    assert {(r.window_start, r.ip_address): (r.order_count, r.total_spent) for r in suspicious} == expected


def test_orders_without_time_fall_into_no_window(spark):
    rows = [("a", None, "x", "p", 1), ("b", 1, "x", "p", 1)]
    for slide in (None, "10 seconds"):
        assert windows.popular_products(feed(spark, rows), slide=slide).agg(F.min("order_count")).first()[0] == 1
    assert windows.realtime_stats(feed(spark, rows)).first().total_orders == 1


def test_an_alert_is_one_row_with_all_its_products(spark):
    names = [f"p{n % 5}" if n % 3 else "hit" for n in range(400)]
    rows = [(str(n), n % 60, "hot", name, 10) for n, name in enumerate(names)]
    rows += [(f"n{n}", n, "calm", "p0", 10) for n in range(9)] + [("u", 3, "hot", None, 10)]
    rows += [(f"x{n}", 3, None, "p0", 10) for n in range(30)]
    bought = windows.suspicious_ip_products(windows.ip_products(feed(spark, rows)))
    for alerts in (windows.product_lists(bought), windows.suspicious_ips(feed(spark, rows), products=True)):
        (alert,) = alerts.collect()
        assert (alert.ip_address, alert.order_count, alert.total_spent) == ("hot", 401, 4010)
        assert [tuple(run) for run in alert.products] == sorted(Counter(names).items())


def test_the_limit_comes_before_the_products(spark, tmp_path):
    feed(spark, [(str(n), n, "x", "p", 1) for n in range(10)]).write.parquet(str(tmp_path / "orders"))
    rows = windows.suspicious_ips(spark.read.parquet(str(tmp_path / "orders")), products=True)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Window " not in plan.replace("Window [window", "") and plan.index("Join") < plan.index("orders#")
    assert [(r.order_count, [tuple(p) for p in r.products]) for r in rows.collect()] == [(10, [("p", 10)])]


def test_address_with_unnamed_products_only_has_an_empty_list(spark):
    rows = [(str(n), n, "x", None, 1) for n in range(10)]
    bought = windows.suspicious_ip_products(windows.ip_products(feed(spark, rows)))
    assert [(r.order_count, r.products) for r in windows.product_lists(bought).collect()] == [(10, [])]


def test_stats_average_is_exact_and_cut(spark):
    big = 2**53
    rows = [("a", 1, "x", "p", big), ("b", 2, "x", "p", big + 3), ("c", 3, "y", "p", None)]
    plain = windows.realtime_stats(feed(spark, rows)).first()
    assert tuple(plain) == (at(30), 3, 2 * big + 3, big + 1, 0)
    rich = windows.realtime_stats(feed(spark, rows), enrich=True, limit=2).first()
    assert tuple(rich) == (at(30), 3, 2 * big + 3, big + 1, 1)


def test_top_per_window_and_overall(spark):
    rows = [(at(0), "b", 2), (at(0), "a", 2), (at(0), "c", 9), (at(30), "d", 1)]
    df = spark.createDataFrame(rows, "window_start TIMESTAMP_NTZ, product_name STRING, order_count BIGINT")
    top = ranking.top_per_window(df, "order_count", 2).collect()
    assert sorted((r.window_start, r["rank"], r.product_name) for r in top) == [
        (at(0), 1, "c"),
        (at(0), 2, "a"),
        (at(30), 1, "d"),
    ]
    assert [r.product_name for r in ranking.top_overall(df, "order_count", 3).collect()] == ["c", "a", "b"]
    plan = ranking.top_per_window(df, "order_count", 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


SAMPLES = st.lists(
    st.tuples(
        st.sampled_from(["h1", "h2", None]), st.one_of(st.none(), st.integers(0, 20_000)), st.integers(0, 99)
    ),
    min_size=1,
    max_size=40,
)


@FEW
@given(SAMPLES, st.sampled_from(["30 minutes", ["2 hours", "1 minute"], ["1 day", "1 hour", "10 seconds"]]))
def test_running_values_equal_brute_force(spark, samples, block):
    rows = [(n, host, at(t), v) for n, (host, t, v) in enumerate(samples)]
    df = spark.createDataFrame(rows, "id INT, host STRING, time TIMESTAMP_NTZ, v BIGINT")
    totals = running_total(df, "v", "time", "total", ["host"], ["id"], block=block)
    both = with_previous(totals, ["v", "total"], ["time", "id"], ["host"], block=block)
    found = {r.id: (r.total, tuple(r.previous) if r.previous else None) for r in both.collect()}
    expected = {n: (None, None) for n, _, t, _ in rows if t is None}
    rows = [r for r in rows if r[2] is not None]
    for host in {r[1] for r in rows}:
        total, before = 0, None
        for n, _, _, v in sorted((r for r in rows if r[1] == host), key=lambda r: (r[2], r[0])):
            total += v
            expected[n] = (total, before)
            before = (v, total)
    assert found == expected


def test_counter_delta_of_one_series(spark):
    rows = [(at(0), 0), (at(6), 3 * 1024 * 1024), (None, 4 * 1024 * 1024), (at(9000), 5 * 1024 * 1024)]
    df = spark.createDataFrame(rows, "timestamp TIMESTAMP_NTZ, written BIGINT")
    found = metrics.counter_delta(df, ["written"], ["timestamp"]).orderBy("timestamp").collect()
    assert [(r.timestamp, r.written_delta_mb) for r in found] == [(None, None), (at(0), None), (at(6), 3.0), (at(9000), 2.0)]


def test_throughput(spark):
    rows = [(str(n), t, "x", "p", 1) for n, t in enumerate([0, 0, 1, 86_400 * 2])]
    found = windows.throughput(feed(spark, rows), block=["1 day", "1 hour"]).orderBy("window_start").collect()
    assert [(r.sent, r.total_sent) for r in found] == [(2, 2), (1, 3), (1, 4)]
    assert [r.avg_rate for r in found] == [2.0, 1.5, pytest.approx(4 / 172_801)]


def test_success_rate(spark):
    rows = spark.createDataFrame([(True,), (False,), (False,), (None,)], "failed BOOLEAN")
    assert tuple(metrics.success_rate(rows, F.col("failed")).first()) == (4, 1, 75.0)
    assert tuple(metrics.success_rate(rows.limit(0), F.col("failed")).first()) == (0, 0, None)


def test_scalar_texts(spark):
    row = spark.range(1).select(
        money_text(F.lit(1_500_000)).alias("money"),
        wall_text(F.lit(datetime(2025, 1, 1, 2, 3, 4)).cast("timestamp_ntz")).alias("wall"),
        megabytes(F.lit(1_572_864)).alias("mb"),
    )
    assert tuple(row.first()) == ("1,500,000", "2025-01-01 02:03:04", 1.5)


def test_contract_orders_and_checks_types(spark):
    columns = "total_sales BIGINT, product_name STRING, window_start TIMESTAMP, window_end TIMESTAMP, order_count BIGINT"
    rows = spark.createDataFrame([(5, "p", at(0), at(30), 7)], columns)
    typed = to_contract(rows, POPULAR_PRODUCTS)
    assert [(f.name, f.dataType) for f in typed.schema] == [(f.name, f.dataType) for f in POPULAR_PRODUCTS]
    assert typed.first().order_count == 7
    with pytest.raises(Exception, match="OVERFLOW"):
        to_contract(rows.withColumn("order_count", F.lit(2**40)), POPULAR_PRODUCTS).collect()
