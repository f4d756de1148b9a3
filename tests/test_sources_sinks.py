"""Decoding, readers, sinks and the dashboard over small inputs."""

from __future__ import annotations

import re
from datetime import datetime

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from orderwatch.functions.scalars import wall_time, with_total_price
from orderwatch.plans import dashboard
from orderwatch.plans.views import compact_tables, latest_table, register_views
from orderwatch.schemas import HIGH_VALUE_ORDERS, ORDER_MESSAGE, OUTPUT_TABLES, REALTIME_STATS
from orderwatch.sources.codec import decode_orders, encode_orders, publish_orders, split_bad_records
from orderwatch.sources.orders import read_metrics_csv, read_orders
from orderwatch.streaming import sinks
from orderwatch.streaming.jobs import checkpoint_root

MESSAGES = [
    '{"order_id":"a","timestamp":"2025-12-31T18:23:59.123456+09:00","price":1500000,"quantity":2}',
    "junk",
    '{"order_id":"b","timestamp":"nope","price":1,"quantity":1}',
    '{"order_id":"c","timestamp":"2025-12-31T18:23:59+09:00","price":1.5,"quantity":1}',
    '{"order_id":"d","timestamp":"2025-12-31T18:23:59+09:00","price":2000000000,"quantity":2}',
    None,
    "",
    '["a", "list"]',
]


def raw(spark):
    return spark.createDataFrame([(None if m is None else m.encode(),) for m in MESSAGES], "value BINARY")


def test_decode_of_good_and_bad_messages(spark):
    decoded = with_total_price(decode_orders(raw(spark)))
    found = [(r.order_id, r.t, r.total_price) for r in decoded.withColumn("t", F.col("timestamp").cast("string")).collect()]
    assert found == [
        ("a", "2025-12-31 09:23:59.123456", 3_000_000),
        (None, None, None),
        ("b", None, 1),
        ("c", "2025-12-31 09:23:59", None),
        ("d", "2025-12-31 09:23:59", 4_000_000_000),
        (None, None, None),
        (None, None, None),
        (None, None, None),
    ]


def test_split_keeps_every_row_once(spark):
    good, rejects = split_bad_records(decode_orders(raw(spark)))
    assert [r.order_id for r in good.collect()] == ["a", "d"]
    assert rejects.count() == 6


def test_each_message_is_parsed_once(spark, tmp_path):
    """A filter on parsed fields must not bring a second parse of the message."""
    raw(spark).write.parquet(str(tmp_path / "m"))
    good, _ = split_bad_records(decode_orders(spark.read.parquet(str(tmp_path / "m"))))
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_encode_decode_round_trip(spark, tmp_path):
    decoded = decode_orders(raw(spark)).filter("order_id IN ('a', 'd')")
    messages = encode_orders(decoded)
    assert messages.columns == ["key", "value"]
    assert [r.key for r in messages.collect()] == ["a", "d"]
    messages.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value")).write.parquet(
        str(tmp_path / "topic")
    )
    again = decode_orders(read_orders(spark, "parquet", {"path": str(tmp_path / "topic")}, streaming=False))
    assert sorted(again.collect()) == sorted(decoded.collect())


class Reader:
    """Stands in for a session where no topic can be reached, and keeps what it is asked for."""

    def __init__(self):
        self.asked = {}
        self.readStream = self.read = self

    def format(self, name):
        self.asked["format"] = name
        return self

    def options(self, **options):
        self.asked.update(options)
        return self

    def load(self):
        return self

    def select(self, name):
        self.asked["select"] = name
        return self


def test_topic_options():
    topic = {"kafka.bootstrap.servers": "broker:9092", "subscribe": "orders", "maxOffsetsPerTrigger": "1000"}
    stream, table = Reader(), Reader()
    read_orders(stream, "kafka", topic)
    assert stream.asked == {"format": "kafka", "startingOffsets": "latest", "select": "value", **topic}
    read_orders(table, "kafka", topic, streaming=False)
    assert "startingOffsets" not in table.asked
    with pytest.raises(ValueError, match="unknown order source"):
        read_orders(Reader(), "avro", {"path": "x"})


def test_metrics_csv(spark, tmp_path):
    (tmp_path / "m.csv").write_text(
        "timestamp,cpu_percent,memory_percent,memory_used_mb,disk_read_mb,disk_write_mb,network_sent_mb,network_recv_mb\n"
        "2025-01-01 00:00:01,20.5,70.0,5000.25,0.5,1.5,2.5,3.5\n"
    )
    rows = read_metrics_csv(spark, str(tmp_path / "m.csv"))
    assert rows.dtypes[0] == ("timestamp", "timestamp") and {t for _, t in rows.dtypes[1:]} == {"double"}
    assert rows.first().memory_used_mb == 5000.25


@pytest.mark.parametrize("zone", ["UTC", "Asia/Seoul", "America/New_York"])
def test_wall_time_does_not_depend_on_the_session(spark, zone):
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", zone)
    times = session.sql("SELECT timestamp'2025-12-31T09:23:59.5Z' AS instant, timestamp_ntz'2025-12-31 09:23:59.5' AS plain")
    shown = times.select(wall_time(F.col("instant"), "Asia/Seoul"), wall_time(F.col("plain"), "Asia/Seoul"))
    assert tuple(shown.first()) == (datetime(2025, 12, 31, 18, 23, 59, 500_000),) * 2
    autumn = session.sql("SELECT timestamp'2024-11-03T05:30:00Z' AS t UNION ALL SELECT timestamp'2024-11-03T06:30:00Z'")
    assert {r[0] for r in autumn.select(wall_time(F.col("t"), "Asia/Seoul")).collect()} == {
        datetime(2024, 11, 3, 14, 30),
        datetime(2024, 11, 3, 15, 30),
    }


class Topic:
    """Stands in for a frame's writer and keeps what it is asked for."""

    def __init__(self, asked):
        self.asked = asked

    def format(self, name):
        self.asked["format"] = name
        return self

    def options(self, **options):
        self.asked.update(options)
        return self

    def option(self, name, value):
        self.asked[name] = value
        return self

    def save(self):
        self.asked["done"] = "save"

    def start(self):
        self.asked["done"] = "start"


def test_publishing_options(spark, monkeypatch):
    """No topic here: the options handed to Spark's writers are what is checked."""
    asked = {}
    kind = type(spark.range(0))
    monkeypatch.setattr(kind, "write", property(lambda self: Topic(asked)))
    monkeypatch.setattr(kind, "writeStream", property(lambda self: Topic(asked)))
    options = {"kafka.bootstrap.servers": "broker:9092", "topic": "orders", "kafka.linger.ms": "5"}
    batch = spark.createDataFrame([], ", ".join(f"{name} STRING" for name in ORDER_MESSAGE.fieldNames()))
    publish_orders(batch, options)
    assert asked == {"format": "kafka", "done": "save", **options}
    asked.clear()
    stream = spark.readStream.format("rate").load().select(*[F.lit("x").alias(n) for n in ORDER_MESSAGE.fieldNames()])
    publish_orders(stream, options, "/shared/c")
    assert asked == {"format": "kafka", "done": "start", "checkpointLocation": "/shared/c", **options}
    with pytest.raises(ValueError, match="checkpoint"):
        publish_orders(stream, options)


def test_jdbc_append_passes_the_batch_on(spark, monkeypatch):
    """No database here: the call to Spark's writer is what is checked."""
    calls = []

    def jdbc(self, url, table, mode=None, properties=None):
        calls.append((self._df.columns, url, table, mode, properties))

    monkeypatch.setattr(DataFrameWriter, "jdbc", jdbc)
    batch = spark.createDataFrame([(1,)], "v INT")
    properties = {"driver": "some.Driver", "batchsize": "5000"}
    sinks.jdbc_append("jdbc:x", "stats", properties)(batch, 3)
    sinks.jdbc_append("jdbc:x", "stats", properties, with_batch_id=True)(batch, 3)
    assert calls == [
        (["v"], "jdbc:x", "stats", "append", properties),
        (["v", "batch_id"], "jdbc:x", "stats", "append", properties),
    ]


def test_skip_empty(spark):
    seen = []
    sink = sinks.skip_empty(lambda batch, batch_id: seen.append((batch_id, batch.count())))
    rows = spark.createDataFrame([(1,), (2,)], "v INT")
    sink(rows, 1)
    sink(rows.filter("v > 5"), 2)
    assert seen == [(1, 2)]


def test_report_prints_rows_or_nothing(spark):
    lines = []
    rows = spark.createDataFrame([(n, f"name{n}") for n in range(5)], "n INT, name STRING")
    sinks.report("Names", 2, out=lines.append)(rows, 4)
    sinks.report("Names", 9, counted=True, out=lines.append)(rows, 5)
    sinks.report("Names", out=lines.append)(rows.limit(0), 6)
    sinks.report("Names", empty="none", out=lines.append)(rows.limit(0), 7)
    assert lines[0].splitlines() == ["Names (batch 4)", "n | name ", "0 | name0", "1 | name1", "first 2 rows"]
    assert lines[1].endswith("5 rows")
    assert lines[2:] == ["Names (batch 7): none"]


def test_latest_takes_the_newest_batch(spark):
    schema = "window_start TIMESTAMP, k STRING, v INT, batch_id BIGINT"
    one, two = datetime(2025, 1, 1, 5), datetime(2025, 1, 2, 5)
    changes = spark.createDataFrame(
        [(one, "a", 1, 0), (one, "a", 2, 9), (one, "a", 3, 10), (two, "b", 4, 1), (two, "b", None, 2)], schema
    )
    assert sorted((r.k, r.v) for r in sinks.latest(changes, ["window_start", "k"]).collect()) == [("a", 3), ("b", None)]


def test_changelog_leaves_out_empty_batches(spark, tmp_path):
    rows, log = spark.createDataFrame([(1,)], "v INT"), sinks.changelog(str(tmp_path))
    for batch_id, batch in enumerate([rows.limit(0), rows, rows.limit(0), rows]):
        log(batch, batch_id)
    assert sorted(p.name for p in tmp_path.glob("batch_id=*")) == ["batch_id=0", "batch_id=1", "batch_id=3"]


STATS_KEYS = (["stat_time"], "stat_time")


def stats_view(spark, path):
    rows = sinks.read_latest(spark, path, REALTIME_STATS, *STATS_KEYS)
    return sorted((r.stat_time.day, r.total_orders) for r in rows.collect())


def test_compaction_keeps_the_view_and_empties_the_log(spark, tmp_path):
    path = str(tmp_path / "stats")
    log = sinks.changelog(path)
    row = lambda day, n: (datetime(2025, 1, day), n, 10 * n, 10, 0)
    batches = [[row(1, 1), row(2, 1)], [row(2, 2)], [], [row(1, 5), row(3, 1)], [row(3, 2)]]
    expected = {}
    for batch_id, rows in enumerate(batches):
        log(spark.createDataFrame(rows, REALTIME_STATS), batch_id)
        expected |= {r[0].day: r[1] for r in rows}
        assert stats_view(spark, path) == sorted(expected.items())
        if batch_id in (1, 3):
            assert sinks.compact(spark, path, REALTIME_STATS, *STATS_KEYS) == batch_id
            assert not list((tmp_path / "stats").glob("batch_id=*"))
            assert stats_view(spark, path) == sorted(expected.items())
    # A batch that was compacted already and comes again changes nothing.
    log(spark.createDataFrame(batches[3], REALTIME_STATS), 3)
    assert stats_view(spark, path) == sorted(expected.items())
    assert sinks.compact(spark, path, REALTIME_STATS, *STATS_KEYS) == 4
    assert sinks.compact(spark, path, REALTIME_STATS, *STATS_KEYS) == 4
    assert stats_view(spark, path) == sorted(expected.items())


@pytest.mark.parametrize("keys", [["stat_time"], []])
@pytest.mark.parametrize("step", ["_mark", "_tidy", "remove"])
def test_a_compaction_that_broke_off_loses_nothing(spark, tmp_path, monkeypatch, keys, step):
    """Lost before its marker, before what it replaces is removed, or in the middle of that."""
    path, where = str(tmp_path / "stats"), (str(tmp_path / "stats"), REALTIME_STATS, keys, "stat_time")
    log = sinks.changelog(path)
    day = lambda number, n: (datetime(2025, 1, number), n, 10 * n, 10, 0)
    view = lambda: sorted((r.stat_time.day, r.total_orders) for r in sinks.read_latest(spark, *where).collect())
    log(spark.createDataFrame([day(1, 1), day(2, 1)], REALTIME_STATS), 0)
    log(spark.createDataFrame([day(3, 1)], REALTIME_STATS), 1)
    assert sinks.compact(spark, *where) == 1
    log(spark.createDataFrame([day(2, 5)], REALTIME_STATS), 2)
    before = view()
    assert before == ([(1, 1), (2, 5), (3, 1)] if keys else [(1, 1), (2, 1), (2, 5), (3, 1)])
    calls, real = [], getattr(sinks, step)

    def lost(*args):
        calls.append(args)
        if step == "remove" and len(calls) == 1:
            return real(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(sinks, step, lost)
    with pytest.raises(RuntimeError):
        sinks.compact(spark, *where)
    assert view() == before
    log(spark.createDataFrame([day(4, 7)], REALTIME_STATS), 3)
    monkeypatch.undo()
    for _ in range(2):
        assert view() == [*before, (4, 7)]
        assert sinks.compact(spark, *where) == 3
    kept = sorted(f"{p.parent.name}/{p.name}" for p in (tmp_path / "stats-latest").glob("rows/written=*/day=*"))
    assert len(kept) == 4 and len(list((tmp_path / "stats-latest").glob("upto=*"))) == 1
    assert not list((tmp_path / "stats").glob("batch_id=*"))


def test_rows_without_a_time_survive_compaction(spark, tmp_path):
    where = (str(tmp_path / "stats"), REALTIME_STATS, [], "stat_time")
    log = sinks.changelog(where[0])
    for batch_id in range(3):
        log(spark.createDataFrame([(None, batch_id, 1, 1, 0), (datetime(2025, 1, 1), 5, 1, 1, 0)], REALTIME_STATS), batch_id)
        sinks.compact(spark, *where)
        assert sorted(r.total_orders for r in sinks.read_latest(spark, *where).collect()) == [*range(batch_id + 1), *[5] * (batch_id + 1)]
    assert sinks.read_latest(spark, *where, since="2025-01-01").count() == 3


def test_dashboard_ranges_are_half_open(spark):
    rows = spark.createDataFrame(
        [(datetime(2025, 1, d), f"o{d}", "p", 1, 600_000, "x") for d in (1, 2, 3)], HIGH_VALUE_ORDERS
    )
    assert dashboard.high_value_count(rows, "2025-01-01", "2025-01-03").first()[0] == 2


def test_contracts_name_every_output_table():
    assert {name: len(schema) for name, schema in OUTPUT_TABLES.items()} == {
        "popular_products": 5,
        "suspicious_ips": 4,
        "high_value_orders": 6,
        "realtime_stats": 5,
    }
    assert len(ORDER_MESSAGE) == 9


class Settings:
    """Stands in for a session with the given settings."""

    def __init__(self, **values):
        self.conf, self.values = self, values

    def get(self, name, default):
        return self.values.get(name, default)


def test_checkpoints_need_a_shared_folder():
    assert checkpoint_root(Settings(**{"spark.checkpoint.dir": "/shared/c"})) == "/shared/c"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Settings())


def test_views_over_the_change_logs(spark, tmp_path):
    """Windows changed in a second batch count once, high-value orders are all kept."""
    first, second = datetime(2025, 1, 1), datetime(2025, 1, 1, 0, 0, 30)
    stats = sinks.changelog(str(tmp_path / "realtime_stats"))
    stats(spark.createDataFrame([(first, 1, 10, 10, 0)], REALTIME_STATS), 0)
    stats(spark.createDataFrame([(first, 3, 60, 20, 0), (second, 1, 5, 5, 0)], REALTIME_STATS), 1)
    orders = sinks.changelog(str(tmp_path / "high_value_orders"))
    for batch_id in range(2):
        orders(spark.createDataFrame([(first, "a", "p", 1, 600_000, "x")], HIGH_VALUE_ORDERS), batch_id)
    assert register_views(spark, str(tmp_path), ["realtime_stats", "high_value_orders"]) == [
        "realtime_stats",
        "realtime_stats_changes",
        "high_value_orders",
    ]
    assert spark.sql("SELECT sum(total_orders) FROM realtime_stats").first()[0] == 4
    assert spark.sql("SELECT sum(total_orders), max(batch_id) FROM realtime_stats_changes").first()[:] == (5, 1)
    assert spark.table("high_value_orders").count() == 2


def test_dashboard_reads_only_the_days_it_shows(spark, tmp_path):
    path = str(tmp_path / "realtime_stats")
    rows = [(datetime(2025, 1, d), 1, 10, 10, 0) for d in range(1, 9)]
    sinks.changelog(path)(spark.createDataFrame(rows, REALTIME_STATS), 0)
    compact_tables(spark, str(tmp_path))
    shown = latest_table(spark, str(tmp_path), "realtime_stats", "2025-01-02", "2025-01-04")
    series = dashboard.order_series(shown, "2025-01-02", "2025-01-04")
    assert [r.stat_time.day for r in series.collect()] == [2, 3]
    plan = series._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"FileScan[^\n]*PartitionFilters: \[[^\]]*day", plan)
