"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores. Each query's whole result is computed and thrown
away (`noop`); streaming queries also write their change log and checkpoint.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderwatch.functions.scalars import with_total_price  # noqa: E402
from orderwatch.plans.catalog import QUERIES  # noqa: E402
from orderwatch.plans.replay import run_folder, stream_session  # noqa: E402
from orderwatch.schemas import OUTPUT_TABLES  # noqa: E402
from orderwatch.session import build_session  # noqa: E402
from orderwatch.sources.codec import decode_orders, encode_orders  # noqa: E402
from orderwatch.sources.feeds import lineitem_orders  # noqa: E402
from orderwatch.sources.orders import read_orders  # noqa: E402
from orderwatch.streaming.jobs import ONCE, run_tables  # noqa: E402
from orderwatch.streaming.sinks import changelog  # noqa: E402

HEADLINE = [
    "popular_products_tumbling",
    "popular_products_sliding",
    "suspicious_ips_tumbling",
    "suspicious_ips_sliding",
    "suspicious_ips_lines",
    "realtime_stats",
    "realtime_stats_enriched",
    "high_value_orders",
    "decode_orders",
    "bad_record_split",
    "sliding_window",
    "rolling_ip_count",
    "rolling_ip_count_ties",
    "rolling_ip_count_arrival",
    "order_verdict",
    "top5_overall",
    "top5_per_window",
    "counter_delta",
    "throughput_report",
    "emit_update",
    "emit_append",
    "emit_complete",
    "rolling_ip_count_stream",
    "fan_out",
]


def seconds(spark, name: str, sf_dir: str) -> float:
    begun = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begun


def feed_rate(spark, sf_dir: str) -> dict:
    """Order lines as JSON messages through all four table queries at once, from start to stop."""
    root = run_folder(spark)
    encode_orders(lineitem_orders(spark, sf_dir)).select("value").write.text(f"{root}/in")
    count = spark.read.text(f"{root}/in").count()
    session = stream_session(spark)
    orders = with_total_price(decode_orders(read_orders(session, "json", {"path": f"{root}/in"})))
    sinks = {name: changelog(f"{root}/out/{name}") for name in OUTPUT_TABLES}
    begun = time.perf_counter()
    for query in run_tables(orders, sinks, f"{root}/checkpoints", ONCE):
        query.awaitTermination()
    took = time.perf_counter() - begun
    return {"orders": count, "seconds": round(took, 3), "orders_per_second": round(count / took)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
        spark__sql__shuffle__partitions=cpus,
        spark__checkpoint__dir=os.path.abspath("spark-warehouse/checkpoints"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds(spark, "popular_products_tumbling", sf_dir)  # starts the executors and loads the classes
    names = sys.argv[1:] or HEADLINE
    best = {name: round(min(seconds(spark, name, sf_dir) for _ in range(runs)), 3) for name in names}
    feed = min((feed_rate(spark, sf_dir) for _ in range(runs)), key=lambda run: run["seconds"])
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(best.values()), 3),
                "unit": "sec",
                "queries": best,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "runs": runs,
                "table_queries_on_a_feed": feed,
            }
        )
    )


if __name__ == "__main__":
    main()
