"""Runs a streaming job: python -m orderwatch tables|reports|alerts --format kafka --option key=value ...
or works change logs into their latest views: python -m orderwatch compact --output folder

Meant for spark-submit, which sets the master and brings the topic and database packages.
"""

from __future__ import annotations

import argparse
import os

from orderwatch.functions.scalars import with_total_price
from orderwatch.plans.views import compact_tables
from orderwatch.schemas import OUTPUT_TABLES
from orderwatch.session import build_session
from orderwatch.sources.codec import decode_orders, observe_bad_records
from orderwatch.sources.orders import read_orders
from orderwatch.streaming import jobs
from orderwatch.streaming.sinks import Sink, both, changelog, jdbc_append, skip_empty, verdict_report


def pairs(values: list[str]) -> dict[str, str]:
    return dict(value.split("=", 1) for value in values)


def table_sink(args: argparse.Namespace, name: str) -> Sink:
    """A database table where a JDBC address is given, a change log under a folder otherwise.

    User and password come from ORDERWATCH_DB_USER and ORDERWATCH_DB_PASSWORD.
    """
    if not args.jdbc_url:
        return changelog(f"{args.output}/{name}")
    properties = pairs(args.jdbc_property)
    for key in ("user", "password"):
        if value := os.environ.get(f"ORDERWATCH_DB_{key.upper()}"):
            properties[key] = value
    return skip_empty(jdbc_append(args.jdbc_url, name, properties))


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="orderwatch", description=__doc__)
    parser.add_argument("job", choices=["tables", "reports", "alerts", "compact"])
    parser.add_argument("--format", default="kafka", choices=["kafka", "json", "parquet"])
    parser.add_argument("--option", action="append", default=[], help="source option, key=value")
    parser.add_argument("--checkpoints", help="shared folder; default is spark.checkpoint.dir")
    parser.add_argument("--time-zone", default="UTC", help="session time zone, such as Asia/Seoul")
    parser.add_argument("--trigger", help="interval, or 'once' to work off what is there")
    target = parser.add_mutually_exclusive_group()
    target.add_argument("--output", help="folder of the change logs")
    target.add_argument("--jdbc-url")
    parser.add_argument("--jdbc-property", action="append", default=[], help="key=value, such as driver=...")
    parser.add_argument("--look-back", type=int, default=600, help="alerts: seconds in which orders count")
    parser.add_argument("--limit", type=int, default=10, help="alerts: orders of one address that are too many")
    parser.add_argument("--threshold", type=int, default=500_000, help="alerts: amount of a high-value order")
    parser.add_argument("--shown", type=int, default=20, help="alerts: orders printed of each batch, beside the sink")
    args = parser.parse_args(argv)
    if args.job in ("tables", "alerts") and not (args.output or args.jdbc_url):
        parser.error(f"{args.job} needs --output or --jdbc-url")
    if args.job == "compact" and not args.output:
        parser.error("compact needs --output")

    spark = build_session(f"orderwatch-{args.job}", time_zone=args.time_zone)
    if args.job == "compact":
        for name, batch in compact_tables(spark, args.output).items():
            print(f"{name}: compacted up to batch {batch}")
        return
    decoded = observe_bad_records(decode_orders(read_orders(spark, args.format, pairs(args.option))))
    orders = with_total_price(decoded)
    if args.job == "tables":
        sinks = {name: table_sink(args, name) for name in OUTPUT_TABLES}
        queries = jobs.run_tables(orders, sinks, args.checkpoints, args.trigger)
    elif args.job == "reports":
        queries = jobs.run_reports(orders, args.checkpoints, args.trigger)
    else:
        sink = both(table_sink(args, "verdicts"), verdict_report(args.shown))
        queries = jobs.run_alerts(
            orders, sink, args.checkpoints, args.look_back, args.limit, args.threshold, args.trigger
        )
    if args.trigger == jobs.ONCE:
        for query in queries:
            query.awaitTermination()
    else:
        jobs.await_any(spark)


if __name__ == "__main__":
    main()
