"""What a micro-batch is handed to. Every sink is a function of (batch, batch id) for `foreachBatch`."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderwatch.functions.scalars import money_text
from orderwatch.operators.ranking import top_per_window
from orderwatch.operators.rolling import order_verdict
from orderwatch.operators.windows import product_lists, suspicious_ip_products
from orderwatch.schemas import with_captions
from orderwatch.streaming.folders import finished, names, remove

Sink = Callable[[DataFrame, int], None]


def adaptively(sink: Sink) -> Sink:
    """Lets Spark adapt the sink's own work at run time.

    Spark turns adaptive execution off in the session of a stateful query, since state partitions must
    not change; the batch handed to the sink is computed already, and what the sink does with it may.
    """
    setting = "spark.sql.adaptive.enabled"

    def write(batch: DataFrame, batch_id: int) -> None:
        conf = batch.sparkSession.conf
        before = conf.get(setting)
        conf.set(setting, "true")
        try:
            sink(batch, batch_id)
        finally:
            conf.set(setting, before)

    return write


def both(*sinks: Sink) -> Sink:
    """Hands every batch to each of the sinks in turn, computing it once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            for sink in sinks:
                sink(kept, batch_id)
        finally:
            kept.unpersist()

    return write


def changelog(path: str) -> Sink:
    """Keeps every batch that has rows under its own folder, which a repeated batch replaces: no duplicates after a
    restart. The first batch is kept also without rows, so that there is something to read.

    The rows are rebalanced first: a batch would otherwise leave one small file per state partition.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.hint("rebalance").write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    whole = skip_empty(write)
    return lambda batch, batch_id: (whole if batch_id else write)(batch, batch_id)


def read_changelog(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows handed on and not compacted yet, with the batch they came in. A window appears once per change."""
    with_batch = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(with_batch).parquet(path)


def latest(changes: DataFrame, keys: list[str]) -> DataFrame:
    """The newest row of each key. One shuffle, and each task passes on one row per key.

    A key occurs once per batch at most, so the columns may be taken one by one; that keeps the
    aggregate on hashed fixed-width buffers.
    """
    return _newest(changes, keys).drop("batch_id")


def _newest(changes: DataFrame, keys: list[str]) -> DataFrame:
    values = [name for name in changes.columns if name not in (*keys, "batch_id")]
    newest = [F.max_by(name, "batch_id").alias(name) for name in values]
    return changes.groupBy(*keys).agg(*newest, F.max("batch_id").alias("batch_id")).select(*changes.columns)


def _whole_days(spark: SparkSession, path: str) -> tuple[dict[date | None, int], int]:
    """Which compaction wrote each day of the latest view, by the newest marker, and the batch it reaches; {} and -1
    before any. A row for each day."""
    marks = finished(spark, f"{path}-latest", "upto=")
    if not marks:
        return {}, -1
    kind = "day DATE, written BIGINT"
    return {r.day: r.written for r in spark.read.schema(kind).parquet(f"{path}-latest/upto={marks[-1]}").collect()}, marks[-1]


def _day_folder(path: str, day: date | None, written: int) -> str:
    return f"{path}-latest/rows/written={written}/day={day or '__HIVE_DEFAULT_PARTITION__'}"


def _compacted(spark: SparkSession, path: str, schema: T.StructType, days: dict[date | None, int]) -> DataFrame:
    """The compacted rows of some days with their `batch_id` and `day`."""
    extra = [T.StructField("batch_id", T.LongType()), T.StructField("day", T.DateType())]
    kind = T.StructType([*schema.fields, *extra])
    if not days:
        return spark.createDataFrame([], kind)
    with_written = T.StructType([*kind.fields, T.StructField("written", T.LongType())])
    reader = spark.read.schema(with_written).option("basePath", f"{path}-latest/rows")
    return reader.parquet(*[_day_folder(path, day, written) for day, written in days.items()]).select(*kind.names)


def _changes_after(spark: SparkSession, path: str, schema: T.StructType, batch: int, time: str) -> DataFrame:
    folders = [f"{path}/batch_id={n}" for n in finished(spark, path, "batch_id=") if n > batch]
    with_batch = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    reader = spark.read.schema(with_batch).option("basePath", path)
    changes = reader.parquet(*folders) if folders else spark.createDataFrame([], with_batch)
    return changes.withColumn("day", F.to_date(time))


def read_latest(
    spark: SparkSession, path: str, schema: T.StructType, keys: list[str], time: str, since: str = "", until: str = ""
) -> DataFrame:
    """The newest row of each key, or all rows without keys: what is compacted, and the changes after that.

    `since` and `until` are days; only those are read, and only those of the result are whole. The column `day`
    stays, for further pruning.
    """
    days, upto = _whole_days(spark, path)
    shown = {d: n for d, n in days.items() if not (since or until) or d and (not since or str(d) >= since) and (not until or str(d) <= until)}
    rows = _changes_after(spark, path, schema, upto, time).unionByName(_compacted(spark, path, schema, shown))
    if since:
        rows = rows.filter(F.col("day") >= F.to_date(F.lit(since)))
    if until:
        rows = rows.filter(F.col("day") <= F.to_date(F.lit(until)))
    return (_newest(rows, [*keys, "day"]) if keys else rows).drop("batch_id")


def compact(spark: SparkSession, path: str, schema: T.StructType, keys: list[str], time: str) -> int:
    """Works the finished batches of a change log into its latest view, by day of `time`, and removes them.

    Only days that changed are read and written again, into folders of this compaction. Then a marker, written last, says
    which folders hold each day and which batch they reach. Only after that is removed what it replaces, so that a run
    that breaks off at any point leaves the view as it was or as it will be, and the next one tidies up. To be run
    between batches, or with the last `batch_id` still to be repeated left alone by the caller. Returns the batch the
    view reaches.
    """
    days, upto = _whole_days(spark, path)
    batches = [n for n in finished(spark, path, "batch_id=") if n > upto]
    if batches:
        changes = _changes_after(spark, path, schema, upto, time)
        changed = {row.day for row in changes.select("day").distinct().collect()}
        before = _compacted(spark, path, schema, {day: n for day, n in days.items() if day in changed})
        changes = changes.unionByName(before)
        rows = _newest(changes, [*keys, "day"]) if keys else changes
        upto = batches[-1]
        # The rebalance hint splits large days and joins small ones, so files come out even.
        rows.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(f"{path}-latest/rows/written={upto}")
        days |= dict.fromkeys(changed, upto)
        _mark(spark, path, days, upto)
    _tidy(spark, path, days, upto)
    return upto


def _mark(spark: SparkSession, path: str, days: dict[date | None, int], upto: int) -> None:
    marker = spark.createDataFrame(list(days.items()), "day DATE, written BIGINT").coalesce(1)
    marker.write.mode("overwrite").parquet(f"{path}-latest/upto={upto}")


def _tidy(spark: SparkSession, path: str, days: dict[date | None, int], upto: int) -> None:
    """Removes batches that the view holds, markers before the newest, and days that another folder holds."""
    for number in finished(spark, path, "batch_id="):
        if number <= upto:
            remove(spark, f"{path}/batch_id={number}")
    for mark in finished(spark, f"{path}-latest", "upto=")[:-1]:
        remove(spark, f"{path}-latest/upto={mark}")
    kept = {_day_folder(path, day, written) for day, written in days.items()}
    written = set(days.values())
    for folder in names(spark, f"{path}-latest/rows"):
        whole = f"{path}-latest/rows/{folder}"
        if folder.startswith("written=") and int(folder.removeprefix("written=")) not in written:
            remove(spark, whole)
            continue
        for day in names(spark, whole):
            if day.startswith("day=") and f"{whole}/{day}" not in kept:
                remove(spark, f"{whole}/{day}")


def ranked(sink: Sink, by: str, k: int = 5, ties: list[str] | None = None) -> Sink:
    """Hands on the k largest rows of each window of a batch, with their rank.

    For an aggregate in append mode, which hands on all rows of a window in one batch.
    """
    return lambda batch, batch_id: sink(top_per_window(batch, by, k, ties), batch_id)


def jdbc_append(url: str, table: str, properties: dict[str, str], with_batch_id: bool = False) -> Sink:
    """Appends each batch to a database table by column name; the database fills its other columns.

    A batch that fails halfway is appended again, so a target that must not hold duplicates needs the
    batch id as a column. Rows are rebalanced, so that a small batch opens one connection and not one
    per state partition; `numPartitions` bounds the connections, `batchsize` the rows per statement.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")) if with_batch_id else batch
        rows.hint("rebalance").write.jdbc(url=url, table=table, mode="append", properties=properties)

    return write


def skip_empty(sink: Sink) -> Sink:
    """Hands a batch on only if it has rows, computing it once for both."""

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            if not kept.isEmpty():
                sink(kept, batch_id)
        finally:
            kept.unpersist()

    return write


def _text(value: object) -> str:
    return ", ".join(map(str, value)) if isinstance(value, list) else str(value)


def _table(columns: list[str], rows: list) -> str:
    cells = [columns, *[[_text(v) for v in row] for row in rows]]
    widths = [max(len(line[i]) for line in cells) for i in range(len(columns))]
    return "\n".join(" | ".join(c.ljust(w) for c, w in zip(line, widths)) for line in cells)


def judged(sink: Sink, limit: int = 10, threshold: int = 500_000) -> Sink:
    """Adds the verdict to each order of a batch with `recent_orders` and hands the batch on."""
    return lambda batch, batch_id: sink(order_verdict(batch, limit, threshold), batch_id)


def report(
    title: str,
    k: int = 20,
    order: Callable[[DataFrame], DataFrame] | None = None,
    captions: str | None = None,
    empty: str | None = None,
    counted: bool = False,
    out: Callable[[str], None] = print,
) -> Sink:
    """Prints up to k rows of each batch under a title; `empty`, or nothing, for a batch without rows.

    One read of k + 1 rows tells whether there are rows and whether there are more. With `counted`, the
    number of rows is printed too, and the batch is kept so that counting does not compute it again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist() if counted else batch
        try:
            shown = order(kept) if order else kept
            if captions == "popular_products":
                shown = shown.withColumn("total_sales", money_text(F.col("total_sales")))
            if captions:
                shown = with_captions(shown, captions)
            rows = shown.take(k + 1)
            if not rows:
                if empty:
                    out(f"{title} (batch {batch_id}): {empty}")
                return
            lines = [f"{title} (batch {batch_id})", _table(shown.columns, rows[:k])]
            if counted:
                lines.append(f"{shown.count()} rows")
            elif len(rows) > k:
                lines.append(f"first {k} rows")
            out("\n".join(lines))
        finally:
            if counted:
                kept.unpersist()

    return write


def verdict_report(k: int = 20, normal: bool = False, out: Callable[[str], None] = print) -> Sink:
    """Prints the first k judged orders of each batch, the most recent counts first, and how many there were.

    Normal ones only if asked for. An extra beside a sink that keeps every verdict.
    """

    def shown(batch: DataFrame) -> DataFrame:
        rows = batch if normal else batch.filter(F.col("verdict") != "normal")
        return rows.orderBy(F.desc("recent_orders"), "timestamp", "order_id").select(
            "verdict",
            "ip_address",
            "recent_orders",
            "order_id",
            "product_name",
            "quantity",
            money_text(F.col("total_price")).alias("total_price"),
        )

    return report("Orders by verdict", k, order=shown, counted=True, out=out)


def suspicious_report(
    title: str,
    k: int = 20,
    limit: int = 10,
    empty: str | None = None,
    out: Callable[[str], None] = print,
) -> Sink:
    """Prints, of batches of `ip_products`, the addresses with at least `limit` orders and what they bought."""

    def lists(batch: DataFrame) -> DataFrame:
        rows = product_lists(suspicious_ip_products(batch, limit)).orderBy("window_start", "ip_address")
        bought = F.transform("products", lambda run: F.concat(run["product_name"], F.lit(" x"), run["copies"]))
        shown = rows.withColumns({"total_spent": money_text(F.col("total_spent")), "products": bought})
        return with_captions(shown, "suspicious_ips")

    return report(title, k, order=lists, empty=empty, out=out)
