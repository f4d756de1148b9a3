"""The output tables as views for SQL, and their compaction."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from orderwatch.schemas import OUTPUT_TABLES, TABLE_KEYS, TABLE_TIMES
from orderwatch.streaming.folders import finished
from orderwatch.streaming.sinks import compact, read_changelog, read_latest


def latest_table(spark: SparkSession, root: str, name: str, since: str = "", until: str = "") -> DataFrame:
    """An output table below `root` with the newest row of each key, or all rows if they never change."""
    keys = TABLE_KEYS.get(name, [])
    return read_latest(spark, f"{root}/{name}", OUTPUT_TABLES[name], keys, TABLE_TIMES[name], since, until)


def compact_tables(spark: SparkSession, root: str, tables: Iterable[str] = OUTPUT_TABLES) -> dict[str, int]:
    """Compacts the change logs below `root` that exist; returns the batch each now reaches."""
    return {
        name: compact(spark, f"{root}/{name}", OUTPUT_TABLES[name], TABLE_KEYS.get(name, []), TABLE_TIMES[name])
        for name in tables
        if finished(spark, f"{root}/{name}", "batch_id=")
    }


def register_views(spark: SparkSession, root: str, tables: Iterable[str] = OUTPUT_TABLES) -> list[str]:
    """Views below `root`: each table with its latest rows under its own name, and the changes not compacted yet
    under `<name>_changes`. High-value orders never change and have the one view.
    """
    names = []
    for name in tables:
        latest_table(spark, root, name).drop("day").createOrReplaceTempView(name)
        names.append(name)
        if name in TABLE_KEYS and finished(spark, f"{root}/{name}", "batch_id="):
            read_changelog(spark, f"{root}/{name}", OUTPUT_TABLES[name]).createOrReplaceTempView(f"{name}_changes")
            names.append(f"{name}_changes")
    return names
