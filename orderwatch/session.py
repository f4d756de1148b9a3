"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    # Only the changed keys of the state travel to the checkpoint, not a snapshot per batch.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Counting the state's rows costs a lookup per write and serves a metric only.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def build_session(app: str, master: str | None = None, time_zone: str = "UTC", **extra: str) -> SparkSession:
    """A session with the engine's settings. `extra` takes setting names with `__` for the dots.

    The shuffle partition count of a streaming query is fixed by its first checkpoint, so pass
    `spark__sql__shuffle__partitions` sized for the cluster before a query starts for the first time.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = SETTINGS | {"spark.sql.session.timeZone": time_zone}
    settings |= {name.replace("__", "."): value for name, value in extra.items()}
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
