"""Folders numbered by batch in the shared store: listing finished ones and removing old ones."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _store(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm


def finished(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """The numbers of the folders `<prefix><number>` under `path` whose writer has ended, ascending."""
    folder, files, jvm = _store(spark, path)
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder) if status.isDirectory()]
    numbers = sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix) and n[len(prefix) :].isdecimal())
    done = lambda n: files.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{prefix}{n}/_SUCCESS"))
    return [n for n in numbers if done(n)]


def names(spark: SparkSession, path: str) -> list[str]:
    """The folders under `path`, whether their writer has ended or not."""
    folder, files, _ = _store(spark, path)
    if not files.exists(folder):
        return []
    return [status.getPath().getName() for status in files.listStatus(folder) if status.isDirectory()]


def remove(spark: SparkSession, path: str) -> None:
    folder, files, _ = _store(spark, path)
    files.delete(folder, True)
