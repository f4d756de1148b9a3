"""What several operators share: reading tables, cutting lineage, hashing, word splitting."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderwatch.llm.bit_table import MOST_AS_ROWS, bit_words, bits_for, with_hit

#: The six white-space characters of the contracts, [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"
#: The most rows of a small table that are broadcast.
BROADCAST = 4096


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of `x`."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str) -> Column:
    """A text column as string, null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in `spark.checkpoint.dir`, which executors share.

    Where none is named, as in tests, one beside the tables of the warehouse, which executors share as well.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints"


def cut(df: DataFrame) -> DataFrame:
    """Writes `df` to the shared folder and goes on from there."""
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        df.sparkSession.sparkContext.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def most_frequent(counts: DataFrame, most: int, column: str = "n") -> DataFrame:
    """At most `most` rows with the largest counts, and all that are as large as these up to a 64th of a doubling.

    The bound comes from a histogram of fixed size, so no task and not the driver sorts what all tasks hold. Rows that
    do not all fit below the bound are left out together.
    """
    step = F.floor(F.log2(F.col(column)) * 64)
    histogram = counts.filter(F.col(column) > 0).groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("rows")).collect()
    lowest, taken = None, 0
    for row in sorted(histogram, reverse=True):
        taken += row.rows
        if taken > most:
            break
        lowest = row.step
    return counts.filter(F.lit(False) if lowest is None else (F.col(column) > 0) & (step >= lowest))


def keep_rows(docs: DataFrame, decided: DataFrame, digest: Column, id_col: str, text_col: str) -> DataFrame:
    """`docs` by decisions on its rows: `decided` has doc_id, digest and kept, of which kept follows from the others.

    A row goes by its own id (null is one) and digest. Of rows equal in both the one with the longest text stays.
    The columns of `docs` may have any names. A bit table of what may go tells most rows that they stay; they are not
    shuffled. The others are joined.
    """
    id_name, digest_name, own, met = (_unused(name, docs) for name in ("decided_id", "decided_digest", "own_digest", "met"))
    marks = decided.groupBy("doc_id", "digest").agg(F.bool_and("kept").alias("kept"), F.count(F.lit(1)).alias("times"))
    marks = cut(marks.filter("not kept or times > 1"))
    bits = bits_for(marks.count(), MOST_AS_ROWS)
    words = cut(bit_words(marks, F.xxhash64("doc_id", "digest"), bits))
    marks = marks.select(F.col("doc_id").alias(id_name), F.col("digest").alias(digest_name), "kept")
    keyed = with_hit(docs.withColumn(own, digest), F.xxhash64(id_col, own), words, bits, met)
    alike = keyed[id_col].eqNullSafe(F.col(id_name)) & (F.col(own) == F.col(digest_name))
    hit = keyed.filter(F.col(met)).drop(met)
    out = keyed.filter(~F.col(met)).drop(met, own)
    out = out.unionByName(hit.join(marks.drop("kept"), alike, "left_anti").drop(own))
    repeated = marks.filter("kept").drop("kept")
    if repeated.isEmpty():
        return out
    several = hit.join(repeated, alike, "left_semi")
    row, text = F.struct(*[F.col(f"`{name}`") for name in docs.columns]), text_or_empty(text_col)
    one = several.groupBy(F.col(id_col), own).agg(F.max_by(row, F.struct(F.length(text), text)).alias("row"))
    return out.unionByName(one.select("row.*"))


def _unused(name: str, docs: DataFrame) -> str:
    while name in docs.columns:
        name += "_"
    return name


class Memo(dict):
    """Results by key, computed when first asked for.

    Two generations bound the memory: once the younger holds more than `most`, `trim` makes it the older one, and
    what is asked for again moves up.
    """

    def __init__(self, make, most: int = 300_000):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value

    def trim(self) -> None:
        if len(self) > self.most:
            self.older = dict(self)
            self.clear()
