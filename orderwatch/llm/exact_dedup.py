"""Exact copies by digest, with frequent digests settled before the shuffle.

A Misra-Gries sketch per task names the digests that may be frequent; sketches merge in two steps, so that no
task meets more than one sketch per branch. The named digests are counted exactly with a map-side aggregate,
their winners (at most `tracked` rows) are broadcast, and their rows are decided where they lie. All other
rows are shuffled by digest; none of their groups holds more than a small share of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderwatch.llm.common import BLANKS, cut, keep_rows, text_or_empty

#: Counters of a sketch, and with that the most winners that are broadcast. A digest with more than about
#: 3.5 / TRACKED of all rows is never missed.
TRACKED = 4096
BRANCHES = 64


def normalised(text: Column) -> Column:
    """The text without the six white-space characters."""
    return F.translate(text, BLANKS, "")


def frequent_digests(rows: DataFrame, column: str = "digest", tracked: int = TRACKED) -> DataFrame:
    """At most `tracked` values of `column`, all frequent ones among them."""
    sketch = F.expr(f"approx_top_k_accumulate({column}, {tracked})")
    branches = rows.groupBy((F.spark_partition_id() % BRANCHES).alias("branch")).agg(sketch.alias("sketch"))
    # Grouped by a constant: without a group, a task that meets no sketch would hand on one without a type.
    found = branches.groupBy(F.lit("all")).agg(F.expr("approx_top_k_combine(sketch)").alias("sketch"))
    named = found.select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {tracked})")).alias("found"))
    return named.filter("found.count > 1 and found.item is not null").select(F.col("found.item").alias(column))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tracked: int = TRACKED) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical without white space; null counts as empty, and empty texts form one
    group. Of a group the row with the most code points stays, then the smallest id, a null id last. Rows that
    repeat an id with the same text are one document: all of them carry the same decision. Other columns of
    `docs` are neither read nor returned. No rows give no rows.
    """
    text = text_or_empty(text_col)
    rows = cut(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.length(text).alias("chars"),
            F.sha2(normalised(text), 256).alias("digest"),
        )
    )
    best = F.min(F.struct((-F.col("chars")).alias("a"), F.col("doc_id").isNull().alias("b"), "doc_id"))
    counted = [best.alias("best"), F.count(F.lit(1)).alias("group_size")]
    winners = rows.join(F.broadcast(frequent_digests(rows, tracked=tracked)), "digest").groupBy("digest").agg(*counted)
    winners = cut(winners.select("digest", F.col("best.doc_id").alias("keep_id"), "group_size"))
    frequent = rows.join(F.broadcast(winners), "digest")
    alike = Window.partitionBy("digest")
    rest = rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti").select(
        "*", best.over(alike)["doc_id"].alias("keep_id"), F.count(F.lit(1)).over(alike).alias("group_size")
    )
    return frequent.unionByName(rest).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with one row of each group, all columns as they were.

    Rows are decided one by one: what shares its id with a copy, or like a copy has no id, stays unless its own text
    is one. Of rows that repeat an id with the same text one stays.
    """
    decided = exact_groups(docs, id_col, text_col).withColumnRenamed("text_sha256", "digest")
    return keep_rows(docs, decided, F.sha2(normalised(text_or_empty(text_col)), 256), id_col, text_col)
