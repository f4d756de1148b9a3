"""Bit tables of hash values, sized by what they hold and bounded, so that they may be sent to every task.

They spare work: a value that was put in always hits, others hit by chance and are sorted out elsewhere.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits for each value, and the least and most bits of a table as powers of two (8 KB and 16 MB).
BITS_EACH = 16
LEAST, MOST = 16, 27
#: The most bits of one that is broadcast as rows (half a million).
MOST_AS_ROWS = 24


def bits_for(count: int, most: int = MOST) -> int:
    """The size of a table for `count` values, as a power of two."""
    return min(most, max(LEAST, (BITS_EACH * count - 1).bit_length()))


def _slot(hashed: Column, bits: int) -> Column:
    return hashed.cast("long").bitwiseAND(F.lit((1 << bits) - 1))


def bit_words(df: DataFrame, hashed: Column, bits: int) -> DataFrame:
    """The table of a column of hash values, of which the last `bits` bits count, as rows of 32 bits: word, bits."""
    slot = _slot(hashed, bits)
    places = df.select(F.shiftright(slot, 5).cast("int").alias("word"), slot.bitwiseAND(F.lit(31)).cast("int").alias("at"))
    return places.select("word", F.expr("shiftleft(1L, at)").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))


def bit_table(df: DataFrame, hashed: Column, bits: int) -> bytes:
    """The table in one piece, for tasks."""
    found = bit_words(df, hashed, bits).toArrow()  # at most 2 ** (bits - 5) rows, whatever the input
    table = np.zeros(1 << (bits - 5), np.uint32)
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy().astype(np.uint32)
    return table.tobytes()


def with_hit(df: DataFrame, hashed: Column, words: DataFrame, bits: int, name: str) -> DataFrame:
    """`df` with `name`, whether a hash value of the row may be in the table `words`. Rows stay where they are.

    `words` is broadcast: at most 2 ** (bits - 5) rows of two numbers.
    """
    word, found = f"{name}_word", f"{name}_bits"
    table = F.broadcast(words.select(F.col("word").alias(word), F.col("bits").alias(found)))
    slot = _slot(hashed, bits)
    joined = df.join(table, F.shiftright(slot, 5).cast("int") == F.col(word), "left")
    bit = F.call_function("shiftright", F.col(found), slot.bitwiseAND(F.lit(31)).cast("int")).bitwiseAND(F.lit(1))
    return joined.withColumn(name, F.coalesce(bit == 1, F.lit(False))).drop(word, found)


def hits(table: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Whether values (unsigned, 64 bits) may be in a table."""
    slot = hashed & np.uint64(32 * len(table) - 1)
    return (table[(slot >> np.uint64(5)).astype(np.int64)] >> (slot & np.uint64(31)).astype(np.uint32)) & 1 == 1
