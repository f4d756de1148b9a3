"""Collocations: phrases of two to five words that occur together more often than their parts would.

Everything is counted per language, exactly. Words come first. The most frequent of them get whole numbers as ids, in a
dictionary of bounded size that goes to every task, and texts become rows of ids. Phrases are then counted by length: in
a task they are packed, permuted and added up in counting quotient filters (see `quotient_filter`), cut by range; the
filters of a range, from all tasks, are merged in one place. A phrase can only be frequent if the two phrases of one word
less in it are, so a bit table of those, sent to all tasks, leaves most others out before they are counted. Phrases with
a word beyond the dictionary go the same way by length as text, added up by Spark.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderwatch.llm.bit_table import bit_table, bits_for, hits
from orderwatch.llm.common import BROADCAST, cut, most_frequent, text_or_empty
from orderwatch.llm.quotient_filter import Counts, Layout, counted, from_filter, hashed, merged, to_filter

LONGEST = 5
LEAST = 100
TOP = 2000
#: The most words of the dictionary, and the most bytes of one of them: some 32 MB at worst.
DICTIONARY = 1 << 19
WORD_BYTES = 64
#: Distinct words or phrases that a task adds up before it hands them on, and ids that it works on at a time.
HELD = 500_000
HELD_GRAMS = 4_000_000
IDS_AT_ONCE = 1_000_000
#: Phrases for a range, and the bounds of the number of ranges as powers of two.
RANGE_GRAMS = 1 << 20
LEAST_RANGES, MOST_RANGES = 10, 16
#: By how many tasks the phrases of a language are ranked first.
RANKED = 64

#: The marks that end a piece, [.,;:!?\x0A-\x0D], each turned into a line feed.
ENDS = bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9)


def pieces(text: str) -> Iterator[list[bytes]]:
    """The words of each piece of a text, A-Z lower-cased."""
    for piece in text.encode("utf-8", "surrogatepass").lower().translate(ENDS).split(b"\n"):
        yield piece.split()  # what white space is left, of the six, is blanks and tabs


def _texts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    return docs.select(lang.alias("lang"), text_or_empty(text_col).alias("text"))


def _rows(columns: dict, kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[c], kind) for c, kind in kinds.items()], names=list(kinds))


_COUNTED = {"lang": pa.string(), "phrase": pa.string(), "n": pa.int64()}


class Tally:
    """Phrases of a task added up by language, handed on when there are many."""

    def __init__(self):
        self.found: dict[str, Counter[bytes]] = {}
        self.size = 0

    def add(self, lang: str, phrases: Iterable[bytes]) -> None:
        counts = self.found.setdefault(lang, Counter())
        before = len(counts)
        counts.update(phrases)
        self.size += len(counts) - before

    def rows(self, least: int = 0) -> Iterator[pa.RecordBatch]:
        if self.size <= least:
            return
        for lang, counts in self.found.items():
            phrases = pa.array(counts.keys(), pa.binary()).cast(pa.string())
            yield _rows({"lang": [lang] * len(counts), "phrase": phrases, "n": list(counts.values())}, _COUNTED)
        self.__init__()


def word_counts(texts: DataFrame) -> DataFrame:
    """How often each word of `texts` (lang, text) occurs: lang, phrase, n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for words in pieces(text):
                    tally.add(lang, words)
                yield from tally.rows(HELD)
        yield from tally.rows()

    return texts.mapInArrow(run, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


class Dictionary:
    """Ids, from 1 on, of the most frequent words of all languages."""

    def __init__(self, frequent: DataFrame, most: int):
        """`frequent` has lang, phrase and n."""
        fit = frequent.filter(F.octet_length("phrase") <= WORD_BYTES)
        rows = most_frequent(fit, most).select("lang", "phrase").toArrow()  # at most `most` short words
        self.langs = [None, *rows.column("lang").to_pylist()]
        self.words = [None, *rows.column("phrase").cast(pa.binary()).to_pylist()]
        self.id_bits = max(LEAST_RANGES + 2, len(self.words).bit_length())

    def ids(self) -> dict[str, dict[bytes, int]]:
        by_lang: dict[str, dict[bytes, int]] = {}
        for i, (lang, word) in enumerate(zip(self.langs[1:], self.words[1:], strict=True), 1):
            by_lang.setdefault(lang, {})[word] = i
        return by_lang


def as_ids(texts: DataFrame, shared) -> DataFrame:
    """Texts as `ids`, 0 where a piece ends or a word has no id. Texts without ids are missing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value.ids()
        for batch in batches:
            out = []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if (id_of := known.get(lang)) is None:
                    continue
                row = [0]
                for words in pieces(text):
                    row += [id_of.get(word, 0) for word in words]
                    row.append(0)
                ids = np.array(row, np.int32)
                ids = ids[np.append(True, (ids[1:] | ids[:-1]) != 0)]  # one 0 for several
                if len(ids) > 1:
                    out.append(ids)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.int32()))], names=["ids"])

    return texts.mapInArrow(run, "ids array<int>")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The ids of texts, each text begun by 0, in arrays of some length."""
    held, size = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            held.append(batch.column("ids").slice(at, 256).flatten().to_numpy())
            size += len(held[-1])
            if size > IDS_AT_ONCE:
                yield np.concatenate(held).astype(np.uint64)
                held, size = [], 0
    if held:
        yield np.concatenate(held).astype(np.uint64)


def grams(texts: DataFrame, size: int, shared, range_bits: int, table: bytes | None, least: int) -> DataFrame:
    """The phrases of `size` words with ids that occur at least `least` times: lang, phrase, n and hash.

    `table` is the bit table of those of one word less, by `hash`.
    """
    context = texts.sparkSession.sparkContext
    id_bits = shared.value.id_bits
    layout, below = Layout(size, id_bits, range_bits), Layout(size - 1, id_bits, range_bits) if size > 2 else None
    table_shared = context.broadcast(table)

    def starts(ids: np.ndarray, parents: np.ndarray | None) -> np.ndarray:
        """Where phrases begin that may be frequent."""
        if parents is None:
            return np.flatnonzero((ids[:-1] != 0) & (ids[1:] != 0))
        alive = np.convolve(ids != 0, np.ones(size - 1, np.int64), "valid") == size - 1
        at = np.flatnonzero(alive)
        alive[at] = hits(parents, hashed(*below.pack(ids, at)))
        return np.flatnonzero(alive[:-1] & alive[1:])

    def filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parents = np.frombuffer(table_shared.value, np.uint32) if table_shared.value else None
        held: list[Counts] = []
        for ids in _slices(batches):
            if len(ids) >= size:
                held.append(counted(layout, ids, starts(ids, parents)))
            if sum(map(len, held)) > HELD_GRAMS:
                held = [merged(layout, held)]
                if len(held[0]) > HELD_GRAMS // 2:
                    yield from cut_by_range(held.pop())
        yield from cut_by_range(merged(layout, held))

    def cut_by_range(counts: Counts) -> Iterator[pa.RecordBatch]:
        if not len(counts):
            return
        numbers, begins = np.unique(layout.ranges(counts.left), return_index=True)
        ends = np.append(begins[1:], len(counts))
        part = lambda a, b: Counts(counts.left[a:b], counts.right[a:b], counts.n[a:b])
        made = [to_filter(layout, part(a, b)) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
        yield _rows({"range": numbers, "filter": made}, {"range": pa.int32(), "filter": pa.binary()})

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Filters come range by range."""
        dictionary, current, held, size_held = shared.value, -1, [], 0
        for batch in batches:
            for number, data in zip(batch.column("range").to_pylist(), batch.column("filter").to_pylist(), strict=True):
                if number != current:
                    yield from frequent(dictionary, held)
                    current, held, size_held = number, [], 0
                held.append(from_filter(layout, number, data))
                size_held += len(held[-1])
                if size_held > HELD_GRAMS + 2 * len(held[0]):
                    held = [merged(layout, held)]
                    size_held = len(held[0])
        yield from frequent(dictionary, held)

    def frequent(dictionary: Dictionary, held: list[Counts]) -> Iterator[pa.RecordBatch]:
        counts = merged(layout, held)
        at = np.flatnonzero(counts.n >= least)
        if not len(at):
            return
        left, right = counts.left[at], counts.right[at]
        ids = layout.unpack(left, right).tolist()
        phrases = pa.array([b" ".join([dictionary.words[i] for i in row]) for row in ids], pa.binary()).cast(pa.string())
        columns = {"lang": [dictionary.langs[row[0]] for row in ids], "phrase": phrases, "n": counts.n[at].astype(np.int64)}
        yield _rows(columns | {"hash": hashed(left, right).astype(np.int64)}, _COUNTED | {"hash": pa.int64()})

    blocks = texts.mapInArrow(filters, "range int, filter binary")
    parts = max(context.defaultParallelism, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = blocks.repartition(parts, "range").sortWithinPartitions("range")
    return dealt.mapInArrow(joined, "lang string, phrase string, n long, hash long")


def _text_hash(lang: Column, phrase: Column) -> Column:
    return F.crc32(F.concat_ws("\x00", lang, phrase))


def rare_grams(texts: DataFrame, size: int, shared, table: bytes, least: int) -> DataFrame:
    """As `grams`, the phrases with a word that has no id, without `hash`. `table` is by `_text_hash`."""
    table_shared = texts.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, parents = shared.value.ids(), np.frombuffer(table_shared.value, np.uint32)
        tally = Tally()
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                id_of, mark = known.get(lang, {}), lang.encode() + b"\x00"
                for words in pieces(text):
                    without = [i for i, word in enumerate(words) if word not in id_of]
                    begins = sorted({at for i in without for at in range(max(0, i - size + 1), min(i, len(words) - size) + 1)})
                    if not begins:
                        continue
                    both = [b" ".join(words[at + j : at + j + size - 1]) for at in begins for j in (0, 1)]
                    checksums = np.array([zlib.crc32(mark + phrase) for phrase in both], np.uint64)
                    alive = hits(parents, checksums).reshape(-1, 2).all(axis=1)
                    tally.add(lang, [b" ".join(words[at : at + size]) for at, ok in zip(begins, alive.tolist(), strict=True) if ok])
                yield from tally.rows(HELD)
        yield from tally.rows()

    rows = texts.mapInArrow(run, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    return rows.filter(F.col("n") >= least)


def phrase_counts(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    lang_col: str = "lang",
    text_col: str = "text",
    dictionary: int = DICTIONARY,
) -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to `longest` words that occur `least` times or more: lang, phrase, size, n; and lang, total words.

    Phrases overlap and lie within pieces. A null language is `und`, a null text is empty. A word is counted however long
    it is. Only languages with a frequent word have a total.
    """
    texts = _texts(docs, lang_col, text_col)
    spark = docs.sparkSession
    words = cut(word_counts(texts))
    frequent = cut(words.filter(F.col("n") >= least))
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    totals = cut(totals.join(frequent.select("lang").distinct(), "lang", "left_semi"))
    n_words = totals.agg(F.sum("total")).first()[0] or 0
    shared = spark.sparkContext.broadcast(Dictionary(frequent, dictionary))
    rest = frequent.count() > len(shared.value.words) - 1
    range_bits = min(MOST_RANGES, max(LEAST_RANGES, (n_words // RANGE_GRAMS).bit_length()), shared.value.id_bits)
    encoded = cut(as_ids(texts, shared))
    levels, table = [frequent.withColumn("size", F.lit(1))], None
    for size in range(2, longest + 1):
        found = cut(grams(encoded, size, shared, range_bits, table, least))
        bits = bits_for(found.count())
        table = bit_table(found, F.col("hash"), bits)
        level = found.drop("hash")
        if rest:
            before = levels[-1].select("lang", "phrase")
            of_text = bit_table(before, _text_hash(F.col("lang"), F.col("phrase")), bits_for(before.count()))
            level = cut(level.unionByName(rare_grams(texts, size, shared, of_text, least)))
        levels.append(level.withColumn("size", F.lit(size)))
    counts = levels[0]
    for level in levels[1:]:
        counts = counts.unionByName(level)
    return counts.select("lang", "phrase", "size", "n"), totals


def _joined(words: Column, begin, length) -> Column:
    return F.array_join(F.slice(words, begin, length), " ")


def score() -> Column:
    """1000 * a * n / (l * r) without its fraction, in whole numbers of up to 38 digits."""
    return F.expr("(CAST(1000 AS DECIMAL(38,0)) * a * n) div (CAST(l AS DECIMAL(38,0)) * r)")


def collocations(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    top: int = TOP,
    lang_col: str = "lang",
    text_col: str = "text",
    dictionary: int = DICTIONARY,
) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase occurs `a` times, at least `least`; of its cuts in two, with l and r occurrences, the one of lowest score,
    1000 * a * n / (l * r) without its fraction, counts, the first of equal ones. n is the words of the language. A
    phrase that lies in a longer candidate as frequent is left out. The first `top` of a language are returned, by score,
    then a, then phrase. Null and empty texts have no words, repeated rows count each, other columns are neither read
    nor returned; no documents give no rows. Scores are exact as long as 1000 * a * n has at most 38 digits.
    """
    counts, totals = phrase_counts(docs, longest, least, lang_col, text_col, dictionary)
    phrases = counts.filter("size > 1").withColumn("words", F.split("phrase", " "))
    # Between a phrase and a longer one as frequent lie phrases of each length, as frequent too: one word more is enough.
    within = F.array(*[_joined(F.col("words"), begin, F.col("size") - 1) for begin in (1, 2)])
    longer = phrases.filter("size > 2").select("lang", F.explode(within).alias("phrase"), "n")
    kept = phrases.join(longer, ["lang", "phrase", "n"], "left_anti").withColumnRenamed("n", "a")
    cuts = kept.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang",
        "phrase",
        "a",
        "cut",
        _joined(F.col("words"), 1, F.col("cut")).alias("first"),
        _joined(F.col("words"), F.col("cut") + 1, F.col("size") - F.col("cut")).alias("rest"),
    )
    of_part = lambda part, n: counts.select("lang", F.col("phrase").alias(part), F.col("n").alias(n))
    small = totals.withColumnRenamed("total", "n")
    small = F.broadcast(small) if totals.count() <= BROADCAST else small
    scored = cuts.join(of_part("first", "l"), ["lang", "first"]).join(of_part("rest", "r"), ["lang", "rest"]).join(small, "lang")
    lowest = F.min(F.struct(score().alias("score"), "cut", "a", "l", "r", "n")).alias("best")
    best = scored.groupBy("lang", "phrase").agg(lowest).select("lang", "phrase", "best.*")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    dealt = best.withColumn("dealt", F.pmod(F.xxhash64("phrase"), F.lit(RANKED)))
    place = F.row_number().over(Window.partitionBy("lang", "dealt").orderBy(*order))
    first = dealt.withColumn("place", place).filter(F.col("place") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    out = first.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
