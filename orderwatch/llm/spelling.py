"""Words and their spelling variants: exact neighbours at one edit, from the nodes of two tries.

The distinct words are sorted over the cluster. The beginnings of all words are the nodes of a trie, which are numbered
along the sorted words: a word shares as many nodes with the word before as the two share letters, and opens new ones
for the rest. Reversed words are numbered in the same way. A word with one letter left out is then a pair of whole
numbers, the node before that letter and the node behind it; a word as it stands, cut at any place, is such a pair too.
Two words differ by a replaced letter when both have a pair that leaves a letter out there, and by an inserted letter when
a pair of one that leaves a letter out is a pair of the other that leaves none. A join on the two numbers thus finds all
neighbours, and nothing else. Nodes with a single word below them are in no shared pair and are not handed on.

A pair fixes all letters but one, so no more words share it than the alphabet has letters.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderwatch.llm.common import cut, text_or_empty

LEAST_LETTERS = 7
LEAST_TIMES = 2
#: A form occurs at least so many times as often as its variant.
RATIO = 10
#: Fixed value: of one run in so many, by checksum, a letter is deleted.
DELETED = 31
#: Distinct words counted in one go, and words in a part of the sorted dictionary.
COUNTED = 200_000
PART_WORDS = 50_000
#: Bits for what a task numbers; above them is the number of the part.
LOCAL = 40
#: Rows handed on at a time.
SLICE = 4096
#: What a pair of nodes leaves out of its word: nothing, a letter like the one before it, another letter.
NOTHING, REPEATED, LETTER = 0, 1, 2


def runs_of(text: str, least: int) -> Counter[str]:
    """How often each maximal run of at least `least` letters occurs, A-Z lower-cased."""
    lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    return Counter(re.findall("[a-zÀ-ÿ]{%d,}" % least, lowered))


def word_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_LETTERS, times: int = LEAST_TIMES
) -> DataFrame:
    """The words of all texts that occur at least `times` times: word, n.

    A word is a run of letters as the contract changes it, if it still has `least` letters then. A null id counts as an
    empty one, repeated rows count each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()
        for batch in batches:
            for own, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for word, n in runs_of(text, least).items():
                    checksum = zlib.crc32(f"{own}:{word}".encode())
                    if checksum % DELETED == 0:
                        at = checksum % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least:
                            continue
                    found[word] += n
                if len(found) > COUNTED:
                    yield from counted(found)
                    found.clear()
        yield from counted(found)

    def counted(found: Counter[str]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], names=["word", "n"]
        )

    texts = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), text_or_empty(text_col).alias("text"))
    counts = texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= times)


def shared_letters(a: str, b: str) -> int:
    """How many letters two words begin with alike."""
    low, most = 0, min(len(a), len(b))
    while most - low > 8:  # words may be very long
        middle = (low + most) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            most = middle
    while low < most and a[low] == b[low]:
        low += 1
    return low


class Numbering:
    """The nodes of the beginnings of sorted words, from the empty one on, word by word.

    A node is numbered by the letters before it in its part, whatever it shares, so that only the nodes that go on from
    the part before have foreign numbers.
    """

    def __init__(self, part: int, before: str = "", nodes: list[int] | None = None):
        self.base, self.before = part << LOCAL, before
        self.nodes = list(nodes or [self.base])

    def add(self, word: str) -> int:
        """How many letters `word` shares with the one before."""
        shared = shared_letters(self.before, word)
        del self.nodes[shared + 1 :]
        self.nodes.extend(range(self.base + shared + 1, self.base + len(word) + 1))
        self.base += len(word) + 1
        self.before = word
        return shared


class Bounds:
    """What each part of the sorted words needs of its neighbours: a row per part, like the bounds Spark sorts by."""

    def __init__(self, ends: Iterable[tuple[int, str, str, list[int]]]):
        """`ends` has for each part its number, its first and last word, and the nodes of the last by themselves."""
        #: By part: the last word before it and that word's nodes; the first word behind it.
        self.before: dict[int, tuple[str, list[int]]] = {}
        self.behind: dict[int, str] = {}
        last, nodes, previous = "", [], -1
        for part, first, last_own, own in sorted(ends):
            self.before[part], self.behind[previous] = (last, nodes), first
            shared, root = shared_letters(last, first) if nodes else -1, part << LOCAL
            # A node of the part's first word that it shares with the word before the part has that word's number.
            nodes = [nodes[i] if i <= shared and node == root + i else node for i, node in enumerate(own)]
            last, previous = last_own, part

    def walk(self, batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, list[int], dict]]:
        """For the words of a part: the place in the dictionary, the nodes that other words share, and the row."""
        state, held, part = None, None, 0
        for batch in batches:
            for row in batch.to_pylist():
                if state is None:
                    part = row["part"]
                    state, place = Numbering(part, *self.before[part]), part << LOCAL
                shared = state.add(row["word"])
                if held:
                    yield self._known(*held, shared)
                held = (place, row, state.nodes[:], shared)
                place += 1
        if held:
            yield self._known(*held, shared_letters(held[1]["word"], self.behind.get(part, "")))

    @staticmethod
    def _known(place: int, row: dict, nodes: list[int], before: int, behind: int) -> tuple[int, list[int], dict]:
        return place, nodes[: max(before, behind) + 1], row


def sorted_parts(words: DataFrame) -> tuple[DataFrame, Bounds]:
    """`words` (`word` without nulls or repeats, and any others) sorted over the cluster, with `part`, and the bounds."""
    parts = max(words.sparkSession.sparkContext.defaultParallelism, -(-words.count() // PART_WORDS))
    dealt = words.repartitionByRange(parts, "word").sortWithinPartitions("word")
    rows = cut(dealt.withColumn("part", F.spark_partition_id()))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, first, own = None, "", 0
        for batch in batches:
            for word, part in zip(batch.column("word").to_pylist(), batch.column("part").to_pylist(), strict=True):
                if state is None:
                    state, first, own = Numbering(part), word, part
                state.add(word)
        if state is not None:
            columns = [[own], [first], [state.before], [state.nodes]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    schema = pa.schema([("part", pa.int32()), ("first", pa.string()), ("last", pa.string()), ("nodes", pa.list_(pa.int64()))])
    found = rows.select("part", "word").mapInArrow(ends, "part int, first string, last string, nodes array<long>")
    return rows, Bounds(tuple(row) for row in found.collect())  # one row per part


def node_pairs(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of words (word, n): the dictionary (id, word, n), ids in order of words, and the pairs of nodes of each word.

    A pair has `before` and `behind`, two nodes, `left_out`, and id and n of its word. Pairs that no other word can
    share are missing.
    """
    ordered, bounds = sorted_parts(words)

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((place, row["word"], row["n"], nodes) for place, nodes, row in bounds.walk(batches))
        return _batches(rows, forward_names)

    forward_names = pa.schema([("id", pa.int64()), ("word", pa.string()), ("n", pa.int64()), ("nodes", pa.list_(pa.int64()))])
    known = cut(ordered.mapInArrow(forward, "id long, word string, n long, nodes array<long>"))
    turned, turned_bounds = sorted_parts(known.select(F.reverse("word").alias("word"), "id", "n", "nodes"))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(each(batches), pair_names)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for _, after, row in turned_bounds.walk(batches):
            word, nodes, own, n = row["word"][::-1], row["nodes"], row["id"], row["n"]
            size, deepest = len(word), len(after) - 1
            for i in range(max(0, size - deepest), min(len(nodes) - 1, size) + 1):
                yield nodes[i], after[size - i], NOTHING, own, n
            for i in range(max(0, size - 1 - deepest), min(len(nodes) - 1, size - 1) + 1):
                left_out = REPEATED if i and word[i] == word[i - 1] else LETTER
                yield nodes[i], after[size - 1 - i], left_out, own, n

    pair_names = pa.schema(
        [("before", pa.int64()), ("behind", pa.int64()), ("left_out", pa.int32()), ("id", pa.int64()), ("n", pa.int64())]
    )
    kind = "before long, behind long, left_out int, id long, n long"
    return known.drop("nodes"), turned.mapInArrow(pairs, kind)


def _batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    rows = iter(rows)
    while part := list(islice(rows, SLICE)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema, strict=True)], schema=schema)


def near_words(pairs: DataFrame) -> DataFrame:
    """Per word with a neighbour: id, n_near (its neighbours) and best, the most frequent of them (-n and id).

    Of the words of a pair of nodes, at most one leaves nothing out, and those that leave a letter out are as many as
    the alphabet has letters at most. Of equal letters in a row only the first is left out, so neighbours meet once.
    """
    row = F.struct((-F.col("n")).alias("less"), "id", "left_out")
    met = pairs.groupBy("before", "behind").agg(F.sort_array(F.collect_list(row)).alias("met")).filter(F.size("met") > 1)
    met = met.select(
        F.filter("met", lambda m: m["left_out"] != NOTHING).alias("without"),
        F.filter("met", lambda m: m["left_out"] == LETTER).alias("shorter"),
        F.filter("met", lambda m: m["left_out"] == NOTHING).alias("whole"),
        F.explode("met").alias("own"),
    )
    # One that leaves nothing out meets those of one letter more; others those of their length, and the shorter one.
    first = F.when(F.get("without", F.lit(0))["id"] == F.col("own.id"), F.get("without", F.lit(1)))
    replaced = first.otherwise(F.get("without", F.lit(0)))
    deleted = F.when(F.col("own.left_out") == LETTER, F.get("whole", F.lit(0)))
    best = F.when(F.col("own.left_out") == NOTHING, F.get("shorter", F.lit(0))).otherwise(F.least(replaced, deleted))
    others = F.size("without") - 1 + F.when(F.col("own.left_out") == LETTER, F.size("whole")).otherwise(0)
    n_near = F.when(F.col("own.left_out") == NOTHING, F.size("shorter")).otherwise(others)
    each = met.select(F.col("own.id").alias("id"), n_near.cast("long").alias("n_near"), best.alias("best"))
    each = each.filter("n_near > 0").select("id", "n_near", F.struct("best.less", "best.id").alias("best"))
    return each.groupBy("id").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """The links of `forms` (id, form) followed to their ends: id and root.

    A form is so much more frequent than its variant that a chain is short: each round halves it.
    """
    found = cut(forms.select("id", F.col("form").alias("root")))
    while True:
        further = found.select(F.col("id").alias("root"), F.col("root").alias("further"))
        found = cut(found.join(further, "root", "left").select("id", "root", "further"))
        if found.filter("further is not null").isEmpty():
            return found.select("id", "root")
        found = found.select("id", F.coalesce("further", "root").alias("root"))


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Of words (word, n), each once: word, form, root, n, n_near, form_n.

    Two words are near if they differ by one inserted, deleted or replaced letter. `form` is the near word of largest n
    (of equal ones the smallest) if that n is at least `ratio` times the word's, else null; `root` is where forms lead,
    the word itself without one. Null words are passed over. No words give no rows.
    """
    dictionary, pairs = node_pairs(cut(words.filter("word is not null").select("word", "n")))
    near = cut(near_words(pairs).select("id", "n_near", (-F.col("best.less")).alias("best_n"), F.col("best.id").alias("best")))
    counted = cut(dictionary.join(near, "id", "left"))
    forms = counted.filter(F.col("best_n") >= ratio * F.col("n")).select("id", F.col("best").alias("form"), F.col("best_n").alias("form_n"))
    named = lambda name: dictionary.select(F.col("id").alias(name), F.col("word").alias(f"{name}_word"))
    linked = forms.join(roots(forms), "id").join(named("form"), "form").join(named("root"), "root")
    out = counted.join(linked.select("id", "form_word", "root_word", "form_n"), "id", "left")
    return out.select(
        "word",
        F.col("form_word").alias("form"),
        F.coalesce("root_word", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        "form_n",
    )


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The variants among the words of `docs`: see `word_counts` and `variants`.

    Null and empty texts have no words; a word of any length is compared whole; other columns are neither read nor
    returned; no documents give no rows.
    """
    return variants(word_counts(docs, id_col, text_col))
