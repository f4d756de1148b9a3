"""A quality classifier on random-indexing word vectors.

The most frequent words of the corpus each have a row of their own, the rest share rows by hash. Every row has a fixed
sparse random index vector; its word vector is the sum of the index vectors of the words around it, over all
documents. A document is the mean and the spread of the vectors of its words. A
two-layer network, fitted on a bounded sample of labelled documents, turns that into a logit, and a temperature
fitted on a part of the sample kept apart turns the logit into a probability.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderwatch.llm.common import cut, most_frequent, text_or_empty

#: The most words with a vector of their own, and the most bytes of one; the rows that all others share by hash. With
#: that the table of word vectors has a fixed size (6 MB). The README says what share of words the others are.
OWN_WORDS = 1 << 15
WORD_BYTES = 64
SHARED_ROWS = 1 << 14
DIMS = 32
NONZERO = 4
REACH = 2
#: The most labelled documents the network is fitted on.
SAMPLE = 12_000
HIDDEN = 24
THRESHOLD = 0.3

_TOKEN = re.compile(rb"[A-Za-z0-9\x80-\xff]+|[^A-Za-z0-9\x80-\xff\s]+")
#: The first rows stand for a word in capitals, a word that repeats the one before, and a text without words.
_SHOUTED, _AGAIN, _EMPTY, _MARKS = range(4)
#: Distinct words a task counts before it hands them on.
HELD = 200_000


@dataclass
class Vocabulary:
    """The row of each word: its own, or one by hash."""

    own: dict[bytes, int]

    @property
    def rows(self) -> int:
        return _MARKS + SHARED_ROWS + len(self.own)

    def row(self, word: bytes) -> int:
        return self.own.get(word) or _MARKS + (zlib.crc32(word) & (SHARED_ROWS - 1))

    def index_vectors(self) -> tuple[np.ndarray, np.ndarray]:
        """For each row the dimensions and signs of its index vector."""
        rng = np.random.default_rng(9)
        dims = np.argsort(rng.random((self.rows, DIMS)), axis=1)[:, :NONZERO]
        return dims, rng.choice(np.array([-1.0, 1.0]), (self.rows, NONZERO))

    def rows_of(self, text: str) -> np.ndarray:
        """Rows of the words and signs of a text in order; words in capitals and repeated words count as such too."""
        rows, last, row = [], b"", self.row
        for word in _TOKEN.findall(text.encode("utf-8", "replace")):
            if word == last:
                rows.append(_AGAIN)
            elif len(word) > 1 and word.isupper():
                rows.append(_SHOUTED)
            last = word
            rows.append(row(word.lower()))
        return np.array(rows or [_EMPTY], np.int64)


def vocabulary(docs: DataFrame, text_col: str = "text", most: int = OWN_WORDS) -> Vocabulary:
    """The most frequent words of all documents, at most `most`: see `most_frequent`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                found.update(_TOKEN.findall(text.encode("utf-8", "replace").lower()))
                if len(found) > HELD:
                    yield from counted(found)
                    found.clear()
        yield from counted(found)

    def counted(found: Counter[bytes]) -> Iterator[pa.RecordBatch]:
        words = [word for word in found if len(word) <= WORD_BYTES]
        columns = [pa.array(words, pa.binary()), pa.array([found[word] for word in words], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["word", "n"])

    counts = docs.select(text_or_empty(text_col).alias("text")).mapInArrow(run, "word binary, n long")
    counts = cut(counts.groupBy("word").agg(F.sum("n").alias("n")))
    words = sorted((-row.n, bytes(row.word)) for row in most_frequent(counts, most).collect())  # at most `most` short words
    return Vocabulary({word: _MARKS + SHARED_ROWS + i for i, (_, word) in enumerate(words)})


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))


def word_vectors(docs: DataFrame, words: Vocabulary, text_col: str = "text") -> np.ndarray:
    """The vector of every row, of length one: sums of index vectors over all documents, added up before the shuffle."""
    shared, size = docs.sparkSession.sparkContext.broadcast(words), words.rows

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = shared.value
        dims, signs = words.index_vectors()
        total = np.zeros(size * DIMS)

        def add(parts: list[np.ndarray]) -> None:
            gap = np.full(REACH, -1)
            rows = np.concatenate([x for p in parts for x in (p, gap)])
            for by in range(1, REACH + 1):
                for here, there in ((rows[:-by], rows[by:]), (rows[by:], rows[:-by])):
                    fine = (here >= 0) & (there >= 0)
                    here, there = here[fine] * DIMS, there[fine]
                    for n in range(NONZERO):
                        total[:] += np.bincount(here + dims[there, n], signs[there, n], size * DIMS)

        parts, held = [], 0
        for batch in batches:
            for text in batch["text"]:
                parts.append(words.rows_of(text))
                held += len(parts[-1])
                if held > 1_000_000:
                    add(parts)
                    parts, held = [], 0
        if parts:
            add(parts)
        table = total.reshape(size, DIMS).astype(np.int64)
        used = np.flatnonzero(table.any(axis=1))
        if len(used):
            for some in np.array_split(used, len(used) // 4096 + 1):
                yield pd.DataFrame({"row": some, "sums": list(table[some])})

    partial = docs.select(text_or_empty(text_col).alias("text")).mapInPandas(run, "row int, sums array<long>")
    summed = partial.groupBy("row").agg(F.array(*[F.sum(F.col("sums")[i]) for i in range(DIMS)]).alias("sums"))
    table = np.zeros((size, DIMS), np.float32)
    found = summed.toArrow()  # no more rows than the vocabulary has
    if found.num_rows:
        table[found.column("row").to_numpy()] = found.column("sums").combine_chunks().flatten().to_numpy().reshape(-1, DIMS)
    return table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)


def pooled(text: str, words: Vocabulary, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the word vectors, and the shares of shouted and repeated words."""
    rows = words.rows_of(text)
    used, counts = np.unique(rows, return_counts=True)
    weights = (counts / len(rows)).astype(np.float32)
    mean = weights @ vectors[used]
    spread = np.sqrt(np.maximum(weights @ vectors[used] ** 2 - mean**2, 0))
    marks = [(rows == mark).sum() / len(rows) for mark in (_SHOUTED, _AGAIN)]
    return np.concatenate((mean, spread, marks)).astype(np.float32)


@dataclass
class Network:
    """Two layers on standardised inputs, and a temperature."""

    centre: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum(((x - self.centre) / self.scale) @ self.first + self.first_bias, 0)
        return hidden @ self.second + self.second_bias

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 60, seed: int = 5) -> Network:
    """Adam on the log loss over four fifths of the rows, the temperature by search over the rest."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    held, used = order[: len(x) // 5], order[len(x) // 5 :]
    centre, scale = x[used].mean(axis=0), x[used].std(axis=0) + 1e-3
    z = (x - centre) / scale
    weights = [
        rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)),
        np.zeros(HIDDEN),
        rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN),
        np.zeros(1),
    ]
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in weights]
    step = 0
    for _ in range(rounds):
        for batch in np.array_split(rng.permutation(used), max(1, len(used) // 128)):
            a, b, c, d = weights
            inner = z[batch] @ a + b
            hidden = np.maximum(inner, 0)
            wrong = (1 / (1 + np.exp(-np.clip(hidden @ c + d, -30, 30))) - y[batch]) / len(batch)
            back = np.outer(wrong, c) * (inner > 0)
            slopes = [z[batch].T @ back + 1e-4 * a, back.sum(axis=0), hidden.T @ wrong + 1e-4 * c, wrong.sum(keepdims=True)]
            step += 1
            for w, (m, v), g in zip(weights, moments, slopes, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= 0.005 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    model = Network(centre, scale, weights[0], weights[1], weights[2], float(weights[3][0]), 1.0)
    if len(held):
        logits = model.logits(x[held])

        def loss(t: float) -> float:
            p = np.clip(1 / (1 + np.exp(-np.clip(logits / t, -30, 30))), 1e-6, 1 - 1e-6)
            return float(-(y[held] * np.log(p) + (1 - y[held]) * np.log(1 - p)).mean())

        model.temperature = min(np.geomspace(0.5, 8, 41), key=loss)
    return model


def held_out(id_col: str) -> Column:
    """Whether labels of this document are never learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


@dataclass
class QualityModel:
    words: Vocabulary
    vectors: np.ndarray
    network: Network | None

    def scores(self, texts: pd.Series) -> np.ndarray:
        if self.network is None or not len(texts):
            return np.full(len(texts), 0.5)
        return self.network.probabilities(np.stack([pooled(text, self.words, self.vectors) for text in texts]))


def train(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> QualityModel:
    """Word vectors of all documents and a network fitted on at most `sample` labelled ones, taken by a hash of the id.

    Labels of held-out documents, null labels and labels other than 0 and 1 are left alone. Where fewer than two
    classes are left, every score will be one half.
    """
    words = vocabulary(docs, text_col)
    vectors = word_vectors(docs, words, text_col)
    usable = labels.filter(~held_out(id_col) & F.col(label_col).isin(0, 1)).groupBy(id_col).agg(F.min(label_col).alias("y"))
    chosen = usable.orderBy(F.xxhash64(F.col(id_col)), F.col(id_col)).limit(sample)
    chosen = cut(chosen.select(F.col(id_col).alias("doc_id"), F.col("y").cast("double").alias("y")))
    shared = docs.sparkSession.sparkContext.broadcast((words, vectors))

    @F.pandas_udf("array<float>")
    def pool(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: pooled(text, *shared.value))

    # At most `sample` ids are broadcast, so that the texts stay where they are.
    # Of several texts of an id the one of least hash counts, so that a rerun learns from the same.
    least = F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
    rows = _texts(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(least)
    rows = rows.select("doc_id", "y", pool("text").alias("x")).orderBy("doc_id").collect()
    y = np.array([row.y for row in rows])
    if len(set(y.tolist())) < 2:
        return QualityModel(words, vectors, None)
    return QualityModel(words, vectors, fit(np.array([row.x for row in rows], np.float64), y))


def score_column(model: QualityModel, docs: DataFrame, text: Column) -> Column:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.scores(texts))

    return score(text)


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = THRESHOLD,
    sample: int = SAMPLE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: doc_id, held_out, score (0 to 1, higher: label 1 likelier) and predicted (1 from `threshold` on).

    A null text counts as empty and is scored like any other. A null id is not held out. Repeated rows are scored
    one by one; other columns are neither read nor returned.
    """
    texts = _texts(docs, id_col, text_col)
    model = train(docs, labels, sample, id_col, text_col)
    scored = texts.select("doc_id", held_out("doc_id").alias("held_out"), score_column(model, docs, F.col("text")).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = THRESHOLD,
    sample: int = SAMPLE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """`docs` without those scored below `threshold`, all columns as they were."""
    model = train(docs, labels, sample, id_col, text_col)
    return docs.filter(score_column(model, docs, text_or_empty(text_col)) >= threshold)
