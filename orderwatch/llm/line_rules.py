"""Quality rules: counts over a text, and its lines labelled as content or boilerplate by a linear-chain CRF.

The field scores each line by its features and each pair of neighbouring labels; Viterbi decoding gives the best
labelling of the whole text. The share of words in content lines decides whether the text is kept. Weights are
fitted by maximum likelihood on a bounded sample of documents: lines of documents marked bad and lines that
repeat are boilerplate, other lines of documents marked good are content.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderwatch.llm.common import BLANKS, cut, text_or_empty
from orderwatch.llm.quality import held_out

#: The contract's symbols and limits.
SYMBOLS = "#*$%&|<>"
FEWEST_WORDS = 50
MOST_REPEATED_PCT = 50

LEAST_CONTENT = 0.5
#: Of the fit: documents, lines of one sequence, sequences of one document (spread evenly over it).
SAMPLE = 2000
STRETCH = 64
STRETCHES = 8

_BLANK_TABLE = dict.fromkeys(map(ord, BLANKS))


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a window of three which occurs twice or more, all its places included."""
    if len(words) < 4:
        return 0
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    with np.errstate(over="ignore"):
        step = np.uint64(0x9E3779B97F4A7C15)
        windows = ((each[:-2] * step) ^ (each[:-2] >> np.uint64(29))) + each[1:-1]
        windows = ((windows * step) ^ (windows >> np.uint64(31))) + each[2:]
    _, place, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = np.flatnonzero(counts[place] > 1)
    marked = np.zeros(len(words), bool)
    for by in range(3):
        marked[again + by] = True
    return int(marked.sum())


def worded_lines(text: str) -> list[str]:
    return [line for line in text.split("\n") if line.strip(BLANKS)]


FEATURES = 13


def line_features(lines: list[str]) -> np.ndarray:
    """One row of FEATURES numbers, roughly from 0 to 1, for each line with a word."""
    seen: dict[str, int] = {}
    for line in lines:
        seen[line] = seen.get(line, 0) + 1
    rows = []
    for line in lines:
        words, size = line.split(), len(line)
        count = len(words) or 1
        symbols = sum(map(line.count, SYMBOLS))
        upper = sum(map(str.isupper, words))
        marks = sum(map(line.count, ".,;:!?"))
        letters = sum(map(len, words))
        rows.append(
            (
                1.0,
                min(1.0, count / 40),
                float(count < 4),
                min(1.0, letters / count / 12),
                min(1.0, 8 * symbols / size),
                float(symbols > count / 4),
                upper / count,
                min(1.0, marks / count),
                line.count("!") / count,
                float(line.rstrip()[-1:] in ".!?"),
                float(seen[line] > 1),
                len(set(words)) / count,
                sum(map(str.isdigit, line)) / size,
            )
        )
    return np.array(rows, np.float64).reshape(-1, FEATURES)


@dataclass
class Field:
    """Scores of labels 0 (boilerplate) and 1 (content): per feature, per pair of neighbours, and at the start."""

    emission: np.ndarray
    transition: np.ndarray
    start: np.ndarray

    def decode(self, features: np.ndarray) -> np.ndarray:
        """The best labelling, ties for content."""
        if not len(features):
            return np.zeros(0, np.int64)
        scores = (features @ self.emission).tolist()
        (from00, from01), (from10, from11) = self.transition.tolist()
        a, b = self.start[0] + scores[0][0], self.start[1] + scores[0][1]
        back = []
        for s0, s1 in scores[1:]:
            to0, to1 = (1, 1)
            a0, b0, a1, b1 = a + from00, b + from10, a + from01, b + from11
            if a0 > b0:
                to0, b0 = 0, a0
            if a1 > b1:
                to1, b1 = 0, a1
            back.append((to0, to1))
            a, b = b0 + s0, b1 + s1
        label = int(b >= a)
        labels = [label]
        for step in reversed(back):
            label = step[label]
            labels.append(label)
        return np.array(labels[::-1])


def fit_field(sequences: list[tuple[np.ndarray, np.ndarray]], rounds: int = 250, chained: bool = True) -> Field:
    """Maximum likelihood by Adam, forward and backward sums over all sequences side by side.

    Without `chained`, neighbours do not count: every line is judged alone.
    """
    longest = max(len(y) for _, y in sequences)
    x = np.zeros((len(sequences), longest, FEATURES))
    y = np.zeros((len(sequences), longest), np.int64)
    there = np.zeros((len(sequences), longest), bool)
    for i, (features, labels) in enumerate(sequences):
        x[i, : len(labels)], y[i, : len(labels)], there[i, : len(labels)] = features, labels, True
    weights = [np.zeros((FEATURES, 2)), np.zeros((2, 2)), np.zeros(2)]
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in weights]
    hot = np.eye(2)[y] * there[..., None]
    pairs_seen = np.einsum("sta,stb->ab", hot[:, :-1], hot[:, 1:])
    total = there.sum()
    for step in range(1, rounds + 1):
        emission, transition, start = weights
        scores = x @ emission
        ahead = np.zeros_like(scores)
        ahead[:, 0] = start + scores[:, 0]
        for t in range(1, longest):
            reached = np.logaddexp.reduce(ahead[:, t - 1, :, None] + transition, axis=1) + scores[:, t]
            ahead[:, t] = np.where(there[:, t, None], reached, ahead[:, t - 1])
        norm = np.logaddexp.reduce(ahead[:, -1], axis=1)
        behind = np.zeros_like(scores)
        pairs = np.zeros((2, 2))
        for t in range(longest - 1, 0, -1):
            onward = scores[:, t] + behind[:, t]
            joint = np.exp(ahead[:, t - 1, :, None] + transition + onward[:, None, :] - norm[:, None, None])
            pairs += joint[there[:, t]].sum(axis=0)
            behind[:, t - 1] = np.where(
                there[:, t, None], np.logaddexp.reduce(transition + onward[:, None, :], axis=2), behind[:, t - 1]
            )
        likely = np.exp(ahead + behind - norm[:, None, None]) * there[..., None]
        slopes = [
            np.einsum("stf,stl->fl", x, likely - hot) / total + 1e-3 * emission,
            ((pairs - pairs_seen) / total + 1e-3 * transition) * chained,
            (likely[:, 0] - hot[:, 0]).sum(axis=0) / total + 1e-3 * start,
        ]
        for w, (m, v), g in zip(weights, moments, slopes, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= 0.08 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field(*weights)


#: Used where no labels are given: content unless a line is made of signs, shouted or repeated.
DEFAULT_FIELD = Field(
    np.array([[0, 1.5], [0, 0.5], [0, 0], [0, 0], [2, 0], [2, 0], [2, 0], [0, 0], [1, 0], [0, 1], [2, 0], [0, 1], [0, 0]], float),
    np.array([[0.7, 0], [0, 0.7]]),
    np.zeros(2),
)


def _sequences(text: str, good: bool) -> list[tuple[np.ndarray, np.ndarray]]:
    lines = worded_lines(text)
    features = line_features(lines)
    labels = np.where(features[:, 10] > 0, 0, int(good)).astype(np.int64)
    begins = list(range(0, len(lines), STRETCH))
    if len(begins) > STRETCHES:
        begins = [begins[i * len(begins) // STRETCHES] for i in range(STRETCHES)]
    return [(features[b : b + STRETCH], labels[b : b + STRETCH]) for b in begins]


def train_field(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> Field:
    """A field fitted on at most `sample` labelled documents, half of each class, taken by a hash of the id.

    Held-out documents are left alone, as are labels other than 0 and 1. Where a class is missing, DEFAULT_FIELD.
    """
    usable = labels.filter(~held_out(id_col) & F.col(label_col).isin(0, 1))
    usable = usable.groupBy(F.col(id_col).alias("doc_id")).agg(F.min(label_col).alias("y"))
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    halves = [usable.filter(F.col("y") == y).orderBy(*by_hash).limit(sample // 2) for y in (0, 1)]
    chosen = cut(halves[0].unionByName(halves[1]).select("doc_id", F.col("y").cast("double").alias("y")))

    @F.pandas_udf("array<array<double>>")
    def examples(texts: pd.Series, good: pd.Series) -> pd.Series:
        made = [_sequences(text, y > 0) for text, y in zip(texts, good, strict=True)]
        return pd.Series([[np.column_stack(s).ravel() for s in part] for part in made])

    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    # At most `sample` ids. Of several texts of one the one of least hash, so that a rerun learns from the same.
    least = F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(least)
    rows = rows.select("doc_id", "y", examples("text", "y").alias("s")).orderBy("doc_id").collect()
    if len({row.y for row in rows}) < 2:
        return DEFAULT_FIELD
    tables = [np.array(s).reshape(-1, FEATURES + 1) for row in rows for s in row.s]
    sequences = [(t[:, :-1], t[:, -1].astype(np.int64)) for t in tables]
    # A bad document may hold good lines. A line of it that looks like content on its own counts as such.
    alone = fit_field(sequences, rounds=100, chained=False)
    lifted = [(x, y | ((np.diff(x @ alone.emission)[:, 0] > 0) & (x[:, 10] == 0))) for x, y in sequences]
    return fit_field(lifted)


def judge(text: str, field: Field) -> tuple[int, int, int, int, int, float]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the share of words in content lines."""
    words, lines = text.encode("utf-8", "replace").split(), worded_lines(text)
    labels = field.decode(line_features(lines))
    sizes = np.array([len(line.split()) or 1 for line in lines], np.float64)
    return (
        len(words),
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        float(sizes @ labels / sizes.sum()) if len(lines) else 0.0,
    )


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    least_content: float = LEAST_CONTENT,
    sample: int = SAMPLE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, content_share.

    A null text has no words and fails; so does an empty one. Repeated rows are judged one by one; other columns are
    neither read nor returned. A share of just `least_content` is kept.
    """
    field = docs.sparkSession.sparkContext.broadcast(train_field(docs, labels, sample, id_col, text_col))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    @F.pandas_udf(f"{', '.join(f'{n} long' for n in names)}, content_share double")
    def judged(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([judge(text, field.value) for text in texts], columns=[*names, "content_share"])

    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("_text"))
    out = texts.select("doc_id", judged("_text").alias("j")).select("doc_id", "j.*")
    failed = (F.col("n_words") < FEWEST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PCT * F.col("n_words")
    )
    return out.select(
        "doc_id",
        *names,
        failed.alias("base_failed"),
        (~failed & (F.col("content_share") >= least_content)).alias("kept"),
        "content_share",
    )
