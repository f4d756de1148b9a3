"""Awkward tables that every operator must take, and plain versions to compare with."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")

TEXTS = [
    None,
    "",
    " ",
    "\n\n\t",
    "one",
    "one two",
    "One  two\n",
    "a b c d e f g h",
    "A b c d e f g h",
    "mail me at a@b.c_d@e.f or 10.0.0.1, +1 (437) 555-0689",
    "4111 1111 1111 1111",
    "token = \"ffc3105535f423f352535e4ac53b5fefe076ac6d\"",
    "é日本 😀 ▁▁ <|endoftext|> \x00 　",
    "long " * 30_000,
    "x" * 30_000,
]


def awkward(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, and columns named like results."""
    rows = [(i, text, None, "s", 0) for i, text in enumerate(TEXTS)]
    rows += [(4, "one", "en", None, None), (4, "one", "en", None, None), (None, "a b c d e f g h", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("kept", "keep_id", "score", "spans", "n_tokens", "ids", "one", "two", "key", "digest", "component", "_text"):
        docs = docs.withColumn(name, F.lit("other"))
    return docs


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lowered)


def shingle_set(text, k):
    words = words_of(text)
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def groups(nodes, links):
    """The smallest node each node reaches."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def variants(seed, groups_of, base_words, edits):
    """Texts in groups of near copies, with the words changed at random."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for size in groups_of:
        base = rnd.choices(vocabulary, k=rnd.choice(base_words))
        for _ in range(size):
            words = list(base)
            for _ in range(rnd.randint(0, edits)):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            texts.append(" ".join(words))
    return texts
