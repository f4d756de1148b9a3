"""Token counts by byte-pair merging with a heap over a linked list; no identifiers are looked up.

The vocabulary file gives the merges, the split pattern, the end-of-word mark and the special strings. Tokens
never reach over white space, so a text is counted as the sum over its blank-separated chunks.
"""

from __future__ import annotations

import functools
import heapq
import json
import unicodedata

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from orderwatch.llm.common import Memo, text_or_empty

#: Chunks longer than this are counted anew each time, so that the memory of results stays small.
LONG = 64

#: Lower-case forms of Unicode 16 that Python's tables may not have yet.
NEWER_LOWER = {0xA7CB: 0x0264, 0xA7DC: 0x019B}


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, the others from code 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class MergeCounter:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, parts = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        self.ids: dict[str, int] = {}
        number = lambda symbol: self.ids.setdefault(symbol, len(self.ids))
        pairs = [x if isinstance(x, list) else x.split(" ") for x in model["merges"]]
        #: The rank of each pair, both symbols in one number, and the symbol that a rank makes.
        self.ranks = {number(left) << 32 | number(right): rank for rank, (left, right) in enumerate(pairs)}
        self.made = [number(left + right) for left, right in pairs]
        suffix = model["end_of_word_suffix"] or ""
        self.first = [number(letter) for letter in byte_letters()]
        self.last = [number(letter + suffix) for letter in byte_letters()]
        self.words = regex.compile(next(p["pattern"]["Regex"] for p in parts if p["type"] == "Split"))
        special = [regex.escape(t["content"]) for t in spec["added_tokens"] if not t["normalized"]]
        self.special = regex.compile("|".join(sorted(special, key=len, reverse=True)) or r"(?!)")
        self.by_word, self.by_chunk = Memo(self.count_word), Memo(self.count_chunk)

    def count_word(self, word: str) -> int:
        """Initial symbols minus merges."""
        data = word.encode()
        first = self.first
        symbols = [first[b] for b in data]
        symbols[-1] = self.last[data[-1]]
        count = len(symbols)
        if count == 1:
            return 1
        ranks, made, push = self.ranks, self.made, heapq.heappush
        # An entry is a rank and a place in one number, so the lowest rank comes first, then the leftmost place.
        found = [ranks.get(a << 32 | b) for a, b in zip(symbols, symbols[1:], strict=False)]
        heap = [rank << 32 | i for i, rank in enumerate(found) if rank is not None]
        heapq.heapify(heap)
        before, after = list(range(-1, count - 1)), [*range(1, count), -1]
        while heap:
            entry = heapq.heappop(heap)
            i, rank = entry & 0xFFFFFFFF, entry >> 32
            j = after[i]
            if j < 0 or symbols[i] < 0 or ranks.get(symbols[i] << 32 | symbols[j]) != rank:
                continue  # the pair at this place has changed since
            symbols[i], symbols[j] = merged, _ = made[rank], -1
            after[i] = k = after[j]
            count -= 1
            if k >= 0:
                before[k] = i
                if (rank := ranks.get(merged << 32 | symbols[k])) is not None:
                    push(heap, rank << 32 | i)
            if (h := before[i]) >= 0 and (rank := ranks.get(symbols[h] << 32 | merged)) is not None:
                push(heap, rank << 32 | h)
        return count

    def count_plain(self, text: str) -> int:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).translate(NEWER_LOWER)
            # Letter by letter where it matters: as a whole word, a final sigma would get another form.
            text = "".join(map(str.lower, text)) if "Σ" in text else text
        text = text.lower()
        counts = self.by_word
        return sum([counts[w] if len(w) <= LONG else self.count_word(w) for w in self.words.findall(text)])

    def count_chunk(self, chunk: bytes) -> int:
        text, total, at = chunk.decode(), 0, 0
        if not self.special.search(text):
            return self.count_plain(text)
        for found in self.special.finditer(text):
            total += self.count_plain(text[at : found.start()]) + 1
            at = found.end()
        return total + self.count_plain(text[at:])

    def count(self, text: str) -> int:
        chunks, counts = text.encode("utf-8", "replace").split(), self.by_chunk
        total = sum([counts[c] if len(c) <= LONG else self.count_chunk(c) for c in chunks])
        counts.trim()
        self.by_word.trim()
        return total


@functools.lru_cache(maxsize=4)
def counter(path: str) -> MergeCounter:
    """One counter per worker process and vocabulary."""
    return MergeCounter(path)


def token_counts(
    docs: DataFrame, vocabulary: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit (more than `limit` tokens).

    `vocabulary` is the path of a tokenizer file that executors can read. A null text counts as empty and has no
    tokens; special strings in a text count one each; repeated rows are counted one by one; other columns are
    neither read nor returned.
    """

    @F.pandas_udf(LongType())
    def count(texts: pd.Series) -> pd.Series:
        return texts.map(counter(vocabulary).count)

    text = F.col("_text")
    counted = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("_text")).select(
        "doc_id", F.octet_length(text).cast("long").alias("n_bytes"), count(text).alias("n_tokens")
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
