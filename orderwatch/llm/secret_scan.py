"""Secrets in texts: three fixed patterns, and random strings by their token efficiency.

A vocabulary of byte pairs writes words in few tokens and random strings in many. A run of letters, digits and
joiners that has few characters per token is taken for a secret, unless it is a number, a digest that is named as
one or known by value, or an identifier: words of the vocabulary, told apart by case or joiners.
"""

from __future__ import annotations

import base64
import bisect
import functools
import hashlib
import re

import pandas as pd
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from orderwatch.llm.common import text_or_empty

#: Characters per token below which a string counts as random. Words have four or more, hexadecimal about two.
LEAST_EFFICIENCY = 2.4
#: The same for letters of one case alone. Of 6,000 uniform strings of small letters 99 % have 2.0 or fewer, long words
#: that the vocabulary does not know, such as German compounds, 2.2 or more.
LEAST_OF_LETTERS = 2.1
SHORTEST = 20
NEAR = 24
#: Letters that a word of an identifier has at least, and the most letters and digits that it has beside its words.
#: None of 20,000 uniform base-62 strings of SHORTEST characters has so few beside words.
LEAST_WORD = 3
MOST_BESIDE = 7

# The patterns of the contract.
ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
# A run shorter than asked for holds no longer match, so the least length may stand in the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}+")
HEX = re.compile(r"[0-9a-f]{16,}+")

KEYWORDS = ("passw", "secret", "token", "api")
KINDS = ("assign", "access", "hex", "random")
# An equals sign ends a candidate as padding, but may stand before one: that is where values are.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}+={0,2}" % SHORTEST)
UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
NAMED_DIGEST = re.compile(r"(?i)(?:md5|sha-?\d*|checksum|digest|commit|etag|integrity|crc)\W{0,4}(?:\w{1,6}\W{1,3})?$")
#: Digests that everybody knows: those of nothing.
KNOWN_DIGESTS = frozenset(
    f(b"").hexdigest() for f in (hashlib.md5, hashlib.sha1, hashlib.sha224, hashlib.sha256, hashlib.sha384, hashlib.sha512)
)

SPANS = ArrayType(
    StructType(
        [
            StructField("kind", StringType()),
            StructField("start", IntegerType()),
            StructField("end", IntegerType()),
        ]
    )
)


def _joined(spans: list[tuple[str, int, int]]) -> tuple[list[int], list[int]]:
    """Where spans of any kind begin and end, those that overlap taken as one."""
    begins, ends = [], []
    for begin, end in sorted((begin, end) for _, begin, end in spans):
        if ends and begin < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            begins.append(begin)
            ends.append(end)
    return begins, ends


class SecretScanner:
    def __init__(self, ranks_path: str, pattern: str):
        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def efficiency(self, text: str) -> float:
        """Characters per token."""
        return len(text) / max(1, len(self.encoding.encode_ordinary(text)))

    def is_word(self, word: str) -> bool:
        """Whether the vocabulary knows a run of letters, at the start of a text or behind a blank."""
        if len(word) < LEAST_WORD:
            return False
        tokens = min(len(self.encoding.encode_ordinary(x)) for x in (word, " " + word))
        return len(word) >= LEAST_EFFICIENCY * tokens

    def is_identifier(self, value: str) -> bool:
        """Whether little is left of a value without joiners and words."""
        words = sum(len(word) for word in WORD.findall(value) if self.is_word(word.lower()))
        return sum(c.isalnum() for c in value) - words <= MOST_BESIDE

    def is_random(self, text: str, found: re.Match) -> bool:
        value = found[0]
        if not any(c.isalpha() for c in value):
            return False
        if value.lower() in KNOWN_DIGESTS or UUID.fullmatch(value):
            return False
        if NAMED_DIGEST.search(text, max(0, found.start() - NEAR), found.start()):
            return False
        one_case = value.isalpha() and (value[1:].islower() or value.isupper())
        least = LEAST_OF_LETTERS if one_case else LEAST_EFFICIENCY
        return self.efficiency(value) < least and not self.is_identifier(value)

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """All spans by start, then kind as listed."""
        found = []
        low = text.lower()
        if any(word in low for word in KEYWORDS):
            found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
        if "AKIA" in text:
            found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
        found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
        begins, ends = _joined(found)
        for m in CANDIDATE.finditer(text):
            # The last joined span that begins before the candidate ends is the only one that may reach into it.
            last = bisect.bisect_left(begins, m.end()) - 1
            if (last < 0 or ends[last] <= m.start()) and self.is_random(text, m):
                found.append(("random", m.start(), m.end()))
        return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


@functools.lru_cache(maxsize=4)
def scanner(ranks_path: str, pattern: str) -> SecretScanner:
    return SecretScanner(ranks_path, pattern)


def secret_spans(text: Column, ranks_path: str, pattern: str) -> Column:
    """Spans of a text column: kind, start, end in code points, by start and kind."""

    @F.pandas_udf(SPANS)
    def find(texts: pd.Series) -> pd.Series:
        return texts.map(scanner(ranks_path, pattern).spans)

    return find(text)


def find_secrets(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id and `spans`, an array of kind, start and end.

    `ranks_path` is a vocabulary file that executors can read, `pattern` its split pattern. A null text counts as
    empty; an empty text has no spans; repeated rows are scanned one by one; other columns are neither read nor
    returned. Spans of the method never overlap those of the fixed patterns.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("_text"))
    return texts.select("doc_id", secret_spans(F.col("_text"), ranks_path, pattern).alias("spans"))


def mask_secrets(
    docs: DataFrame, ranks_path: str, pattern: str, mask: str = "[SECRET]", text_col: str = "text"
) -> DataFrame:
    """`docs` with every span of a secret replaced by `mask`, all other columns as they were.

    Overlapping spans are replaced as one. A null text stays null.
    """

    @F.pandas_udf(StringType())
    def masked(texts: pd.Series) -> pd.Series:
        scan = scanner(ranks_path, pattern).spans

        def one(text: str | None) -> str | None:
            if text is None or not (spans := scan(text)):
                return text
            parts, at = [], 0
            for _, start, end in spans:
                if start >= at:
                    parts += [text[at:start], mask]
                at = max(at, end)
            return "".join([*parts, text[at:]])

        return texts.map(one)

    return docs.withColumn(text_col, masked(F.col(text_col)))
