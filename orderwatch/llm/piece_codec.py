"""Merge-type piece encoding by backtracking, and decoding.

A text becomes "▁" for the start and for every space, and falls into units that start with such marks: no piece
has a mark behind another letter. In a unit, an Aho-Corasick automaton gives all pieces at all places. From the
left the longest piece is taken that goes with the one before: two pieces go together if merging their letters
anew gives just these two. Where none fits, the last piece is taken back for a shorter one, and the place is
marked in a bit field, never to be tried again. Letters without a piece are written as bytes.
"""

from __future__ import annotations

import functools
import heapq
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from orderwatch.llm.common import Memo, text_or_empty

MARK = "▁"
LONG = 64
#: Rows handed back at a time.
SLICE = 256


class PieceCodec:
    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)  # reads the file; it encodes nothing here
        self.pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        special = lambda i: model.is_byte(i) or model.is_control(i) or model.is_unknown(i)
        plain = [i for i in range(len(self.pieces)) if not special(i)]
        byte_ids = {i: int(self.pieces[i][3:5], 16) for i in range(len(self.pieces)) if model.is_byte(i)}
        self._prepare({self.pieces[i]: (i, model.get_score(i)) for i in plain}, byte_ids)

    def _prepare(self, plain: dict[str, tuple[int, float]], byte_ids: dict[int, int]) -> None:
        if any(MARK in piece.lstrip(MARK) for piece in plain):
            raise ValueError("pieces with a mark behind another letter are not supported")
        self.score = {piece: score for piece, (_, score) in plain.items()}
        self.id_of = {piece: i for piece, (i, _) in plain.items()}
        self.piece_of = {i: piece for piece, i in self.id_of.items()}
        self.byte_id = {byte: i for i, byte in byte_ids.items()}
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.id_of.items():
            self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        self.written = {i: piece.replace(MARK, " ").encode() for piece, i in self.id_of.items()}
        self.written |= {i: bytes([byte]) for i, byte in byte_ids.items()}
        #: Letters that stand side by side in some piece. Between others nothing is ever merged.
        self.beside = {piece[i : i + 2] for piece in plain for i in range(len(piece) - 1)}
        self.units = re.compile(f"{MARK}+[^{MARK}]*" if "\n" in self.score else f"{MARK}+[^{MARK}\n]*|\n[^{MARK}\n]*")
        self.fits = Memo(lambda pair: self._stays(pair >> 32, pair & 0xFFFFFFFF))
        self.alone = Memo(lambda i: self.merged(self.piece_of[i]) == [self.piece_of[i]])
        self.known = Memo(self.encode_unit, 450_000)

    def _stays(self, left: int, right: int) -> bool:
        """Whether merging the letters of two pieces anew gives just these two."""
        left, right = self.piece_of[left], self.piece_of[right]
        return self.merged(left + right) == [left, right]

    def merged(self, text: str) -> list[str]:
        """The letters of `text` merged pair by pair, best score first, then leftmost."""
        parts, score = list(text), self.score
        after, before = [*range(1, len(parts)), -1], list(range(-1, len(parts) - 1))
        heap = []
        for i in range(len(parts) - 1):
            if (found := score.get(parts[i] + parts[i + 1])) is not None:
                heap.append((-found, i, parts[i] + parts[i + 1]))
        heapq.heapify(heap)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = after[i]
            if j < 0 or not parts[i] or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j] = both, ""
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
            for left, right in ((before[i], i), (i, k)):
                if left >= 0 and right >= 0 and (found := score.get(parts[left] + parts[right])) is not None:
                    heapq.heappush(heap, (-found, left, parts[left] + parts[right]))
        return [p for p in parts if p]

    def backtrack(self, places: list[list[tuple[int, int]]]) -> list[int]:
        """Ids for letters that all have pieces; `places` has the id and size of those at each, shortest first."""
        end, at, taken = len(places), 0, []
        failed = bytearray(end // 8 + 1)
        left, last = len(places[0]), -1
        fits, alone = self.fits, self.alone
        while at < end:
            options = places[at]
            while left:
                left -= 1
                i, size = options[left]
                to = at + size
                if not failed[to >> 3] >> (to & 7) & 1 and (alone[i] if last < 0 else fits[last << 32 | i]):
                    taken.append((i, left))
                    at, last = to, i
                    left = len(places[at]) if at < end else 0
                    break
            else:
                failed[at >> 3] |= 1 << (at & 7)
                i, left = taken.pop()
                at -= len(self.piece_of[i])
                last = taken[-1][0] if taken else -1
        return [i for i, _ in taken]

    def encode_stretch(self, stretch: str) -> bytes:
        """Ids of letters with pieces of which each stands beside the next in some piece, or of one letter."""
        if stretch not in self.score and len(stretch) == 1:
            ids = [self.byte_id[b] for b in stretch.encode()]
        else:
            places: list[list[tuple[int, int]]] = [[] for _ in stretch]
            for stop, found in self.automaton.iter(stretch):
                places[stop + 1 - found[1]].append(found)  # stops grow, so shortest first
            ids = self.backtrack(places)
        return array("i", ids).tobytes()

    def encode_unit(self, unit: str) -> bytes:
        beside = self.beside
        cuts = [at for at in range(1, len(unit)) if unit[at - 1 : at + 1] not in beside]
        if not cuts:
            return self.encode_stretch(unit)
        stretches = [unit[a:b] for a, b in zip([0, *cuts], [*cuts, len(unit)], strict=True)]
        return b"".join([self.known[x] if len(x) <= LONG else self.encode_stretch(x) for x in stretches])

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        known = self.known
        units = self.units.findall(MARK + text.replace(" ", MARK))
        out = b"".join([known[u] if len(u) <= LONG else self.encode_unit(u) for u in units])
        known.trim()
        self.fits.trim()
        return np.frombuffer(out, "<i4")

    def decode(self, ids: np.ndarray) -> str:
        """The text of `ids`. Bytes that are no text become U+FFFD; the mark put before the text goes."""
        written = self.written
        text = b"".join([written.get(i, b"") for i in ids.tolist()]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


@functools.lru_cache(maxsize=4)
def codec(path: str) -> PieceCodec:
    return PieceCodec(path)


def encode_pieces(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, `ids`, the whole text encoded, and `decoded`, the text that the ids stand for.

    `model` is the path of a merge-type model that executors can read, without letter rules of its own. A null or
    empty text has no ids; repeated rows are encoded one by one; other columns are neither read nor returned.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            for part in (batch.slice(at, SLICE) for at in range(0, batch.num_rows, SLICE)):
                ids = [own.encode(text) for text in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array(map(own.decode, ids), pa.string())],
                    names=["doc_id", "ids", "decoded"],
                )

    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def decode_pieces(encoded: DataFrame, model: str) -> DataFrame:
    """`encoded` with `decoded`, the text of its `ids`; null ids give an empty text."""

    @F.pandas_udf(StringType())
    def decode(ids: pd.Series) -> pd.Series:
        return ids.map(codec(model).decode)

    return encoded.withColumn("decoded", decode(F.coalesce("ids", F.array().cast("array<int>"))))
