"""Byte-level pair encoding by a merge-type piece model made from the vocabulary itself, and decoding.

Every byte is written as one letter, and with that every token as a piece. Pieces are scored by their negative rank,
so that the piece model merges what the vocabulary merges, in its order; it changes no letter (identity normalisation,
no mark put before). The model is serialised from the ranks alone, nothing is trained. A text is cut into pre-tokens,
each pre-token is encoded on its own, and ids are turned back by the inverse of the mapping.
"""

from __future__ import annotations

import base64
import functools
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType
from sentencepiece import sentencepiece_model_pb2

from orderwatch.llm.common import Memo, text_or_empty

#: The letter of byte 0. The 256 letters from here on are no white space, and no two of them are one.
FIRST_LETTER = 0x100
LETTERS = {byte: FIRST_LETTER + byte for byte in range(256)}
#: Pre-tokens longer than this are not remembered.
LONG = 64
#: Rows handed back at a time.
SLICE = 256


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks from a file with a token in base 64 and a rank on each line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


def as_letters(data: bytes) -> str:
    return data.decode("latin-1").translate(LETTERS)


def as_bytes(letters: str) -> bytes:
    return bytes(ord(letter) - FIRST_LETTER for letter in letters)


def serialised_model(tokens: Iterable[bytes]) -> bytes:
    """A merge-type piece model of `tokens`, the first of which is merged first; behind them a piece for the unknown."""
    model = sentencepiece_model_pb2.ModelProto()
    model.trainer_spec.model_type = sentencepiece_model_pb2.TrainerSpec.BPE
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix = False
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.escape_whitespaces = False
    for place, token in enumerate(tokens):
        model.pieces.add(piece=as_letters(token), score=-place)
    model.pieces.add(piece="<unk>", score=0, type=sentencepiece_model_pb2.ModelProto.SentencePiece.UNKNOWN)
    return model.SerializeToString()


class ByteCodec:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        if not all(bytes([byte]) in ranks for byte in range(256)):
            raise ValueError("every byte must be a token")
        ordered = sorted(ranks, key=ranks.get)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialised_model(ordered))
        self.rank = np.array([ranks[token] for token in ordered], np.int32)
        self.whole = {token: array("i", [rank]).tobytes() for token, rank in ranks.items()}
        self.written = {ranks[token]: as_bytes(self.model.id_to_piece(i)) for i, token in enumerate(ordered)}
        self.split = regex.compile(pattern).findall
        self.known = Memo(self.encode_piece)

    def encode_piece(self, piece: str) -> bytes:
        """The ids of one pre-token. One that is a token is that token."""
        data = piece.encode()
        found = self.whole.get(data)
        return found or self.rank[self.model.encode(as_letters(data))].tobytes()

    def encode(self, text: str) -> np.ndarray:
        known = self.known
        out = b"".join([known[p] if len(p) <= LONG else self.encode_piece(p) for p in self.split(text)])
        known.trim()
        return np.frombuffer(out, np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.written.__getitem__, ids.tolist()))


@functools.lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> ByteCodec:
    return ByteCodec(read_ranks(path), pattern)


def encode_bytes(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, `ids`, the whole text encoded, and `decoded`, the bytes that the ids stand for.

    `ranks` is the path of a vocabulary that executors can read, `pattern` cuts texts into pre-tokens; what it passes
    over has no ids. Special tokens are ordinary text. A null or empty text has no ids; repeated rows are encoded
    one by one; a null id stays; other columns are neither read nor returned. No rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern)
        for batch in batches:
            for part in (batch.slice(at, SLICE) for at in range(0, batch.num_rows, SLICE)):
                ids = [own.encode(text) for text in part.column("text").to_pylist()]
                decoded = pa.array(map(own.decode, ids), pa.binary())
                columns = [part.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), decoded]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"])

    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded binary")


def decode_bytes(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """`encoded` with `decoded`, the bytes of its `ids`; null ids give no bytes. An id outside the vocabulary fails."""

    @F.pandas_udf(BinaryType())
    def decode(ids: pd.Series) -> pd.Series:
        return ids.map(codec(ranks, pattern).decode)

    return encoded.withColumn("decoded", decode(F.coalesce("ids", F.array().cast("array<int>"))))
