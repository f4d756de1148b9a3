"""Packing token sequences best-fit decreasing.

A document is cut into full windows and a rest. Full windows are sequences of their own. Rests are dealt into
blocks by a hash of where they come from; in a block, longest first, each goes to the open window with the least
room that still holds it, found in a segment tree over remaining room.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderwatch.llm.common import text_or_empty

WINDOW = 2048
END = 1
#: Documents of a block. It bounds what one task holds; a block leaves a window or two partly empty.
BLOCK_DOCS = 16_384
LONG = 64
#: Rows handed back at a time.
SLICE = 256

_SIGN = re.compile(rb"(?<=[A-Za-z])[.,;:!?](?=[\x20\n])")


class ChunkTokens:
    """Ids of texts by the tokenizers library, remembered by blank-separated chunk: tokens never reach over blanks.

    Chunks not yet known are encoded together. A chunk of letters alone is one word, and the ids tell where words
    end; between other chunks stands a special string.
    """

    def __init__(self, path: str, most: int = 900_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel work
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        if isinstance(self.tokenizer.model, BPE):  # the same model without a memory of its own
            with open(path, encoding="utf-8") as file:
                spec = json.load(file)["model"]
            pairs = [tuple(x) if isinstance(x, list) else tuple(x.split(" ")) for x in spec["merges"]]
            names = ("unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")
            more = {name: spec[name] for name in names if spec.get(name) is not None}
            self.tokenizer.model = BPE(spec["vocab"], pairs, cache_capacity=0, **more)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        suffix = self.tokenizer.model.end_of_word_suffix or "</w>"
        self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        special = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items() if not t.normalized}
        self.mark_id, self.mark = max(special.items())
        self.specials = list(special.values())
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.most = most

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _words(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of chunks that are one word each."""
        ids = self._encode(b" ".join(chunks).decode())
        ends = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
        if len(ends) != len(chunks):  # the library knows letters otherwise than Python
            return self._marked(chunks)
        data = ids.tobytes()
        return [data[b:e] for b, e in zip([0, *ends], ends, strict=False)]

    def _marked(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of chunks without special strings."""
        ids = self._encode(self.mark.encode().join(chunks).decode())
        ends = [*np.flatnonzero(ids == self.mark_id).tolist(), len(ids)]
        data, begins = ids.tobytes(), [0, *[end + 1 for end in ends[:-1]]]
        return [data[4 * b : 4 * e] for b, e in zip(begins, ends, strict=True)]

    def _learn(self, chunks: set[bytes]) -> None:
        words, others = [], []
        for chunk in chunks:
            if chunk.isalpha():  # letters a to z only
                words.append(chunk)
                continue
            text = chunk.decode()
            if text.isalpha() and "İ" not in text:  # whose lower case is more than letters
                words.append(chunk)
            elif any(s in text for s in self.specials):
                self.known[chunk] = self._encode(text).tobytes()
            else:
                others.append(chunk)
        for encode, part in ((self._words, words), (self._marked, others)):
            for at in range(0, len(part), 4096):
                piece = part[at : at + 4096]
                self.known.update(zip(piece, encode(piece), strict=True))

    def _chunks(self, text: str) -> list[bytes]:
        """What blanks part, and what may as well be parted: a sign between a letter and a blank is a word of its
        own. The tokenizer takes all letters in lower case; where that is plain, it is done here already."""
        if text.isascii() and "<|" not in text:
            text = text.lower()
        return _SIGN.sub(rb" \g<0>", text.encode("utf-8", "replace")).split()

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        if len(self.known) > self.most:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        split = [self._chunks(text) for text in texts]
        found = [list(map(known.get, chunks)) for chunks in split]
        gaps = [[i for i, ids in enumerate(own) if ids is None] if None in own else [] for own in found]
        fresh = {chunks[i] for chunks, own in zip(split, gaps, strict=True) for i in own}
        again = fresh & older.keys()
        known.update((c, older[c]) for c in again)
        self._learn(fresh - again)
        for chunks, own, missing in zip(split, found, gaps, strict=True):
            for i in missing:
                own[i] = known[chunks[i]]
        for chunk in fresh:
            if len(chunk) > LONG:
                del known[chunk]
        return [b"".join(own) for own in found]


@functools.lru_cache(maxsize=4)
def chunk_tokens(path: str) -> ChunkTokens:
    return ChunkTokens(path)


def token_pieces(
    docs: DataFrame, vocabulary: str, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per piece: doc_id, start, length, doc_tokens and ids (little-endian 32-bit numbers).

    A document is its ids and END. It is cut at multiples of `window`, so all pieces but the last are full. A null
    or empty text is one piece that holds END alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end, step = chunk_tokens(vocabulary), np.array([END], "<u4").tobytes(), 4 * window
        for batch in batches:
            for part in (batch.slice(at, SLICE) for at in range(0, batch.num_rows, SLICE)):
                own, rows = [], []
                for i, ids in enumerate(tokens.ids(part.column("text").to_pylist())):
                    ids += end
                    for at in range(0, len(ids), step):
                        own.append(i)
                        rows.append((at // 4, min(step, len(ids) - at) // 4, len(ids) // 4, ids[at : at + step]))
                columns = [pa.array(c) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(own)), *columns], names=names)

    names = ["doc_id", "start", "length", "doc_tokens", "ids"]
    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {kind}, start long, length long, doc_tokens long, ids binary")


class RoomTree:
    """Open windows by remaining room: the leaf of a room holds its windows, a node how many are below it."""

    def __init__(self, window: int):
        self.width = 1 << window.bit_length()
        self.counts = [0] * (2 * self.width)
        self.windows: list[list[int]] = [[] for _ in range(window + 1)]

    def _add(self, room: int, by: int) -> None:
        at = room + self.width
        while at:
            self.counts[at] += by
            at >>= 1

    def put(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        self._add(room, 1)

    def tightest(self, length: int) -> tuple[int, int] | None:
        """Takes out the window with the least room of at least `length`."""
        at = length + self.width
        while not self.counts[at]:  # up and to the right, to the next subtree that holds a window
            while at & 1:
                at >>= 1
            if not at:
                return None
            at += 1
        while at < self.width:
            at = 2 * at if self.counts[2 * at] else 2 * at + 1
        room = at - self.width
        self._add(room, -1)
        return room, self.windows[room].pop()


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """Window number and offset of each piece; `lengths` must fall."""
    tree, used, numbers, offsets = RoomTree(window), 0, [], []
    for length in lengths:
        room, number = tree.tightest(length) or (window, used)
        used += number == used
        numbers.append(number)
        offsets.append(window - room)
        if room > length:
            tree.put(room - length, number)
    return numbers, offsets


def pack(pieces: DataFrame, documents: int, window: int = WINDOW) -> DataFrame:
    """`pieces` with sequence_id and offset; columns other than doc_id, start and length go along untouched.

    `documents` is their number, from which the number of blocks follows. The place of a piece depends on its
    block alone, so a task that runs again gives the same. No pieces give no rows.
    """
    blocks = max(1, -(-documents // BLOCK_DOCS))
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in pieces.schema)}, sequence_id long, offset long"
    order = [c for c in ("length", "doc_id", "start") if c in pieces.columns]
    rest = [f.name for f in pieces.schema if f.name not in order and f.dataType.typeName() in ("long", "string", "binary")]

    def place(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        falling = [c != "length" for c in [*order, *rest]]
        group = group.sort_values([*order, *rest], ascending=falling, kind="stable")
        numbers, offsets = best_fit(group["length"].tolist(), window)
        group["sequence_id"] = np.array(numbers, np.int64) + (int(key[0]) << 32)
        group["offset"] = np.array(offsets, np.int64)
        return group.drop(columns="_block")

    dealt = pieces.withColumn("_block", F.pmod(F.xxhash64("doc_id", "start"), F.lit(blocks)))
    return dealt.groupBy("_block").applyInPandas(place, schema)


def pack_documents(
    docs: DataFrame, vocabulary: str, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per piece: doc_id, start, length, doc_tokens, ids, sequence_id and offset."""
    return pack(token_pieces(docs, vocabulary, window, id_col, text_col), docs.count(), window)
