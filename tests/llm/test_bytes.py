"""The byte-level codec against the library it must equal."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import tiktoken
from cases import TEXTS, awkward
from orderwatch.llm import byte_codec, queries
from sentencepiece import sentencepiece_model_pb2

LETTERS = list("ab cZ9\t\n\r\x0b\x1c\x85　​'sdtl.!?<|>éß中日😀\x00\U0010ffff﻿½Ⅷ")
LETTERS += ["<|endoftext|>", "'re", "the", " tion", "    "]


def texts(count, seed=9):
    rnd = random.Random(seed)
    return ["".join(rnd.choices(LETTERS, k=rnd.randint(0, 50))) for _ in range(count)]


HARD = [*texts(4000), "a" * 50_000, "ab" * 30_000, " " * 20_000, "é" * 9000, "!" * 9000, "\n" * 999, "".join(map(chr, range(0x800)))]


@pytest.fixture(scope="module")
def codec():
    return byte_codec.codec(queries.RANKS, queries.SPLITS)


@pytest.fixture(scope="module")
def library():
    ranks = byte_codec.read_ranks(queries.RANKS)
    return tiktoken.Encoding("own", pat_str=queries.SPLITS, mergeable_ranks=ranks, special_tokens={})


def test_ids_and_bytes_like_the_library(codec, library):
    for text in HARD:
        ids = codec.encode(text)
        assert ids.tolist() == library.encode_ordinary(text), text[:40]
        assert codec.decode(ids) == text.encode()


def test_any_ids_are_decoded(codec, library):
    ids = np.random.default_rng(1).integers(0, 50_256, 5000)
    assert codec.decode(ids) == library.decode_bytes(ids.tolist())


def test_model_is_the_vocabulary():
    ranks = byte_codec.read_ranks(queries.RANKS)
    model = sentencepiece_model_pb2.ModelProto.FromString(byte_codec.serialised_model(sorted(ranks, key=ranks.get)))
    assert len(model.pieces) == len(ranks) + 1
    assert all(byte_codec.as_bytes(p.piece) in ranks and p.score == -ranks[byte_codec.as_bytes(p.piece)] for p in model.pieces[:-1])
    data = bytes(range(256))
    assert byte_codec.as_bytes(byte_codec.as_letters(data)) == data


def test_ranks_with_gaps_and_tokens_that_no_merge_makes():
    """A whole pre-token that is a token is that token, as in the library, even if merging does not lead there."""
    ranks = {bytes([b]): 3 * b for b in range(256)} | {b"ab": 1000, b"abcd": 1001, b"bc": 900}
    own, other = byte_codec.ByteCodec(ranks, r"\w+|\W"), tiktoken.Encoding("x", pat_str=r"\w+|\W", mergeable_ranks=ranks, special_tokens={})
    for text in ("abcd", "abcde", "ab", "abc", "xabcd abcd", "bcbc"):
        assert own.encode(text).tolist() == other.encode_ordinary(text)
        assert own.decode(own.encode(text)) == text.encode()
    with pytest.raises(ValueError, match="every byte"):
        byte_codec.ByteCodec({b"a": 0}, r"\w+")


def test_query_on_every_document(spark, sf_dir, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.QUERIES["op11_byte_codec"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for row in rows:
        ids = library.encode_ordinary(docs[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(docs[row.doc_id].encode()).hexdigest()


def test_awkward_rows(spark, library):
    docs = awkward(spark)
    encoded = byte_codec.encode_bytes(docs, queries.RANKS, queries.SPLITS)
    rows = encoded.collect()
    assert len(rows) == docs.count()
    of = {r.doc_id: (r.ids, bytes(r.decoded)) for r in rows if r.doc_id is not None}
    assert of == {i: (library.encode_ordinary(t or ""), (t or "").encode()) for i, t in enumerate(TEXTS)}
    again = byte_codec.decode_bytes(encoded.drop("decoded"), queries.RANKS, queries.SPLITS)
    assert sorted((r.doc_id or -1, bytes(r.decoded)) for r in again.collect()) == sorted((r.doc_id or -1, bytes(r.decoded)) for r in rows)
    assert byte_codec.encode_bytes(docs.limit(0), queries.RANKS, queries.SPLITS).count() == 0
