"""Token counts, packing and piece codes against the libraries and plain versions."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from cases import TEXTS, awkward
from orderwatch.llm import bpe_count, packing, piece_codec, queries
from tokenizers import Tokenizer

PARTS = list("abcdefghij ABCΣςσİıßéȨ́\t\n\x0b\x0c\r\x1c\x85　​▁'sdmlt012３½①漢字日本😀\x00|<>#﻿ΑꟋ")
PARTS += ["<|startoftext|>", "<|endoftext|>", "'re", "'ll", "</s>", "<0x0A>", "the", "tion", "    ", " "]


def random_texts(count, seed=5):
    rnd = random.Random(seed)
    return ["".join(rnd.choices(PARTS, k=rnd.randint(0, 60))) for _ in range(count)]


HARD = [*random_texts(2500), "a" * 30_000, "ab" * 9000, " " * 3000, "▁" * 77, "\n" * 999, "é" * 5000]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(queries.WORD_TOKENIZER)


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)


def test_counts_like_the_library(tokenizer):
    count = bpe_count.counter(queries.WORD_TOKENIZER).count
    assert [t[:40] for t in HARD if count(t) != len(tokenizer.encode(t, add_special_tokens=False).ids)] == []


def test_count_query(spark, sf_dir, tokenizer):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.QUERIES["op4_token_counts"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert row.n_tokens == len(tokenizer.encode(texts[row.doc_id], add_special_tokens=False).ids)
        assert (row.n_bytes, row.over_limit) == (len(texts[row.doc_id].encode()), row.n_tokens > 2048)


def test_counts_of_awkward_rows(spark, tokenizer):
    docs = awkward(spark)
    found = bpe_count.token_counts(docs, queries.WORD_TOKENIZER).collect()
    assert len(found) == docs.count()
    of = {r.doc_id: r.n_tokens for r in found if r.doc_id is not None}
    assert of == {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(TEXTS)}
    assert bpe_count.token_counts(docs.limit(0), queries.WORD_TOKENIZER).count() == 0


def test_pieces_like_the_library(pieces):
    codec = piece_codec.codec(queries.PIECE_MODEL)
    assert [t[:40] for t in HARD if codec.encode(t).tolist() != pieces.encode(t)] == []
    assert [t[:40] for t in HARD if codec.decode(codec.encode(t)) != pieces.decode(pieces.encode(t))] == []
    plain = [t for t in HARD if "▁" not in t]
    assert all(codec.decode(codec.encode(t)) == t for t in plain)


def test_backtracking_takes_pieces_back():
    """`ab` is the longest start of `abc`, but merging makes `bc` first."""
    codec = object.__new__(piece_codec.PieceCodec)
    scores = {"a": -9.0, "b": -9.0, "c": -9.0, "bc": -1.0, "ab": -2.0}
    codec._prepare({piece: (i, score) for i, (piece, score) in enumerate(scores.items())}, {})
    assert codec.encode_stretch("abc") == np.array([0, 3], "<i4").tobytes()
    assert codec.merged("abc") == ["a", "bc"]


@pytest.mark.parametrize("seed", range(6))
def test_backtracking_like_merging_on_small_vocabularies(seed):
    rnd = random.Random(seed)
    words = {"".join(rnd.choices("abc", k=rnd.randint(2, 5))) for _ in range(25)}
    codec = object.__new__(piece_codec.PieceCodec)
    plain = {piece: (i, -float(i)) for i, piece in enumerate(rnd.sample(sorted(words), len(words)))}
    plain |= {c: (100 + i, -100.0 - i) for i, c in enumerate("abc")}
    codec._prepare(plain, {})
    for _ in range(400):
        text = "".join(rnd.choices("abc", k=rnd.randint(1, 14)))
        ids = np.frombuffer(codec.encode_unit(text), "<i4").tolist()
        assert [codec.piece_of[i] for i in ids] == codec.merged(text)


def test_piece_codes_of_awkward_rows(spark, pieces):
    docs = awkward(spark)
    encoded = piece_codec.encode_pieces(docs, queries.PIECE_MODEL)
    again = piece_codec.decode_pieces(encoded.drop("decoded"), queries.PIECE_MODEL)
    rows = encoded.collect()
    assert sorted(r.decoded for r in rows) == sorted(r.decoded for r in again.collect())
    assert len(rows) == docs.count()
    for row in rows:
        if row.doc_id is not None:
            assert row.ids == pieces.encode(TEXTS[row.doc_id] or "")
            assert row.decoded == pieces.decode(row.ids)
    assert piece_codec.encode_pieces(docs.limit(0), queries.PIECE_MODEL).count() == 0


def plain_best_fit(lengths, window):
    rooms, numbers, offsets = [], [], []
    for length in lengths:
        fitting = [(room, i) for i, room in enumerate(rooms) if room >= length]
        if fitting:
            number = min(fitting)[1]
        else:
            number = len(rooms)
            rooms.append(window)
        numbers.append(number)
        offsets.append(window - rooms[number])
        rooms[number] -= length
    return numbers, offsets


@pytest.mark.parametrize("window", [1, 7, 64, 100])
def test_best_fit_leaves_the_room_the_plain_search_leaves(window):
    rnd = random.Random(window)
    for _ in range(60):
        lengths = sorted((rnd.randint(1, window) for _ in range(rnd.randint(0, 80))), reverse=True)
        numbers, offsets = packing.best_fit(lengths, window)
        plain, _ = plain_best_fit(lengths, window)
        filled = lambda ns: sorted(sum(x for x, n in zip(lengths, ns, strict=True) if n == i) for i in set(ns))
        assert filled(numbers) == filled(plain)
        ends = {}
        for length, number, offset in zip(lengths, numbers, offsets, strict=True):
            assert offset == ends.get(number, 0)
            ends[number] = offset + length
        assert all(end <= window for end in ends.values())


def check_packing(rows, ids_of, window=2048):
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append(r)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    for doc_id, parts in by_doc.items():
        ids, at = [*ids_of(doc_id), 1], 0
        for r in sorted(parts, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    return sum(r.length for r in rows) / window / len(by_sequence)


def test_packing_query(spark, sf_dir, tokenizer):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.QUERIES["op5_packing"](spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(texts)
    fill = check_packing(rows, lambda d: tokenizer.encode(texts[d], add_special_tokens=False).ids)
    assert fill > 0.99


def test_packing_of_awkward_rows(spark, tokenizer):
    docs = awkward(spark).filter("lang is null and doc_id is not null")
    rows = queries.packed_documents(docs).collect()
    check_packing(rows, lambda d: tokenizer.encode(TEXTS[d] or "", add_special_tokens=False).ids)
    assert {r.doc_id for r in rows} == set(range(len(TEXTS)))
    everything = packing.pack_documents(awkward(spark), queries.WORD_TOKENIZER).collect()
    assert None in {r.doc_id for r in everything} and sum(r.doc_id == 4 for r in everything) == 3
    assert packing.pack_documents(docs.limit(0), queries.WORD_TOKENIZER).count() == 0


def test_vocabulary_files_are_not_in_the_repository():
    assert public_tokenizers.__file__ not in queries.__file__


def test_piece_query_on_every_document(spark, sf_dir, pieces):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.QUERIES["op7_piece_codec"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = pieces.encode(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(pieces.decode(ids).encode()).hexdigest()
