"""Spelling variants and collocations against plain versions."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from cases import awkward
from orderwatch.llm import bit_table, collocations, queries, spelling
from orderwatch.llm.quotient_filter import Counts, Layout, counted, from_filter, merged, to_filter
from pyspark.sql import functions as F


def plain_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", lowered):
            checksum = zlib.crc32(f"{doc_id}:{run}".encode())
            if checksum % 31 == 0:
                at = checksum % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += len(run) >= 7
    return {word: n for word, n in counts.items() if n >= 2}


def plain_variants(counts, ratio=10):
    letters = sorted({c for word in counts for c in word})

    def near(word):
        found = {word[:i] + word[i + 1 :] for i in range(len(word))}
        found |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
        found |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in letters}
        return [w for w in found if w != word and w in counts]

    form, n_near = {}, {}
    for word, n in counts.items():
        others = near(word)
        best = min(others, key=lambda w: (-counts[w], w), default=None)
        form[word], n_near[word] = best if best and counts[best] >= ratio * n else None, len(others)

    def root(word):
        while form[word]:
            word = form[word]
        return word

    return {(w, form[w], root(w), n, n_near[w], counts[form[w]] if form[w] else None) for w, n in counts.items()}


def found(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_variants_of_all_documents(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    expected = plain_variants(plain_words(rows))
    assert sum(row[1] is not None for row in expected) > 100
    assert found(queries.QUERIES["op12_spelling_variants"](spark, sf_dir)) == expected


@pytest.mark.parametrize("part", [3, 50_000])
def test_variants_of_dense_words(spark, monkeypatch, part):
    """Few letters, so that nodes are shared across many parts, runs repeat, and ties and chains occur."""
    monkeypatch.setattr(spelling, "PART_WORDS", part)
    rnd = random.Random(4)
    words = {"".join(rnd.choices("abé", k=rnd.randint(1, 6))) for _ in range(260)} | {"", "aaaaaaa", "aaaaaa"}
    counts = {word: rnd.choice([1, 1, 2, 10, 15, 100, 1000, 20_000]) for word in words}
    table = spark.createDataFrame([*counts.items(), (None, 5)], "word string, n long").withColumn("id", F.lit("own"))
    expected = plain_variants(counts)
    assert any(row[1] != row[2] and row[1] for row in expected)  # a chain of forms
    assert found(spelling.variants(table.repartition(3))) == expected


def test_words_of_awkward_rows(spark):
    docs = awkward(spark).withColumn("word", F.lit("x")).withColumn("n", F.lit("y"))
    long = "z" * 40_000
    texts = [(1, long + " " + long), (2, long[:-1] + " " + long[:-1]), (3, "Überzug ÜBERZUG überzug"), (3, "Überzug ÜBERZUG überzug")]
    docs = docs.unionByName(spark.createDataFrame(texts, "doc_id long, text string"), allowMissingColumns=True)
    rows = [(r.doc_id if r.doc_id is not None else "", r.text) for r in docs.select("doc_id", "text").collect()]
    expected = plain_words(rows)
    assert {len(word) for word in expected} >= {40_000, 39_999}
    got = {(r.word, r.n, r.n_near) for r in spelling.spelling_variants(docs).collect()}
    assert {(w, n) for w, n, _ in got} == set(expected.items())
    assert {n_near for w, _, n_near in got if len(w) > 30_000} == {1, 2} or {n_near for w, _, n_near in got if len(w) > 39_000} == {1}
    assert spelling.spelling_variants(docs.limit(0)).count() == 0


def test_tasks_hand_words_on_in_time(spark, monkeypatch):
    monkeypatch.setattr(spelling, "COUNTED", 3)
    docs = spark.createDataFrame([(i, f"wordone{chr(97 + i % 7)} wordtwox") for i in range(300)], "doc_id long, text string")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert {r.word: r.n for r in spelling.word_counts(docs).collect()} == plain_words(rows)


@pytest.mark.parametrize("id_bits", [12, 13, 18, 21])
@pytest.mark.parametrize("size", [2, 3, 4, 5])
def test_filters_lose_nothing(id_bits, size):
    rng = np.random.default_rng(id_bits * size)
    ids = (rng.zipf(1.4, 4000) % min(1 << id_bits, 900)).astype(np.uint64)
    ids[:3] = (1 << id_bits) - 1
    starts, expected = np.arange(len(ids) - size + 1), Counter()
    for at in starts:
        expected[tuple(ids[at : at + size].tolist())] += 1
    for range_bits in (3, 10):
        layout = Layout(size, id_bits, range_bits)
        halves = [counted(layout, ids, some) for some in (starts[::2], starts[1::2])]
        back = []
        for counts in halves:
            numbers = layout.ranges(counts.left)
            assert (np.diff(numbers) >= 0).all()
            for number in np.unique(numbers):
                inside = numbers == number
                own = Counts(counts.left[inside], counts.right[inside], counts.n[inside])
                back.append(from_filter(layout, int(number), to_filter(layout, own)))
        together = merged(layout, back)
        ngrams = map(tuple, layout.unpack(together.left, together.right).tolist())
        assert dict(zip(ngrams, together.n.tolist(), strict=True)) == expected


def test_filters_are_compact():
    layout, rng = Layout(2, 18, 10), np.random.default_rng(2)
    left = np.unique(rng.integers(0, 1 << 8, 100, dtype=np.uint64))
    counts = Counts(left, rng.integers(0, 1 << 18, len(left), dtype=np.uint64), np.full(len(left), 300, np.uint64))
    assert from_filter(layout, 0, to_filter(layout, counts)).n.tolist() == [300] * len(left)
    with pytest.raises(ValueError, match="cannot pack"):
        Layout(5, 22, 10)
    many = counted(layout, rng.integers(0, 1 << 18, 200_000, dtype=np.uint64), np.arange(199_999))
    first = many.left < np.uint64(1 << 8)
    one = Counts(many.left[first], many.right[first], many.n[first])
    assert len(to_filter(layout, one)) < 8 * len(one)  # 36 bits an n-gram and its count, in less than 8 bytes


def plain_collocations(rows, longest, least, top):
    out = []
    for lang in {r[0] or "und" for r in rows}:
        n, f = 0, Counter()
        for own, text in rows:
            if (own or "und") != lang:
                continue
            lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
            for piece in re.split("[.,;:!?\n-\r]", lowered):
                words = re.findall("[^ \t]+", piece)
                n += len(words)
                f.update(tuple(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = {}
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(a, inside.get(p[i : i + k], 0))
        scored = []
        for p, a in candidates.items():
            if inside.get(p, 0) < a:
                score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def random_documents(seed):
    rnd = random.Random(seed)
    words = [*[f"w{i}" for i in range(12)], "É", "ß", "A", "a", "\x0c", "\x1c", "x" * 80, "日本"]
    marks = [" ", " ", " ", " ", "\t", "  ", ", ", ". ", "\n", "!", " ; "]
    text = lambda: "".join(rnd.choice(words) + rnd.choice(marks) for _ in range(rnd.randint(0, 60)))
    rows = [(rnd.choice(["en", "de", None, "fr"]), text()) for _ in range(120)]
    return [*rows, ("en", None), (None, ""), ("xx", "only once here"), ("en", "a " * 3000), ("en", "a " * 3000)]


@pytest.mark.parametrize("dictionary", [5, 1 << 19])
def test_collocations_like_counting_all(spark, monkeypatch, dictionary):
    """With a dictionary of five words most phrases take the way of the words beyond it."""
    rows = random_documents(dictionary)
    docs = spark.createDataFrame(rows, "lang string, text string").withColumn("phrase", F.lit("own")).withColumn("n", F.lit(1))
    for name, value in (("HELD", 40), ("HELD_GRAMS", 300), ("IDS_AT_ONCE", 500)):
        monkeypatch.setattr(collocations, name, value)
    got = collocations.collocations(docs.repartition(4), 5, 4, 60, dictionary=dictionary)
    assert sorted(tuple(r) for r in got.collect()) == plain_collocations(rows, 5, 4, 60)
    assert [t for _, t in got.dtypes] == ["string", "bigint", "string", *["bigint"] * 5]


def test_collocations_of_awkward_rows(spark):
    docs = awkward(spark)
    rows = [(r.lang, r.text) for r in docs.select("lang", "text").collect()]
    got = collocations.collocations(docs, least=2)
    assert sorted(tuple(r) for r in got.collect()) == plain_collocations(rows, 5, 2, 2000)
    assert collocations.collocations(docs.limit(0)).count() == 0


def test_scores_pass_64_bits(spark):
    """Counts of some 10 ** 12 are scored to the last digit."""
    a, n, left, right = 3 * 10**12 + 1, 7 * 10**15 + 3, 3 * 10**12 + 5, 4 * 10**12 + 9
    row = spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long")
    score = row.select(collocations.score().alias("score")).first().score
    assert score == 1000 * a * n // (left * right)


def test_bit_tables_hit_what_was_put_in(spark):
    values = spark.range(5000).select(F.xxhash64("id").alias("h"))
    for bits in (bit_table.bits_for(5000), 20):
        table = np.frombuffer(bit_table.bit_table(values, F.col("h"), bits), np.uint32)
        inside = np.array([r.h for r in values.collect()]).view(np.uint64)
        assert bit_table.hits(table, inside).all()
        others = np.random.default_rng(1).integers(0, 1 << 63, 20_000).astype(np.uint64)
        assert bit_table.hits(table, others).mean() < 0.09
    words = bit_table.bit_words(values, F.col("h"), bits)
    marked = bit_table.with_hit(spark.range(9000).select(F.xxhash64("id").alias("h"), "id"), F.col("h"), words, bits, "met")
    hits = {r.id for r in marked.filter("met").collect()}
    assert hits >= set(range(5000)) and len(hits) < 5200 and marked.count() == 9000
