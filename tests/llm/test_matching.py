"""Exact copies, the Jaccard join and components against plain versions."""

from __future__ import annotations

import random

import numpy as np
import pytest
from cases import awkward, groups, shingle_set, variants
from compare import KINDS, difference, tables
from orderwatch.llm import common, exact_dedup, jaccard_join, queries
from orderwatch.llm.components import components
from pyspark.sql import functions as F


@pytest.mark.parametrize("name", sorted(queries.ANSWERS))
def test_same_rows_as_in_sql(spark, sf_dir, name):
    KINDS["BOOLEAN"] = "boolean"
    assert difference(queries.QUERIES[name](spark, sf_dir), tables(sf_dir), queries.ANSWERS[name]) is None


def test_copies_of_awkward_rows(spark):
    docs = awkward(spark)
    rows = exact_dedup.exact_groups(docs).collect()
    assert len(rows) == docs.count()
    of = {r.doc_id: r for r in rows}
    assert of[0].keep_id == of[1].keep_id == of[2].keep_id == of[3].keep_id == 3  # the longest of the empty ones
    assert of[4].group_size == 3 and of[4].kept
    assert of[None].keep_id == 7 and not of[None].kept
    assert of[5].keep_id == 5 and of[6].keep_id == 6  # A-Z is not a-z here

    assert exact_dedup.exact_groups(docs.limit(0)).count() == 0


def test_case_and_ties(spark):
    docs = spark.createDataFrame([(3, "a b"), (2, "ab "), (1, "A b")], "doc_id long, text string")
    found = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(docs).collect()}
    assert found == {1: (1, 1, True), 2: (2, 2, True), 3: (2, 2, False)}


def test_copies_go_row_by_row(spark):
    rows = [(None, "same text"), (None, "alone one"), (1, "same text"), (2, "other words"), (2, "same  text"), (2, "third")]
    rows += [(3, "again"), (3, "again"), (3, "ag ain"), (None, ""), (9, None), (None, "nameless"), (None, "nameless")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("decided_id", F.lit("kept"))
    out = exact_dedup.drop_copies(docs.repartition(5))
    assert out.dtypes == docs.dtypes
    expected = [(None, "alone one"), (None, "nameless"), (2, "other words"), (2, "same  text"), (2, "third"), (3, "ag ain")]
    assert sorted(((r.doc_id or 0, r.text or "") for r in out.collect())) == sorted(
        [(i or 0, text) for i, text in expected] + [(9, "")]
    )


def test_near_copies_go_row_by_row(spark, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST", 1)
    a, b, c = ("one two three four five six", "seven eight nine ten eleven", "twelve thirteen fourteen fifteen sixteen")
    rows = [(1, a), (2, a.upper()), (2, b), (None, a), (None, c), (None, c), (3, "x"), (3, "x"), (3, "X"), (4, ""), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = jaccard_join.drop_similar(docs.repartition(5))
    assert out.dtypes == docs.dtypes
    left = sorted((r.doc_id or 0, r.text.lower()) for r in out.collect())
    assert left == [(0, c), (1, a), (2, b), (3, "x"), (4, "")]


def test_a_third_of_all_rows_in_one_group(spark):
    rows = [(i, "same text" if i % 3 == 0 else f"text {i % 500}") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)
    named = exact_dedup.frequent_digests(docs.withColumn("digest", docs.text), tracked=64)
    assert "same text" in {r.digest for r in named.collect()}
    out = exact_dedup.exact_groups(docs, tracked=64).collect()
    assert sum(r.kept for r in out) == len({t for _, t in rows})
    assert {r.group_size for r in out if r.doc_id % 3 == 0} == {2000}
    assert exact_dedup.drop_copies(docs).count() == len({t for _, t in rows})


def test_components_of_random_graphs(spark):
    rnd = random.Random(2)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 440)] + [(5, 5)]
    df = spark.createDataFrame([*edges, (None, 3)], "u long, v long")
    expected = groups({n for e in edges for n in e}, edges)
    touched = {n for a, b in edges if a != b for n in (a, b)}
    assert {r.node: r.component for r in components(df).collect()} == {n: expected[n] for n in touched}
    assert components(df.limit(0)).count() == 0


@pytest.mark.parametrize(("num", "seed"), [(90, 1), (80, 2)])
def test_similar_sets_share_a_key(num, seed):
    rng = np.random.default_rng(seed)
    scheme, checked = jaccard_join.Scheme(num, 100), 0
    for _ in range(3000):
        size = int(rng.choice([1, 2, 3, 5, 8, 10, 15, 20, 40, 100, 300]))
        a = np.unique(rng.integers(1, 2**63, size, dtype=np.uint64))
        changed = int(rng.integers(0, scheme.differences(size, size) + 2))
        left = int(rng.integers(0, changed + 1))
        fresh = rng.integers(1, 2**63, changed - left, dtype=np.uint64)
        b = np.unique(np.concatenate((rng.permutation(a)[: max(1, len(a) - left)], fresh)))
        both = len(np.intersect1d(a, b))
        if 100 * both < num * (len(a) + len(b) - both):
            continue
        checked += 1
        (keys_a, looks_a), (keys_b, looks_b) = scheme.keys(a), scheme.keys(b)
        _, at_a, at_b = np.intersect1d(keys_a, keys_b, return_indices=True)
        assert (looks_a[at_a] | looks_b[at_b]).any()
    assert checked > 500


def plain_groups(texts, k, num):
    sets = {i: shingle_set(t, k) for i, t in texts.items()}
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])
    ]
    return groups(sets, links), {i: len(s) for i, s in sets.items()}


@pytest.mark.parametrize(("k", "num"), [(3, 90), (5, 80)])
def test_groups_like_all_pairs(spark, monkeypatch, k, num):
    monkeypatch.setattr(jaccard_join, "TILE_SETS", 20)  # so that groups take several tiles
    texts = variants(k, [60, 25, 8, 3, 3, 2, 2, *[1] * 40], [4, 9, 20, 60, 150], 4)
    texts = dict(enumerate([*texts, *texts[:30], "", "   ", "one", "ONE", "one two", "one two three"]))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    expected, sizes = plain_groups(texts, k, num)
    rows = jaccard_join.similar_groups(docs, k, num).collect()
    assert {r.doc_id: r.component_id for r in rows} == expected
    assert {r.doc_id: r.n_shingles for r in rows} == sizes
    kept = {r.doc_id for r in jaccard_join.drop_similar(docs, k, num).collect()}
    assert kept == {i for i, group in expected.items() if i == group}


@pytest.mark.parametrize("tile", [1000, 7])
def test_every_link_is_listed_and_counted(spark, monkeypatch, tile):
    monkeypatch.setattr(jaccard_join, "TILE_SETS", tile)
    texts = variants(6, [30, 12, 2, *[1] * 5], [150], 1)
    texts = dict(enumerate([*texts, *texts[:9], "", "one", "ONE", "one two"]))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    sets = {i: frozenset(shingle_set(t, 3)) for i, t in texts.items()}
    alike = {
        (a, b): len(sets[a] & sets[b])
        for a in sets
        for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])
    }
    first = {}
    for i, found in sets.items():
        first.setdefault(found, i)
    expected = {p: n for p, n in alike.items() if first[sets[p[0]]] == p[0] and first[sets[p[1]]] == p[1]}
    assert len(expected) > 60
    rows = jaccard_join.jaccard_links(docs, 3, 90)[2].collect()
    assert len(rows) == len(expected)
    assert {(min(r.u, r.v), max(r.u, r.v)): r.overlap for r in rows} == expected
    counted = {r.doc_id: r.n_links for r in jaccard_join.link_counts(docs, 3, 90).collect()}
    assert counted == {i: sum(i in p for p in alike) for i in texts}


def test_rows_without_an_id_bridge_documents(spark):
    """Two documents that only a row without an id links, and groups in which no row has an id."""
    words = [f"w{i}" for i in range(60)]
    other = [f"v{i}" for i in range(60)]
    bridge = [(8, words), (None, [*words[2:], "x1", "x2"]), (5, [*words[4:], "x1", "x2", "x3", "x4"])]
    nameless = [(None, other), (None, [*other[1:], "y"]), (None, ["z", *other])]
    rows = [(i, " ".join(w)) for i, w in [*bridge, *nameless, (3, ["alone", "here", "now", "then"]), (None, []), (None, [])]]
    texts = dict(enumerate(text for _, text in rows))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    expected, _ = plain_groups(texts, 3, 90)
    assert expected[0] == expected[1] == expected[2]
    assert plain_groups({0: texts[0], 2: texts[2]}, 3, 90)[0] == {0: 0, 2: 2}  # not without the bridge
    found = jaccard_join.similar_groups(docs, 3, 90).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in found) == [(0, 0)] * 5 + [(0, 5), (3, 3), (5, 5), (8, 5)]
    out = [(r.doc_id, r.text) for r in jaccard_join.drop_similar(docs, 3, 90).collect()]
    assert sorted(i or 0 for i, _ in out) == [0, 0, 3, 5]
    assert len({text for i, text in out if i is None} & {texts[3], texts[4], texts[5]}) == 1
    counts = sorted(r.n_links for r in jaccard_join.link_counts(docs, 3, 90).collect())
    assert counts == sorted(sum(a != b and bool(t) and 100 * len(shingle_set(t, 3) & shingle_set(u, 3)) >= 90 * len(shingle_set(t, 3) | shingle_set(u, 3)) for b, u in texts.items()) for a, t in texts.items())


def test_sketches_never_part_similar_sets():
    """Sketches of sets on both sides of a doubling of their parts; forests of few and of many sets join the same."""
    rng = np.random.default_rng(3)
    scheme = jaccard_join.Scheme(80, 100)
    sets = []
    for size in (40, 1020, 1030, 2040, 2060, 9000):
        base = rng.integers(1, 2**63, size, dtype=np.uint64)
        sets += [np.unique(base[: size - i * size // 40]) for i in range(4)]
        sets += [np.unique(np.concatenate((base[: size // 2], rng.integers(1, 2**63, size // 2, dtype=np.uint64))))]
    sizes = np.array([len(x) for x in sets])
    near = jaccard_join.Near(scheme, sizes, [jaccard_join.sketch(x) for x in sets])
    linked = []
    for i in range(len(sets)):
        found = near.distances(i, np.arange(len(sets)))
        assert (near.distances(np.full(len(sets), i), np.arange(len(sets))) == found).all()
        for j in range(len(sets)):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 80 * (sizes[i] + sizes[j] - both):
                assert found[j] < jaccard_join.FAR
            if found[j] < jaccard_join.FAR:
                assert found[j] <= sizes[i] + sizes[j] - 2 * both
                linked.append((i, j))
    # Of large sets, those that share half of their shingles are told apart.
    assert all(i // 5 == j // 5 for i, j in linked) and not any(i % 5 == 4 != j % 5 for i, j in linked if sizes[i] > 2000)
    few = near.small_forests(np.array([0]), np.array([len(sets)]))
    assert groups(range(len(sets)), few.tolist()) == groups(range(len(sets)), near.forest()) == groups(range(len(sets)), linked)


def test_keys_of_the_same_sets_are_kept_once(spark):
    rows = [(1, 5), (1, 6), (2, 5), (2, 6), (3, 5), (3, 6), (3, 7), (4, 6), (4, 7), (5, 6), (5, 7)]
    members = spark.createDataFrame(rows, "key long, set long")
    found = jaccard_join.one_of_each(members).collect()
    assert sorted(tuple(r) for r in found) == [(1, 5), (1, 6), (3, 5), (3, 6), (3, 7), (4, 6), (4, 7)]


def test_groups_of_awkward_rows(spark):
    docs = awkward(spark)
    rows = jaccard_join.similar_groups(docs, 3, 90).collect()
    assert len(rows) == docs.count()
    of = {r.doc_id: r.component_id for r in rows if r.doc_id is not None}
    assert of[0] == 0 and of[1] == 1 and of[8] == 7 and of[4] == 4 and of[6] == 5
    assert {r.component_id for r in rows if r.doc_id is None} == {7}
    assert jaccard_join.similar_groups(docs.limit(0), 3, 90).count() == 0
    assert jaccard_join.drop_similar(docs).columns == docs.columns
