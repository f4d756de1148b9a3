"""Quality classifier, line rules and URL filter: held-out accuracy and plain versions."""

from __future__ import annotations

import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from cases import WORD, awkward
from orderwatch.llm import line_rules, quality, queries, url_filter
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet").cache()
    return read("documents"), read("labels")


def marked(labels):
    return {r.doc_id: r.quality for r in labels.collect()}


def test_held_out_accuracy(spark, sf_dir, tables):
    labels = marked(tables[1])
    rows = queries.QUERIES["op9_quality_classifier"](spark, sf_dir).collect()
    assert len(rows) == tables[0].count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    tested = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in tested) >= 0.95 * len(tested)
    assert all(r.predicted for r in tested if labels[r.doc_id] == 1)


def test_scores_do_not_depend_on_held_out_labels_or_other_columns(spark, tables):
    docs, labels = tables
    turned = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    plain = quality.quality_scores(docs, labels, sample=200)
    other = quality.quality_scores(docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit(1)), turned, sample=200)
    assert {r.doc_id: round(r.score, 9) for r in plain.collect()} == {r.doc_id: round(r.score, 9) for r in other.collect()}


def test_temperature_calibrates():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 4))
    y = (rng.random(3000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    model = quality.fit(x[:2000], y[:2000], rounds=40)
    p = model.probabilities(x[2000:])
    assert abs(p.mean() - y[2000:].mean()) < 0.05
    assert ((p > 0.5) == y[2000:]).mean() > 0.75


def test_word_vectors_like_a_double_loop(spark):
    """Over any partitions, the sum of the index vectors of all words within reach in the same text."""
    rnd = random.Random(6)
    texts = [" ".join(rnd.choices(["alpha", "Beta", "GAMMA", "x", "é", "!", "alpha alpha"], k=rnd.randint(0, 30))) for _ in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None, ""])], "doc_id long, text string")
    words = quality.vocabulary(docs, most=3)
    dims, signs = words.index_vectors()
    plain = np.zeros((words.rows, quality.DIMS))
    for text in [*texts, "", ""]:
        rows = words.rows_of(text).tolist()
        for i, here in enumerate(rows):
            for j, there in enumerate(rows):
                if 0 < abs(i - j) <= quality.REACH:
                    plain[here, dims[there]] += signs[there]
    plain /= np.maximum(np.linalg.norm(plain, axis=1, keepdims=True), 1e-9)
    for parts in (1, 7):
        assert np.allclose(quality.word_vectors(docs.repartition(parts), words), plain, atol=1e-6)
    assert plain.any()


def test_frequent_words_of_one_shared_row_are_told_apart(spark):
    """Two words with one hash: as frequent words they have rows of their own, and texts of them score apart."""
    names = {}
    first, second = next(
        (names[slot], word)
        for word in (f"w{i}" for i in range(200_000))
        if (slot := zlib.crc32(word.encode()) & (quality.SHARED_ROWS - 1)) in names or names.setdefault(slot, word) is None
    )
    few = quality.Vocabulary({})
    assert few.row(first.encode()) == few.row(second.encode())
    rows = [(i, f"good {first} fine words {first} here") if i % 2 else (i, f"bad {second} junk junk {second} now") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, quality int")
    words = quality.vocabulary(docs)
    assert words.row(first.encode()) != words.row(second.encode())
    tried = spark.createDataFrame([(1000, first), (1001, second)], "doc_id long, text string")
    model = quality.train(docs, labels)
    scores = {r.doc_id: r.score for r in tried.select("doc_id", quality.score_column(model, tried, F.col("text")).alias("score")).collect()}
    assert scores[1000] - scores[1001] > 0.2


def test_one_of_several_texts_of_an_id_is_learnt_from(spark):
    rows = [(i, f"text {j} of {i}") for i in range(60) for j in range(3)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scores = [sorted((r.doc_id, round(r.score, 6)) for r in quality.quality_scores(docs.repartition(n), labels).collect()) for n in (2, 5)]
    assert scores[0] == scores[1]


def test_quality_of_awkward_rows(spark, tables):
    docs, labels = awkward(spark), tables[1]
    rows = quality.quality_scores(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality.quality_scores(docs.limit(0), labels).count() == 0
    unlabelled = quality.quality_scores(docs, labels.limit(0)).collect()
    assert {r.score for r in unlabelled} == {0.5} and {r.predicted for r in unlabelled} == {1}
    assert quality.keep_good(docs, labels.limit(0)).columns == docs.columns


def plain_counts(text):
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    places = {}
    for i in range(len(words) - 2):
        places.setdefault(tuple(words[i : i + 3]), []).append(i)
    repeated = {i + by for found in places.values() if len(found) > 1 for i in found for by in range(3)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(repeated),
    )


def test_line_rules_query(spark, sf_dir, tables):
    texts, labels = {r.doc_id: r.text or "" for r in tables[0].collect()}, marked(tables[1])
    rows = queries.QUERIES["op2_quality_rules"](spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        counts = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert counts == plain_counts(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    judged = [r for r in rows if r.doc_id in labels and not r.base_failed]
    assert all(r.kept for r in judged if labels[r.doc_id] == 1)
    bad = [r for r in judged if labels[r.doc_id] == 0]
    assert sum(r.kept for r in bad) <= 0.1 * len(bad)


def test_viterbi_finds_the_best_labelling():
    rng = np.random.default_rng(4)
    for _ in range(200):
        size = int(rng.integers(1, 9))
        field = line_rules.Field(rng.normal(size=(line_rules.FEATURES, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
        x = rng.normal(size=(size, line_rules.FEATURES))

        def score(labels, field=field, x=x):
            scores = x @ field.emission
            total = field.start[labels[0]] + sum(scores[i, label] for i, label in enumerate(labels))
            return total + sum(field.transition[a, b] for a, b in itertools.pairwise(labels))

        best = max(itertools.product((0, 1), repeat=size), key=score)
        assert math.isclose(score(field.decode(x).tolist()), score(best))


def test_fit_learns_neighbours():
    """A feature that tells little about single lines; labels come in long runs."""
    rng = np.random.default_rng(7)
    sequences = []
    for _ in range(150):
        y = np.repeat(rng.integers(0, 2, 4), 8)
        x = np.zeros((32, line_rules.FEATURES))
        x[:, 0] = 1
        x[:, 1] = y + rng.normal(0, 0.8, 32)
        sequences.append((x, y))
    field, alone = line_rules.fit_field(sequences), line_rules.fit_field(sequences, chained=False)
    right = [np.mean([(f.decode(x) == y).mean() for x, y in sequences]) for f in (field, alone)]
    assert right[0] > right[1] + 0.1


def test_line_rules_of_awkward_rows(spark, tables):
    docs = awkward(spark)
    for labels in (tables[1], tables[1].limit(0)):
        rows = line_rules.quality_rules(docs, labels).collect()
        assert len(rows) == docs.count()
        assert all(r.base_failed and not r.kept for r in rows if r.n_words == 0)
        assert line_rules.quality_rules(docs.limit(0), labels).count() == 0


def plain_rule(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = None
    for rule in url_filter.RULES:
        name, _, start = rule.text.partition("/")
        at_host = host == name or host.endswith("." + name)
        if at_host and path.startswith("/" + start) and (best is None or len(rule.text) > len(best.text)):
            best = rule
    return host, path, best and best.text, best and best.verdict


def test_url_query(spark, sf_dir):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url").collect()}
    rows = queries.QUERIES["op1_url_filter"](spark, sf_dir).collect()
    assert {r.page_id for r in rows} == set(urls)
    for r in rows:
        host, path, rule, verdict = plain_rule(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    free = [r for r in rows if r.rule is None]
    assert all(r.verdict == "block" for r in free if re.search("spam-|casino", r.host))
    assert sum(r.verdict == "block" for r in free if not re.search("spam|casino|pills|ads|bets|adult", r.host)) == 0


def plain_split(run, counts, total):
    best = None
    for cuts in itertools.product((0, 1), repeat=len(run) - 1):
        words, word = [], run[0]
        for letter, new in zip(run[1:], cuts, strict=True):
            if new:
                words.append(word)
                word = ""
            word += letter
        words.append(word)
        score = sum(
            math.log(counts[w] / total) if w in counts else -math.log(total + 1) - len(w) * math.log(10) for w in words
        )
        if best is None or score > best[0] + 1e-12:
            best = (score, words)
    return best[0]


def test_words_in_hosts(spark):
    rnd = random.Random(3)
    counts = {"".join(rnd.choices("abc", k=rnd.randint(1, 4))): rnd.randint(1, 50) for _ in range(20)}
    total = sum(counts.values())
    hosts = ["".join(rnd.choices("abc", k=rnd.randint(1, 11))) for _ in range(60)]
    df = spark.createDataFrame([(f"{h}.{hosts[0]}-x",) for h in hosts], "host string")
    words = spark.createDataFrame(list(counts.items()), "word string, count long")
    cost = lambda ws: sum(
        math.log(counts[w] / total) if w in counts else -math.log(total + 1) - len(w) * math.log(10) for w in ws
    )
    found = {r.host: r.words for r in url_filter.segmented_hosts(df, words).collect()}
    assert len(found) == len(set(hosts))
    for host, split in found.items():
        assert "".join(split) == host.replace(".", "").replace("-", "")
        expected = sum(plain_split(run, counts, total) for run in re.findall("[a-z]+", host))
        assert math.isclose(cost(split), expected, rel_tol=1e-9)


def test_long_known_words_stay_whole(spark):
    """Words have no greatest length, and neither have stretches that no word explains."""
    word = "kraftfahrzeughaftpflichtversicherung"
    words = spark.createDataFrame([(word, 3), ("my", 50), ("shop", 40), ("pf", 30)], "word string, count long")
    hosts = [f"my{word}shop", word, "q" * 45, "q" * 30 + "shop", "my" + "q" * 3000]
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    found = {r.host: r.words for r in url_filter.segmented_hosts(df, words).collect()}
    assert [found[h] for h in hosts] == [["my", word, "shop"], [word], ["q" * 45], ["q" * 30, "shop"], ["my", "q" * 3000]]
    pages = spark.createDataFrame([(f"<p>{word} {word}</p>",)], "html string")
    assert {r.word: r["count"] for r in url_filter.word_counts(F.col("html"), pages).collect()} == {word: 2}


def test_words_beyond_those_sent_are_joined(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").limit(400)
    some = pages.select("page_id", "url", "html")
    rows = [(r.page_id, r.verdict, round(r.block_odds, 6)) for r in url_filter.judge_urls(some).collect()]
    few = [(r.page_id, r.verdict, round(r.block_odds, 6)) for r in url_filter.judge_urls(some, sent=7).collect()]
    assert sorted(rows) == sorted(few) and len({odds for _, _, odds in rows}) > 20


def test_bayes_blocks_what_goes_with_marked_words(spark):
    urls = [(i, f"http://cheap-pills.x/buy/{i}", "") for i in range(40)]
    urls += [(100 + i, f"http://garden-news.x/read/{i}", "") for i in range(40)]
    urls += [(200, "http://pillsforyou.x/buy/1", "cheap pills for you for you"), (201, "http://other.x/read/2", "")]
    pages = spark.createDataFrame(urls, "page_id long, url string, html string")
    verdicts = {r.page_id: r.verdict for r in url_filter.judge_urls(pages, rules=()).collect()}
    assert verdicts[0] == verdicts[200] == "block" and verdicts[100] == verdicts[201] == "allow"


def test_urls_of_awkward_rows(spark):
    urls = [None, "", "no scheme", "http://", "http://COM/", "http://a.com", "x://net/es/y?q#f", "http://É.net/fr/", "http://" + "a" * 3000]
    rows = [(i, u, None, "clash", "clash") for i, u in enumerate(urls)] + [(0, None, None, "", ""), (None, "http://a.com/b", "", "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, words string, host string")
    found = url_filter.judge_urls(pages).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.page_id is not None:
            assert (r.host, r.path, r.rule) == plain_rule(urls[r.page_id])[:3]
    assert all(r.verdict == "allow" for r in found if not r.host)
    assert url_filter.judge_urls(pages.limit(0)).count() == 0
