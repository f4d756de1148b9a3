"""Every stage on what its predecessor kept, against plain versions, and the operators left out."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import corpus_pipeline
import pytest
from cases import awkward, groups, shingle_set
from orderwatch.llm import quality, queries, secret_scan
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    kept = {"documents": spark.read.parquet(f"{sf_dir}/documents.parquet")}
    docs = kept["documents"]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(str(folder / name))
        docs = kept[name] = spark.read.parquet(str(folder / name))
    return kept


def test_stages_and_columns(stages):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "exact_dedup", "jaccard_join", "secret_scan", "packing"]
    for name in names[:-1]:
        assert stages[name].dtypes == stages["documents"].dtypes


def test_rejected_documents_go(spark, sf_dir, stages):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept = {r.doc_id for r in stages["quality_classifier"].collect()}
    marked = {r.doc_id: r.quality for r in labels.filter(quality.held_out("doc_id")).collect()}
    assert all(doc in kept for doc, good in marked.items() if good)
    assert sum(doc in kept for doc, good in marked.items() if not good) <= 0.2 * sum(not g for g in marked.values())


def test_one_of_each_group_of_copies(stages):
    before, after = stages["quality_classifier"].collect(), {r.doc_id for r in stages["exact_dedup"].collect()}
    best = {}
    for r in before:
        key = (r.text or "").translate(dict.fromkeys(map(ord, " \t\n\x0b\x0c\r")))
        best[key] = min(best.get(key, (1, 0)), (-len(r.text or ""), r.doc_id))
    assert after == {doc for _, doc in best.values()}


def test_one_of_each_group_of_near_copies(stages):
    sets = {r.doc_id: shingle_set(r.text, 5) for r in stages["exact_dedup"].collect()}
    holders, shared = {}, {}
    for doc, found in sets.items():
        for shingle in found:
            for other in holders.setdefault(shingle, []):
                shared[other, doc] = shared.get((other, doc), 0) + 1
            holders[shingle].append(doc)
    links = [p for p, n in shared.items() if 100 * n >= 80 * (len(sets[p[0]]) + len(sets[p[1]]) - n)]
    expected = {doc for doc, group in groups(sets, links).items() if doc == group}
    assert {r.doc_id for r in stages["jaccard_join"].collect()} == expected


def test_secrets_are_masked(stages):
    scan = secret_scan.scanner(queries.RANKS, queries.SPLITS).spans
    before = {r.doc_id: r for r in stages["jaccard_join"].collect()}
    after = {r.doc_id: r for r in stages["secret_scan"].collect()}
    assert before.keys() == after.keys()
    assert any("[SECRET]" in r.text for r in after.values())
    for doc, r in after.items():
        assert not scan(r.text) and r.n_chars == len(r.text)
        assert scan(before[doc].text) or r == before[doc]


def test_packed_documents(stages):
    rows = stages["packing"].collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in stages["secret_scan"].collect()}
    assert all(0 < r.length <= 2048 and r.offset + r.length <= 2048 for r in rows)
    totals = {}
    for r in rows:
        totals[r.doc_id] = totals.get(r.doc_id, 0) + r.length
    assert all(totals[r.doc_id] == r.doc_tokens for r in rows)


def test_run_gives_the_last_stage(spark, sf_dir, stages):
    order = ["doc_id", "start"]
    assert corpus_pipeline.run(spark, sf_dir).orderBy(order).collect() == stages["packing"].orderBy(order).collect()


def test_stages_take_awkward_rows(spark, sf_dir):
    docs = awkward(spark).select("doc_id", "text", "lang", "source", "n_chars").withColumn("kept", F.lit("other"))
    for part in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, part, sf_dir)
            assert out.count() <= 2 * docs.count()


def test_the_rest_works_without_these_operators(tmp_path):
    """`__spark_entry__` from a copy of the repository that lacks them."""
    for path in ("__spark_entry__.py", "orderwatch"):
        subprocess.run(["cp", "-r", str(ROOT / path), str(tmp_path)], check=True)
    (tmp_path / "orderwatch" / "llm").rename(tmp_path / "elsewhere")
    code = "import __spark_entry__ as e; q = e.queries(); assert 'realtime_stats' in q and not any(n.startswith('op') for n in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PYTHONPATH": str(tmp_path), "PATH": "/usr/bin"}, check=True)
