"""The pipeline as a whole, against its operators and brute force."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from sparkmine.llm import simhash  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    root, docs = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], SF_DIR).write.parquet(f"{root}/{name}")
        out.append(spark.read.parquet(f"{root}/{name}"))
    return out


def test_stages(steps):
    docs, known, single, clean, mixed, tokens = steps
    for later in (known, single, clean, mixed):
        assert later.columns == docs.columns
    text = {r.doc_id: r.text for r in docs.collect()}
    assert all(text[r.doc_id] == r.text for r in mixed.collect())
    # Near-duplicates: one document, that of the smallest id, of each class.
    fps = {r.doc_id: simhash.fingerprint(r.text) for r in known.collect()}
    root = {i: i for i in fps}
    for _ in fps:
        root = {i: min(root[j] for j in fps if (fps[i] ^ fps[j]).bit_count() <= 2 or fps[i] == fps[j]) for i in fps}
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(root.values()))
    # Decontamination: documents with a whole item go.
    items = [" ".join(r.text.split()) for r in steps[0].sparkSession.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    holds = {i for i, t in text.items() if any(x in " ".join(t.split()) for x in items)}
    single_ids, clean_ids = {r.doc_id for r in single.collect()}, {r.doc_id for r in clean.collect()}
    assert single_ids - clean_ids == single_ids & holds
    assert sorted(r.doc_id for r in mixed.collect()) == sorted(r.doc_id for r in tokens.collect())


def test_run_agrees_with_the_stages(spark, steps):
    got = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, steps[-1].collect()))
