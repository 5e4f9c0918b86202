"""The pipeline's stages over sf0.001, each against a plain version of its rule."""

import re

import pytest

import corpus_pipeline
from conftest import SF0001
from tapflow.llm import quality


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    out = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF0001).write.parquet(f"{root}/{i}")
        docs = spark.read.parquet(f"{root}/{i}")
        out.append(docs)
    return [d.collect() for d in out]


def test_quality_stage(spark, stages):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{SF0001}/labels.parquet"))
    good = {r.doc_id for r in quality.score(docs, model).where("predicted = 1").collect()}
    assert {r.doc_id for r in stages[1]} == good
    bad = {r.doc_id for r in spark.read.parquet(f"{SF0001}/labels.parquet").where("quality = 0").collect()}
    assert bad and len(bad & good) <= 0.1 * len(bad)


def test_dedup_stage(stages):
    lower = {i: i + 32 for i in range(65, 91)}
    sets = {}
    for r in stages[1]:
        w = re.findall("[^\x20\x09-\x0D]+", (r.text or "").translate(lower))
        sets[r.doc_id] = set(zip(*[w[i:] for i in range(5)])) if len(w) >= 5 else {tuple(w)} if w else set()
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    assert {r.doc_id for r in stages[2]} == {d for d in sets if find(d) == d}


def test_decontamination_stage(spark, stages):
    items = [re.findall(r"[^\W_]+", r.text.lower()) for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()]
    leaked = set()
    for r in stages[2]:
        h = re.findall(r"[^\W_]+", (r.text or "").lower())
        for g in items:
            w = min(13, len(g))
            most = 2 if w >= 13 else 1 if w >= 9 else 0
            seen = {tuple(g[i:i + 4]) for i in range(len(g) - 3)}
            if w >= 8 and any(tuple(h[i:i + 4]) in seen for i in range(len(h) - 3)) and any(
                    sum(x != y for x, y in zip(h[p:p + w], g[q:q + w])) <= most
                    for p in range(len(h) - w + 1) for q in range(len(g) - w + 1)):
                leaked.add(r.doc_id)
    assert {r.doc_id for r in stages[3]} == {r.doc_id for r in stages[2]} - leaked


def test_mixing_and_sharding_stages(stages):
    before = {r.doc_id: r for r in stages[3]}
    words = sum(len((r.text or "").split()) for r in stages[3])
    taken = sum(len((r.text or "").split()) for r in stages[4])
    assert abs(taken - 1.5 * words) <= 256 * 20
    for r in stages[4]:
        own = before[r.doc_id]
        assert (r.lang, r.source) == (own.lang, own.source)
        if r.text != own.text:
            left = iter(own.text.split())
            assert all(w in left for w in r.text.split())  # its words, in their order
    assert sorted((r.doc_id, r.text) for r in stages[5]) == sorted((r.doc_id, r.text) for r in stages[4])
    counts = [sum(r.shard == s for r in stages[5]) for s in range(8)]
    assert max(counts) - min(counts) <= 1


def test_stage_folders_are_deleted(spark):
    """Only the last stage's folder is left, also of an earlier run."""
    import glob
    import os

    from tapflow.session import shared_dir
    root = shared_dir(spark).removeprefix("file:")
    old = set(glob.glob(f"{root}/corpus-pipeline-*"))
    corpus_pipeline.run(spark, SF0001)
    new, = set(glob.glob(f"{root}/corpus-pipeline-*")) - old
    assert [d for d in os.listdir(new) if not d.startswith(".")] == ["4-sharding"]
