"""Each stage of the pipeline on its own input against brute force."""

import os

import pytest
from test_filters import contaminated, keep, linked, read, words

import corpus_pipeline

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [(r.doc_id, r.text) for r in docs.collect()]
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        after = {r.doc_id for r in docs.collect()}
        if name == "toxicity":
            toxic = {i for i, _, t in read("labels") if t == 1}
            clean = {i for i, _, t in read("labels") if t == 0}
            assert len(after & clean) >= 0.97 * len(clean) and len(after & toxic) <= 0.3 * len(toxic)
        elif name == "exact dedup":
            assert after == {r[0] for r in keep(before) if r[3]}
        elif name == "simhash near-dedup":
            assert after == {r[2] for r in linked(before)}
        elif name == "benchmark decontamination":
            items = read("benchmark")
            some = [x for x in before if x[0] % 5 == 0]  # brute force is slow
            assert {i for i, _ in some} & after == {i for i, t in some if not contaminated(t, items)[4]} and len(after) < len(before)
        else:
            assert after == {i for i, _ in before}
        if name != "mixing":
            assert docs.columns == columns
    assert {r.doc_id for r in corpus_pipeline.run(spark, FOLDER).collect()} == after


def test_stages_decide_every_row(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = read("benchmark")
    grams = {tuple(w[i : i + 13]) for w in (words(t) for _, t in items) for i in range(max(1, len(w) - 12))}
    sizes = {len(g) for g in grams}

    def touched(text):
        doc = words(text)
        return any(tuple(doc[i : i + n]) in grams for n in sizes for i in range(len(doc) - n + 1))

    want = {r.doc_id for r in docs.collect() if not (touched(r.text) and contaminated(r.text, items)[4])}
    assert {r.doc_id for r in corpus_pipeline.decontamination(spark, docs, FOLDER).collect()} == want


def test_toxicity_stage_on_held_out_labels(spark, tmp_path):
    folder = FOLDER.replace("0.001", "0.1")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    labels.where("doc_id % 4 != 0").write.parquet(str(tmp_path / "labels.parquet"))
    held = spark.read.parquet(f"{folder}/documents.parquet").join(labels.where("doc_id % 4 = 0").select("doc_id", "toxic"), "doc_id")
    docs = spark.read.parquet(f"{folder}/documents.parquet").join(labels.select("doc_id"), "doc_id", "left_semi")
    after = {r.doc_id for r in corpus_pipeline.toxicity(spark, docs, str(tmp_path)).select("doc_id").collect()}
    rows = held.select("doc_id", "toxic").collect()
    clean, toxic = ([r.doc_id in after for r in rows if r.toxic == k] for k in (0, 1))
    assert sum(clean) >= 0.995 * len(clean) and sum(toxic) <= 0.1 * len(toxic)
