"""The pipeline, stage by stage, against plain Python on the small tables."""

import numpy as np
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from sensorflow.llm import bpe, near_dedup, queries, secrets

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def near_groups(docs):
    root = {d["doc_id"]: d["doc_id"] for d in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    words = {d["doc_id"]: near_dedup.word_hashes(d["text"], {}).astype(np.uint32) for d in docs}
    for n, a in enumerate(docs):
        pairs = [(words[a["doc_id"]], words[b["doc_id"]]) for b in docs[:n]]
        for b, ok in zip(docs[:n], near_dedup.similar(pairs)):
            if a["text"] == b["text"] or (ok and len(words[a["doc_id"]])):
                i, j = sorted((find(a["doc_id"]), find(b["doc_id"])))
                root[j] = i
    return {find(i) for i in root}


def test_stages_against_plain_python(spark):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "quality_classifier", "minhash_near_dedup", "secret_scans", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plain = sorted(pq.read_table(f"{SF}/documents.parquet").to_pylist(), key=lambda d: d["doc_id"])
    columns = docs.columns

    tox = queries.toxicity_model(spark, SF)
    plain = [d for d in plain if tox.score(d["text"] or "", {}) < queries.TOXIC_AT]
    step = stages["toxicity"](spark, docs, SF).checkpoint()
    assert rows_of(step) == sorted((tuple(d.values()) for d in plain), key=str)

    net = queries.quality_model(spark, SF)
    plain = [d for d in plain if net.scores([d["text"]])[0] >= queries.QUALITY_AT]
    step = stages["quality_classifier"](spark, step, SF).checkpoint()
    assert rows_of(step) == sorted((tuple(d.values()) for d in plain), key=str)

    keep = near_groups(plain)
    plain = [d for d in plain if d["doc_id"] in keep]
    step = stages["minhash_near_dedup"](spark, step, SF).checkpoint()
    assert rows_of(step) == sorted((tuple(d.values()) for d in plain), key=str)

    enc = secrets.vocabulary(queries.RANKS_FILE)
    for d in plain:
        d["text"] = secrets.redact(d["text"], secrets.find_spans(d["text"], enc))
        d["n_chars"] = len(d["text"])
    step = stages["secret_scans"](spark, step, SF).checkpoint()
    assert step.columns == columns
    assert rows_of(step) == sorted((tuple(d.values()) for d in plain), key=str)

    codec = bpe.codec(queries.BPE_FILE)
    want = {d["doc_id"]: len(codec.encode(d["text"])) + 1 for d in plain}
    got = {}
    for r in stages["packing"](spark, step, SF).collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == want


def test_run_applies_all_stages(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns[:2] == ["doc_id", "start"]
    assert 0 < got.select("doc_id").distinct().count() <= 200


@pytest.mark.parametrize("kind", ["odd", "empty"])
def test_stages_on_odd_and_no_rows(spark, request, kind):
    docs = request.getfixturevalue(kind)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF)
        assert kept.columns == docs.columns, name
        assert kept.count() <= docs.count()
    assert (corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 0) == (kind == "empty")
