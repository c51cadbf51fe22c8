"""The pipeline's stages against plain versions."""

import re

import corpus_pipeline
import pyarrow.parquet as pq
import pytest
from brute import base_spans, mixing_targets, near_components
from paths import SMALL
from pyspark.sql import functions as F
from test_operators import DOCS, EDGES

from millrace.llm import private_data


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = {"start": docs}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SMALL).write.parquet(path)
        out[name] = docs = spark.read.parquet(path)
    return out


def texts(frame):
    return {r.doc_id: r.text for r in frame.select("doc_id", "text").collect()}


def test_stages_return_documents(stages):
    for name in ("toxicity", "near_copies", "decontamination", "private_data"):
        assert stages[name].columns == stages["start"].columns


def test_toxic_documents_go(stages):
    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{SMALL}/labels.parquet").to_pylist()}
    kept = set(texts(stages["toxicity"]))
    assert all(i in kept for i, t in labels.items() if t == 0 and i in texts(stages["start"]))


def test_one_of_each_group_stays(stages):
    want, _ = near_components(texts(stages["toxicity"]), 5, 80)
    assert set(texts(stages["near_copies"])) == {i for i, c in want.items() if i == c}


def test_benchmark_passages_go(stages):
    plain = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    items = [plain(t) for t in pq.read_table(f"{SMALL}/benchmark.parquet")["text"].to_pylist()]
    before = texts(stages["near_copies"])
    assert set(texts(stages["decontamination"])) == {i for i, t in before.items() if not any(b in plain(t) for b in items)}


def test_personal_data_is_masked(stages):
    before, after = texts(stages["decontamination"]), texts(stages["private_data"])
    anchors = private_data.automaton()
    assert after == {i: private_data.redacted(t, private_data.spans_of(t, anchors)) for i, t in before.items()}
    assert not any(base_spans(t) for t in after.values())


def test_mixture(stages):
    rows = stages["mixing"].collect()
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    for s, t in mixing_targets(sizes).items():
        own = [r for r in rows if r.source == s]
        assert abs(sum(r.taken for r in own) - t) <= max(r.size for r in own)
    assert {r.doc_id for r in rows} == set(texts(stages["private_data"]))


def test_run_is_the_stages(spark, stages):
    key = lambda r: r.doc_id
    assert sorted(corpus_pipeline.run(spark, SMALL).collect(), key=key) == sorted(stages["mixing"].collect(), key=key)


def test_stages_take_edges_and_nothing(spark):
    frame = spark.createDataFrame(EDGES, DOCS)
    for docs in (frame, frame.where("false")):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SMALL)
            assert out.count() <= docs.count(), name
            assert name == "mixing" or out.columns == docs.columns
