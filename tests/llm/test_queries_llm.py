"""The text queries against their SQL, and against held-out labels."""

from __future__ import annotations

import compare
import pytest

import corpus_pipeline
from eventloom.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_matches_sql(spark, folder, name):
    ours = QUERIES[name](spark, folder).toArrow()
    assert compare.differences(ours, compare.duck(folder).sql(ORACLES[name]).to_arrow_table()) == []


@pytest.mark.parametrize(("name", "label", "least"), [("op3_toxicity", "toxic", 0.8), ("op8_quality", "quality", 0.9)])
def test_held_out_labels(spark, name, label, least):
    folder = "/root/testdata/sf0.01"
    scores = QUERIES[name](spark, folder).toPandas()
    assert len(scores) == 1000 and scores.score.between(0, 1).all()
    met = scores[scores.held_out].merge(spark.read.parquet(f"{folder}/labels.parquet").toPandas(), on="doc_id")
    ranks = met.score.rank()
    good = met[label] == 1
    auc = (ranks[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert auc >= least


def test_pipeline(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, folder), f"test-{name}")
        assert 0 < docs.count() <= before
        before = docs.count()
        if name != "mixing":
            assert docs.columns == columns
    assert docs.where("sample_weight < 1 OR probability > 1 OR probability <= 0").count() == 0
