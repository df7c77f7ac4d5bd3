"""The registered queries and the pipeline on the smallest tables."""

import pytest

import corpus_pipeline
from tests.oracle import compare, duck
from tidewright.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    ok, note = compare(spark, SF, QUERIES[name], ORACLES.get(name), duck(SF))
    assert ok, note


def test_pipeline_stages_keep_the_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, None
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if i < 4:
            assert docs.columns == columns
        if i < 3:
            ids = {r.doc_id for r in docs.select("doc_id").collect()}
            assert before is None or ids <= before
            before = ids
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_pipeline_on_an_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
