"""Every query of the subpackage: against its SQL statement, or whole and stable."""

from __future__ import annotations

import corpus_pipeline
import pytest
from compare import connect, difference
from tallyworks.llm.catalog import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
ROWS = {"op2_toxicity": "documents", "op3_jaccard": "documents", "op7_bpe": "documents",
        "op8_vector_dedup": "embeddings", "op9_language": "documents",
        "op11_periodic_runs": "documents", "op12_alignment": "documents",
        "op13_main_text": "pages"}


@pytest.mark.parametrize("name", ORACLES)
def test_against_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) is None


@pytest.mark.parametrize("name", ROWS)
def test_a_row_for_every_row(spark, name):
    rows = spark.read.parquet(f"{SF_DIR}/{ROWS[name]}.parquet").count()
    assert QUERIES[name](spark, SF_DIR).count() == rows


def test_every_query_is_checked():
    assert set(QUERIES) == {*ORACLES, *ROWS}


def test_pipeline_stages(spark, odd_documents, no_documents, documents):
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF_DIR)
        assert kept.columns == docs.columns, name
        assert name == "mixing" or kept.exceptAll(docs).count() == 0
        docs = kept
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0
    for docs in (odd_documents, no_documents):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF_DIR)
        docs.count()
