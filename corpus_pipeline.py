"""The corpus pipeline: documents through the operators, each stage written and read again.

Documents whose language cannot be told go, then toxic ones, then all but one of each group
of near copies; the rest are repeated as the mix of sources asks and encoded.  Every stage
works on all that the one before kept.  All but the last return the columns they got.

Defined results.  Null, empty and letterless texts go in the first stage, and so do texts whose
n-grams speak against every language; where fewer than two languages can be learned, nothing
can be told and all stay.  Without labels, or without toxic ones, no score reaches the threshold
that a trained one would, and what the scorer says then decides.  Rows that repeat a doc_id are
one document to the near-copy stage: one of them stays, and of equal texts the one with the
smallest doc_id; rows without doc_id stay.  Null sources are a source of their own.  An empty
table gives no rows.  Further columns are carried along, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyworks.llm import language, toxicity
from tallyworks.llm.bpe import encode_documents
from tallyworks.llm.jaccard import keep_one
from tallyworks.llm.mixing import repeat_documents
from tallyworks.sources.shared import settle


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a language is claimed for."""
    return language.keep_known(docs)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the threshold."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return repeat_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted and digested."""
    return encode_documents(spark, docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language", known_language), ("toxicity", not_toxic), ("near_copies", near_copies),
          ("mixing", mixed), ("bpe", encoded)]
# The networks, the kernels and the transducer cannot be stated in SQL; tests hold the stages
# against brute force (tests/llm/test_pipeline_rows.py).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
