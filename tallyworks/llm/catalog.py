"""Queries of the operators over their whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyworks.llm.alignment import digest_alignments
from tallyworks.llm.bpe import encode_documents
from tallyworks.llm.jaccard import near_duplicates as near_texts
from tallyworks.llm.language import identify
from tallyworks.llm.main_text import extract_pages
from tallyworks.llm.mixing import mix_sources
from tallyworks.llm.periodic_runs import digest_runs
from tallyworks.llm.statements import ORACLES as ORACLES
from tallyworks.llm.token_counts import count_tokens
from tallyworks.llm.topk_search import search
from tallyworks.llm.toxicity import score_documents
from tallyworks.llm.url_rules import judge_urls
from tallyworks.llm.vector_dedup import near_duplicates as near_vectors
from tallyworks.llm.warc import archive_pages


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


def topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))


def warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(spark, table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"),
                        public_tokenizers.path("byte_bpe_50k.json"))


def bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(spark, table(spark, sf_dir, "documents"),
                            public_tokenizers.path("word_bpe_49k.json"))


def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_texts(table(spark, sf_dir, "documents"))


def vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_runs(table(spark, sf_dir, "documents"))


def alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_alignments(table(spark, sf_dir, "documents"),
                             public_tokenizers.path("byte_bpe_50k.json"),
                             public_tokenizers.path("piece_bpe_32k.model"))


def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


QUERIES = {
    "op1_mixing": mixing,
    "op2_toxicity": toxicity,
    "op3_jaccard": jaccard,
    "op4_topk_search": topk_search,
    "op5_warc": warc,
    "op6_token_counts": token_counts,
    "op7_bpe": bpe,
    "op8_vector_dedup": vector_dedup,
    "op9_language": language,
    "op10_url_rules": url_rules,
    "op11_periodic_runs": periodic_runs,
    "op12_alignment": alignment,
    "op13_main_text": main_text,
}
