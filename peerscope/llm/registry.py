"""Registered queries of the corpus operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from peerscope.llm import (chat_format, decontaminate, fill_in_middle, fingerprints, hard_negatives, licenses, ngram_join, packing,
                           personal_data, quality, token_counts, toxicity, warc)
from peerscope.llm.common import read

VOCABULARY = "byte_bpe_50k.json"


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"), vocabulary_path())


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return licenses.scan(docs, licenses.fit(docs))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(decontaminate.scan(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")))


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(read(spark, sf_dir, "documents"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(read(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), vocabulary_path())


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat_format.with_hard_conversation(read(spark, sf_dir, "conversations"))
    return chat_format.read_back(chat_format.format_turns(rows))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.digests(personal_data.find(read(spark, sf_dir, "documents")))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(fill_in_middle.transform(read(spark, sf_dir, "documents")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_token_counts, op2_license_scan, op3_decontaminate, op4_document_fingerprints, op5_ngram_jaccard_join, op6_warc,
    op7_toxicity, op8_best_fit_packing, op9_quality, op10_chat_format, op11_personal_data, op12_fill_in_middle, op13_hard_negatives)}

ORACLES: dict[str, str] = {
    "op3_decontaminate": decontaminate.ORACLE_SQL,
    "op5_ngram_jaccard_join": ngram_join.ORACLE_SQL,
    "op6_warc": warc.ORACLE_SQL,
    "op10_chat_format": chat_format.ORACLE_SQL,
    "op12_fill_in_middle": fill_in_middle.ORACLE_SQL,
    "op13_hard_negatives": hard_negatives.ORACLE_SQL,
}
