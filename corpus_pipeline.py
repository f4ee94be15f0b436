"""Corpus pipeline over ``documents``: toxicity, quality, near duplicates, decontamination, packing.

Each stage takes what its predecessor kept and applies one operator of ``peerscope.llm``; its decisions take
effect.  ``run`` writes every stage's result to the checkpoint folder and reads it again, so lineage is cut between stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from peerscope.llm import decontaminate, ngram_join, packing, quality, toxicity
from peerscope.llm.common import read
from peerscope.llm.registry import vocabulary_path
from peerscope.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain calls toxic go."""
    return toxicity.reject(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.reject(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each group of linked ones stays: five words, similarity of 0.8 or more."""
    return ngram_join.one_of_each(docs, n=5, threshold=0.8)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out; documents that are mostly such passages go."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in sequences of 1024."""
    return packing.pack(docs, vocabulary_path())


STAGES = [("toxicity", drop_toxic), ("quality", drop_low_quality), ("near_duplicates", drop_near_duplicates),
          ("decontamination", cut_benchmark), ("packing", pack)]

#: Classifiers and tokenizers have no SQL; the stages are tested against brute force and held-out rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
