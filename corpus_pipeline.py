"""The corpus pipeline: five stages over ``documents``, each rereading what the one before wrote.

1. quality classifier: documents scored under its cutoff go;
2. quality rules: documents that fail the base rules or lie outside the robust estimate go;
3. near duplicates (five-word shingles, similarity 0.8): one document of each group stays;
4. benchmark decontamination: documents that hold a window of an item go;
5. mixing: the columns of documents and, per document, the words that the mix takes.

Texts pass through whole.  ``ORACLE_SQL`` is None: the fit of the classifier, the concentration
steps and the pseudorandom mix have no SQL form; tests compare the stages with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from layercake.llm import bayes_minhash, mix_weights, nbsvm, prefix_join, robust_outliers
from layercake.llm.common import materialize, table

ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return nbsvm.good_documents(docs, table(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return robust_outliers.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bayes_minhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return prefix_join.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_weights.mixed_documents(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("minhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing to target weights", mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written and reread."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{k + 1}")
    return docs
