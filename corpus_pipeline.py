"""Documents to packed sequences: rules, classifier, near-duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept.
All stages but the last return the columns of ``documents``.

Defined cases, in every stage: NULL text counts as empty. Rows with one doc_id are rows of
their own, and rows without a doc_id take part. Repeated rows get equal decisions until
near_duplicates keeps one of them. Very long texts are processed whole. Extra columns stay up to the
last stage, whatever their names. Empty tables pass through as empty ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.llm import fm_quality, line_rules, near_copies, packing, pii
from lamella.llm.common import fold, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go from the texts; documents that fail the base rules or are left depleted go."""
    return line_rules.clean(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine scores below one half go. It learns from labels outside the held-out fold."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    machine = fm_quality.fit(docs, labels, fold("doc_id", 3) != 1)
    name = "_score"
    while name in docs.columns:
        name += "_"
    return fm_quality.with_score(docs, machine, name).filter(F.col(name) >= 0.5).select(*[F.col(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word similarity of 0.8, or three bits of SimHash) stays: the one with the smallest doc_id."""
    return near_copies.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts becomes marks such as [EMAIL]."""
    return pii.mask(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 1024 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]

#: SQL cannot express the classifier; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
