"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes the result of
each as Parquet in the shared folder and gives it to the next one. All but the last return the
columns of ``docs`` as they are, whatever these columns are; ``doc_id`` and ``text`` must be
among them.

Rows without doc_id are scored, lose common lines and are tested for benchmark items like any
other; only near-duplicate classes can't name them. Null and empty texts, very long ones, repeated
rows and empty tables are what each operator's docstring says; of rows equal in doc_id and text
one is left after the near-duplicate stage, and rows of one doc_id with different texts all stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import (
    line_runs,
    signature_tree,
    string_tiling,
    sum_of_squares,
    toxicity_ssk,
)
from tallyloom.llm.common import read, stage
from tallyloom.llm.registered import TOXIC, tokenizer_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the string-kernel model finds toxic."""
    model = toxicity_ssk.fit_toxicity(docs, read(spark, sf_dir, "labels"), folds=3, held=1)
    return toxicity_ssk.keep_clean(docs, model, TOXIC)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the lines found in at least ten documents from all of them."""
    return line_runs.with_kept_text(docs, min_docs=10)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of each group of near duplicates."""
    classes = signature_tree.near_duplicates(docs, k=5, threshold=80)
    return signature_tree.one_of_each(docs, classes)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item."""
    return string_tiling.without_leaks(docs, read(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents left, and their places in sequences of 4,096 tokens."""
    return sum_of_squares.pack(docs, tokenizer_path(), 4096)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("ngram_join", ngram_join),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Tokenizers and trained models are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
