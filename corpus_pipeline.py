"""A pipeline from raw documents to packed training sequences.

Quality classifier and quality rules take out the documents they reject, of each group of near copies
one document stays, personal data are replaced by their kind, and what is left is packed. Every stage
but the last returns the columns of the table `documents`; between stages the rows are written and read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pathloom.llm import ngram_join, packing, pii, quality_crf, quality_rules
from pathloom.llm.shared import table, written


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_crf.filter_documents(docs, table(spark, sf_dir, "labels"))


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.filter_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.drop_near_copies(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs, pii.train(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", classify),
    ("quality rules", apply_rules),
    ("n-gram Jaccard join", drop_near_copies),
    ("personal data", redact),
    ("best-fit packing", pack),
]

#: No SQL: the first stage is a trained model. Tests hold near copies, redaction and packing against plain versions, the
#: rules against SQL, the classifier against held-out labels, and the run against its stages.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, "stage")
    return docs
