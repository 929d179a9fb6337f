"""The corpus pipeline: from the table of documents to packed training sequences.

Every stage works on all rows that its predecessor kept and is written as Parquet before the next
one reads it. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldseam.llm.common import written
from goldseam.llm.hostrules import host_rules
from goldseam.llm.ngramjoin import one_of_each
from goldseam.llm.packing import pack
from goldseam.llm.quality import REJECT_BELOW, fit_quality
from goldseam.llm.secrets import redact
from goldseam.session import apply_settings
from goldseam.workloads.registry import table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted to ``labels``, scores at 0.3 or more."""
    apply_settings(spark)
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return model.score(docs).where(F.col("_score") >= REJECT_BELOW).select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and whose host is not rejected."""
    apply_settings(spark)
    return host_rules(docs, docs.columns).where("kept").select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of 0.8 or more connect: the smallest id."""
    apply_settings(spark)
    return one_of_each(docs).select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a label, ``n_chars`` counted anew."""
    apply_settings(spark)
    return redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, with their ids, in sequences of 1024."""
    apply_settings(spark)
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: The classifier and the tokens are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
