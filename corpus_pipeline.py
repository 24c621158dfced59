"""The corpus pipeline: stages over ``documents``, each calling one operator of ``subledger.llm``.

A stage takes (spark, docs, sf_dir) and returns the rows it keeps with the
columns of documents; the last returns its operator's result. Side tables
(labels, benchmark) are read from ``sf_dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.llm import bpe, decontaminate, nbsvm, quality_rules, simhash
from subledger.llm.common import checkpointed, table


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no base rule and no admitted cutoff of their language."""
    return quality_rules.keep(docs, table(spark, sf_dir, "labels"))


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be good by a model learned from labels outside the held-out fold."""
    labels = table(spark, sf_dir, "labels").where(~nbsvm.held_out(F.col("doc_id")))
    return nbsvm.keep(docs, nbsvm.fit(docs, labels))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: that with the smallest doc_id."""
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is verified."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of the kept documents, as digests, decoded again."""
    import public_tokenizers

    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_rules_stage),
    ("quality classifier", quality_classifier_stage),
    ("simhash near-dedup", near_duplicates_stage),
    ("benchmark decontamination", decontamination_stage),
    ("byte-level bpe", bpe_stage),
]

#: No SQL states the stages that are trained, linked or encoded; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; a checkpoint after each but the last cuts the lineage."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = checkpointed(docs)
    return docs
