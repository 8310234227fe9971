"""From raw documents to packed training sequences, in five stages.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over all that
its predecessor kept. ``run`` writes every result to the shared folder and
reads it back, so a lost executor never repeats an earlier stage.

Defined results: null texts are empty; of all empty texts, as of all copies,
one document stays (the least doc_id, a null one last); repeated rows are
copies; rows without an id go on like others; texts of any length are read
whole; without labels every document is good, with an empty benchmark none is
contaminated; empty tables give no rows. Extra columns are kept by every
stage but the last, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, near_dedup, packing, quality_classifier, secrets
from tidemark.llm.common import materialize, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return quality_classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies."""
    return near_dedup.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the training sequences."""
    _, places = packing.pack_documents(docs)
    return places.select("doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
                         "doc_tokens", "sequence_id", "offset")


STAGES = [("quality_classifier", quality), ("near_dedup", near_duplicates), ("decontamination", decontamination),
          ("secret_scan", secret_scan), ("packing", pack)]

#: SQL can't express a trained classifier, signatures or a tokenizer; the
#: stages are tested against brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
