"""The corpus pipeline: quality rules, near duplicates, benchmark leaks, personal data, token ids.

Each stage takes (spark, docs, sf_dir) and returns a frame; all but the last keep the columns of `docs`, in their
order, and the rows they let pass. Null texts and texts without words fail the quality rules; a stage that is given
no rows returns none.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from reviewlake.llm import bpe, decontaminate, ngram_join, pii, quality_rules
from reviewlake.llm.common import forget_shuffles, table
from reviewlake.session import shared_folder


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the boosted trees, which learn from the labelled ones among `docs`."""
    model = quality_rules.train(docs, table(spark, sf_dir, "labels"))
    return quality_rules.keep(docs, model)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of each class of near duplicates."""
    return ngram_join.keep_one(docs)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, nor an edited copy of one."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind."""
    return pii.redacted(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded text."""
    return bpe.token_digests(docs, bpe.default_path())


STAGES = [
    ("quality rules", good_quality),
    ("n-gram jaccard join", one_of_each),
    ("benchmark decontamination", without_leaks),
    ("personal data", without_personal_data),
    ("byte-pair encoding", token_ids),
]

#: Trained trees, exact set joins and merges are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read back by the next."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        result = stage(spark, docs, sf_dir)
        result.write.parquet(f"{folder}/{number}")
        docs = spark.read.schema(result.schema).parquet(f"{folder}/{number}")
        del result
        forget_shuffles(spark)
    return docs
