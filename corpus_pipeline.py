"""A corpus pipeline of four stages over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read
again as the next stage's documents. All but the last return the columns of documents. Null and
empty texts fail the quality rules, so they end there; repeated rows are judged each and leave one
row after the third stage; extra columns pass through the first three stages whatever their names;
an empty table gives an empty result. The stages' tables stay in the shared folder, where a rerun
of lost tasks finds them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from brinework.llm import language_id, packing, quality_rules, simhash
from brinework.llm.common import shared_folder, table
from brinework.llm.queries import tokenizer_path

#: Of the way from an even split between the learned languages (0) to one language alone (1): a document in one of them is well beyond.
MIN_LANGUAGE_LEAD = 1 / 15
#: Near copies: texts whose sets of five-word shingles have this Jaccard index or more.
SHINGLE, SIMILARITY = 5, 0.8


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the base rules and the trees keep; without two outcomes among the labels the base rules alone."""
    model = quality_rules.train(docs, table(spark, sf_dir, "labels"))
    return quality_rules.keep_good(docs, model)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in a language learned from those that are left; texts without letters go."""
    return language_id.keep_known(docs, language_id.train(docs), MIN_LANGUAGE_LEAD)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near copies."""
    return simhash.keep_one(docs, shingle=SHINGLE, similarity=SIMILARITY)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and offset; repeated ids are packed each."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [("quality rules", quality), ("language ID", language), ("SimHash near-dedup", near_dedup), ("best-fit packing", packed)]
#: No stage of the four is SQL: boosted trees, a trained filter, Hamming links and a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
