"""The registered queries of this subpackage, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brinework.llm import (
    bpe,
    embedding_dedup,
    html_extraction,
    language_id,
    license_scan,
    orchard_clustering,
    packing,
    personal_data,
    quality_rules,
    sharding,
    simhash,
    spelling_variants,
    url_filters,
)
from brinework.llm.common import table
from brinework.llm.sql import ORACLE_SQL  # noqa: F401


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.judge(docs, quality_rules.train(docs, table(spark, sf_dir, "labels")))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(table(spark, sf_dir, "pages"))


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(page_id, good): the quality label of the document whose number is the first number of the url's path."""
    number = F.try_to_number(F.regexp_extract("url", r"://[^/?#]*/[^?#0-9]*(\d{1,18})", 1), F.lit("9" * 18)).cast("bigint")
    return pages.select("page_id", number.alias("doc_id")).join(labels.select("doc_id", "quality"), "doc_id").select(
        "page_id", F.col("quality").alias("good")
    )


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filters.judge(pages, page_outcomes(pages, table(spark, sf_dir, "labels"))).drop("rate", "upper")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.train(docs))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.find(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.group_variants(table(spark, sf_dir, "documents"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orchard_clustering.cluster(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_sharding,
        op3_html_extraction,
        op4_simhash_dedup,
        op5_best_fit_packing,
        op6_url_filters,
        op7_license_scan,
        op8_embedding_dedup,
        op9_language_id,
        op10_bpe,
        op11_personal_data,
        op12_spelling_variants,
        op13_centroid_clustering,
    )
}
