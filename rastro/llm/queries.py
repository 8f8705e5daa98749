"""The queries of the text-corpus problems (p2, p4, p7, p8, p9) over their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastro.llm.listings import group_listings, same_product_pairs
from rastro.llm.lookalikes import canonical_texts, same_looking_pairs
from rastro.llm.packing import fill_report, pack
from rastro.llm.reading import reading_levels
from rastro.llm.tokenize import encode_corpus
from rastro.session import cut, read


def _raw_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = read(spark, sf_dir, "saved_cases").select(F.lit("title_es_raw").alias("field_name"), F.col("case_id").alias("record_id"), F.col("title_es_raw").alias("text"))
    described = read(spark, sf_dir, "capacity_context").select(F.lit("product_description_raw").alias("field_name"), F.col("context_id").alias("record_id"), F.col("product_description_raw").alias("text"))
    return titles.unionAll(described)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of records of one field whose stored texts differ but look the same."""
    return same_looking_pairs(_raw_texts(spark, sf_dir))


def p2_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text in its consistent form."""
    return canonical_texts(_raw_texts(spark, sf_dir))


def p4_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product group of every listing."""
    return group_listings(read(spark, sf_dir, "product_details"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of different listings of the same product."""
    return same_product_pairs(cut(p4_groups(spark, sf_dir)))


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return encode_corpus(read(spark, sf_dir, "documents"))


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container of every document, per container kind."""
    lengths = cut(encode_corpus(read(spark, sf_dir, "documents"), lengths=True))
    return pack(lengths, read(spark, sf_dir, "container_sizes"))


def p8_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the containers of each kind are."""
    return fill_report(p8_containers(spark, sf_dir))


def p9_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimated reading level of every document."""
    return reading_levels(read(spark, sf_dir, "documents"), read(spark, sf_dir, "reading_labels"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written at level 4 or 5."""
    return p9_levels(spark, sf_dir).filter("demanding").select("doc_id")


def queries() -> dict:
    return {f.__name__: f for f in (p2_found, p2_canonical, p4_found, p4_groups, p7_ids, p8_containers, p8_report, p9_found, p9_levels)}


def oracles() -> dict[str, str]:
    return {}
