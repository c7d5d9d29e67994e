"""The registered queries of the thirteen operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindlework.llm import (
    bitsliced,
    chunks,
    contamination,
    disclosure,
    hmm,
    language,
    lexical,
    packing,
    shallot,
    simhash,
    suffixes,
    token_counts,
    toxicity,
)
from spindlework.llm.common import read
from spindlework.plans.workspace import ship_package


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return read(spark, sf_dir, "documents")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.repeats(_documents(spark, sf_dir))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return bitsliced.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_documents(spark, sf_dir))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf_dir))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels")
    return toxicity.toxicity(_documents(spark, sf_dir), labels).drop("passages")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = read(spark, sf_dir, "benchmark")
    return contamination.contamination(_documents(spark, sf_dir), benchmark).drop("hits")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.language_scores(_documents(spark, sf_dir))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_documents(spark, sf_dir))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_bytes(_documents(spark, sf_dir)).drop("spans")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_ids(_documents(spark, sf_dir))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return shallot.cluster(read(spark, sf_dir, "embeddings"))[0]


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disclosure.personal_data(_documents(spark, sf_dir), near=None)


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.lexical_search(_documents(spark, sf_dir), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1,
    "op2_topk_search": op2,
    "op3_token_counts": op3,
    "op4_simhash_near_dedup": op4,
    "op5_toxicity": op5,
    "op6_decontamination": op6,
    "op7_hmm_scores": op7,
    "op8_best_fit_packing": op8,
    "op9_suffix_dedup": op9,
    "op10_language_id": op10,
    "op11_shallot_clustering": op11,
    "op12_pii_disclosure": op12,
    "op13_lexical_search": op13,
}

ORACLE = {
    "op2_topk_search": bitsliced.ORACLE,
    "op6_decontamination": contamination.ORACLE,
    "op11_shallot_clustering": shallot.ORACLE,
    "op13_lexical_search": lexical.ORACLE,
}
