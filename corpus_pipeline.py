"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept; all but the
last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spindlework.llm import chunks, contamination, language, packing, simhash
from spindlework.llm.common import fold, read, store
from spindlework.plans.workspace import ship_package


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of some language.  Those without a letter (null and empty text too) and
    longer ones that resemble no learned language go; ``lang`` is left as it is."""
    ship_package(spark)
    taught = docs.filter(fold("doc_id", 3) != 1)
    names, prototypes = language.train(taught)
    least = language.floors(taught, names, prototypes)
    return language.like_some(docs, names, prototypes, least)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates (fingerprints of four-word shingles that differ in
    four bits or fewer) the document with the smallest id."""
    ship_package(spark)
    return simhash.one_of_each(docs, limit=4, size=4)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that occurred before; no document goes."""
    ship_package(spark)
    return chunks.drop_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    ship_package(spark)
    return contamination.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequences and places in them."""
    ship_package(spark)
    return packing.packed(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# language profiles, fingerprints and a tokenizer have no SQL form; see tests/llm
ORACLE_SQL = None
