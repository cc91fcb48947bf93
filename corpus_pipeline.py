"""From documents to packed sequences: language, repetition, near-duplicates, packing, in four stages.

Each stage works on all rows that the one before kept. What a stage returns is written as Parquet to the shared folder
and read back as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm import language, packing, repetition, simhash
from landfall.llm.queries import remainder
from landfall.session import work_path

# Near-duplicates are linked where the fingerprints of their shingles of WORDS words differ in RADIUS or fewer bits.
WORDS, RADIUS = 4, 4


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined. Prototypes, and the cosine that a text of some length must reach, are
    learned from ``docs`` outside the held-out fold."""
    fold = docs.where(F.coalesce(remainder(3) != 1, F.lit(False)))
    model = language.learn(fold)
    return language.keep_identified(docs, model, language.learn_levels(fold, model))


def unrepetitive(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repetition.keep_unrepetitive(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row, with the smallest doc_id, or without one if no row has one."""
    return simhash.keep_one_of_each(docs, WORDS, RADIUS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("language", identified), ("repetition", unrepetitive), ("near_duplicates", one_of_each), ("packing", packed)]

# Learned prototypes, suffix arrays, components and a packing plan are beyond SQL; a brute-force run is the test.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents in ``sf_dir``; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
