"""The corpus pipeline: five stages over ``documents``, each one of the library's operators.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from triplex.llm import exact_dedup, language_id, ownership, packing, simhash
from triplex.llm.common import Scratch, materialise
from triplex.llm.queries import byte_bpe, byte_bpe_added


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the model knows; those without a letter go."""
    return language_id.keep_known(docs, language_id.fit(docs.where(~language_id.held_out())))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (shingles of three words, three bits)."""
    return simhash.drop_near_copies(docs, shingle=3, bits=3)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with owner-specific secrets blanked out of their texts."""
    return ownership.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, with their ids."""
    return packing.pack(docs, packing.text_ids(*byte_bpe(), added=byte_bpe_added()))


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("secret_scans", secrets),
    ("packing", packed),
]

#: SQL cannot express the stages with a learned model, SimHash or byte-pair
#: encoding; ``tests/llm/test_pipeline.py`` compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents``; of the tables written on the way only the last one stays."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    with Scratch(spark) as scratch:
        for name, stage in STAGES:
            docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
            scratch.remove()
    return docs
