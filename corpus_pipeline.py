"""A training corpus from raw documents: filter, deduplicate, pack."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bizregistry.llm.common import read_table, shared_folder, written
from bizregistry.llm.lines import dedup_lines
from bizregistry.llm.packing import pack_documents
from bizregistry.llm.quality import score_quality
from bizregistry.llm.simhash import drop_near_duplicates
from bizregistry.llm.substring import dedup_substrings


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    scored = score_quality(docs, read_table(spark, sf_dir, "labels"))
    return scored.filter("predicted = 1").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them."""
    return _counted(dedup_lines(docs).select(*docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays whose fingerprints differ in four bits or less."""
    return drop_near_duplicates(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur more than once go."""
    return _counted(dedup_substrings(docs).select(*docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents in sequences of 1024 tokens, with the tokens."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("substring_dedup", substrings),
    ("best_fit_packing", packing),
]

# SQL can express neither a trained classifier nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each reads what the one before has written."""
    docs, folder = read_table(spark, sf_dir, "documents"), shared_folder(spark)
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), folder)
    return STAGES[-1][1](spark, docs, sf_dir)


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars``, where there is such a column, counts the text that is left."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.char_length("text").cast(kind))
