"""The corpus pipeline: language ID, n-gram Jaccard join, decontamination, mixing, token files.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame
that is written as Parquet and re-read as the next one's ``docs``. All but the last return the
columns of ``documents``; the last returns doc_id, start, n_tokens, ids_crc32 of the token files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from viewtide.llm import decontam, jaccard_join, lang_id, mixing, token_files
from viewtide.llm.common import release, written
from viewtide.sources.tables import read_table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language identification rejects go."""
    release(spark)
    return lang_id.drop_rejected(spark, docs)


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    release(spark)
    return jaccard_join.one_per_group(spark, docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by the benchmark go."""
    release(spark)
    return decontam.remove_contaminated(spark, docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents appear as often as the mix takes them."""
    release(spark)
    return mixing.mixed_documents(spark, docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, read back."""
    release(spark)
    return token_files.token_output(spark, docs)


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", join_near_copies),
    ("decontaminate", remove_benchmark),
    ("mix", mix_sources),
    ("token_files", write_tokens),
]

# Language ID is a trained model and token ids come from a vocabulary: no SQL says either.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
