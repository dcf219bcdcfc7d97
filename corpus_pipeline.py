"""Corpus preparation: the stages of the training-data pipeline in their order.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows the stage
before it kept; ``run`` writes every stage's result as Parquet in the shared
checkpoint folder and reads it back as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loanlens.llm.common import read, shared_table
from loanlens.llm.decontaminate import drop_contaminated
from loanlens.llm.language_id import drop_unidentified
from loanlens.llm.line_dedup import drop_boilerplate
from loanlens.llm.mixing import mix
from loanlens.llm.simhash import drop_near_duplicates


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; those the models reject go."""
    return drop_unidentified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the boilerplate lines of their source."""
    return drop_boilerplate(docs).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return drop_near_duplicates(docs, shingle=3, max_distance=2)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words the final mix takes from each remaining document."""
    return mix(docs)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontaminate", decontaminate), ("mix", mix_sources)]

#: Language models and fingerprints have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
