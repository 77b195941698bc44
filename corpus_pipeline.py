"""A corpus from raw documents: language, quality, near-duplicates, mix, packing.

Each stage takes what its predecessor kept, written as Parquet and read again, and all but the last
return the columns of documents. ``run`` chains them over the documents of a folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from evenkeel.llm.language_id import identify
from evenkeel.llm.mixing import repeat_documents
from evenkeel.llm.packing import pack
from evenkeel.llm.quality_qda import keep_good
from evenkeel.llm.queries import language_training, quality_training
from evenkeel.llm.shipping import ship_package
from evenkeel.llm.simhash import keep_one_per_component
from evenkeel.llm.words import documents
from evenkeel.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    ship_package(spark)
    return identify(docs, language_training(), keep_text=True).where("NOT rejected").select(*docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted good by a classifier learnt from the labels of those that are left."""
    ship_package(spark)
    return keep_good(docs, documents(spark, sf_dir, "labels").select("doc_id", "quality"), quality_training())


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    ship_package(spark)
    return keep_one_per_component(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for."""
    return repeat_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every word of the mix in a batch of its length bucket."""
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_stage),
    ("quality_classifier", quality_stage),
    ("simhash_near_dup", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# Language models, the discriminant and connected components aren't SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
