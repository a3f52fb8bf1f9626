"""The training-text pipeline: five stages, each over all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aerolag.llm import stages
from aerolag.storage import stage

#: (name, function); a function takes (spark, docs, sf_dir). All but the last return the columns of documents.
STAGES = [
    ("language", stages.language),
    ("near_duplicates", stages.near_duplicates),
    ("decontamination", stages.decontamination),
    ("personal_data", stages.personal_data),
    ("packing", stages.packing),
]

#: The language model cannot be written in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents that every stage kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
