"""The operators as stages of the corpus pipeline: each takes (spark, docs, sf_dir) and keeps the columns of docs."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolag.llm import decontamination as leaks
from aerolag.llm import jaccard, pii
from aerolag.llm.language import held_out, identify, learn_prototypes
from aerolag.llm.packing import pack_documents
from aerolag.llm.tables import small_side, table
from aerolag.storage import stage


def _packed(docs: DataFrame) -> DataFrame:
    """text, and all columns under one name that clashes with none an operator adds."""
    return docs.select(F.struct(*docs.columns).alias("_row"), F.col("text"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a text of some language; those with none (null, empty, or no letter) go.

    Where no document has a label there is nothing to tell languages by, and those with a letter stay as well.
    """
    prototypes = learn_prototypes(docs.filter(~held_out()))
    return identify(_packed(docs), prototypes, ["_row"]).filter("has_letters").select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id, one without an id only
    where all are; of several rows with that id one.

    A document without shingles is a group of its own.
    """
    # Written down, so that a row has the same key whenever it is read.
    row_key = F.monotonically_increasing_id().alias("row_key")
    keyed = stage(docs.select(F.struct(*docs.columns).alias("_row"), row_key), "keyed")
    gone = stage(jaccard.superfluous(keyed.select("row_key", "_row.doc_id", "_row.text")), "gone")
    return keyed.join(small_side(gone), "row_key", "left_anti").select("_row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of the benchmark."""
    found = leaks.find_benchmark(_packed(docs), table(spark, sf_dir, "benchmark"), ["_row"])
    return found.filter(F.size("spans") == 0).select("_row.*")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every span of personal data replaced by its kind; n_chars follows the text."""
    found = pii.redact(docs, pii.fit_on(docs))
    return found.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else found


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and the sequences they are packed into."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
