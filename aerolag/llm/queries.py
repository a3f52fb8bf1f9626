"""One query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from aerolag.llm.caps import near_duplicate_vectors
from aerolag.llm.decontamination import contamination
from aerolag.llm.fingerprints import document_fingerprints
from aerolag.llm.html import main_texts
from aerolag.llm.jaccard import near_duplicates
from aerolag.llm.language import identify_documents
from aerolag.llm.manifest import document_manifest
from aerolag.llm.packing import pack_documents
from aerolag.llm.pii import personal_data
from aerolag.llm.ranking import ranked_search
from aerolag.llm.repeats import remove_repeats
from aerolag.llm.tables import table
from aerolag.llm.token_files import token_file_round_trip
from aerolag.llm.warc import archive_round_trip


WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), WORD_TOKENIZER)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_round_trip(table(spark, sf_dir, "documents"), BYTE_TOKENIZER)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_documents(table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(table(spark, sf_dir, "pages"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))


def op11_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_manifest(table(spark, sf_dir, "documents"))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_fingerprints(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_embeddings": op1_embeddings,
        "op2_jaccard": op2_jaccard,
        "op3_decontamination": op3_decontamination,
        "op4_repeats": op4_repeats,
        "op5_personal_data": op5_personal_data,
        "op6_packing": op6_packing,
        "op7_token_files": op7_token_files,
        "op8_language": op8_language,
        "op9_warc": op9_warc,
        "op10_html": op10_html,
        "op11_ranking": op11_ranking,
        "op12_manifest": op12_manifest,
        "op13_fingerprints": op13_fingerprints,
    }
