"""The corpus pipeline: five stages over `documents`, each written as Parquet and read again.

Every stage works on all rows its predecessor kept. All but the last return the columns of the
documents, whatever they are; columns with clashing names and extra columns go through unchanged.
Null and empty texts: the language stage rejects them, so later stages see them only if run alone.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohorta.llm.bytepairs import encode
from cohorta.llm.common import Scratch, held_out, load, ready
from cohorta.llm.contamination import remove_contaminated
from cohorta.llm.language import fit, keep_known_languages
from cohorta.llm.lines import EVERY_LINE, drop_repeated_lines
from cohorta.llm.near_copies import keep_one_of_each

RANKS = "byte_bpe_50k.tiktoken"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language, learned from the labelled documents that are not held out."""
    ready(spark)
    return keep_known_languages(docs, fit(docs.where(~held_out("doc_id", 3))))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier one, equal or up to edits that grow with the length.

    Lines without a word, under 20 characters, stay; documents that are left empty go. `n_chars`, if the documents have it, counts the characters that are left.
    """
    kept = drop_repeated_lines(docs, law=EVERY_LINE)
    if "n_chars" not in docs.columns:
        return kept
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one with the smallest id."""
    ready(spark)
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages make up a twentieth or more go; the others stay as they are."""
    return remove_contaminated(docs, load(spark, sf_dir, "benchmark", "item_id", "text"))


def byte_pairs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' ids, token ids, and whether these decode to the text again."""
    ready(spark)
    encoded = encode(docs.select("doc_id", "text"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return encoded.select(
        "doc_id",
        F.col("ids").alias("token_ids"),
        F.size("ids").cast("long").alias("n_tokens"),
        (F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).alias("round_trip"),
    )


STAGES = [
    ("language", language),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("byte pairs", byte_pairs),
]
#: Kernel scores and byte pair merges have no SQL form here; tests/llm compares each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents table."""
    scratch = Scratch(spark, "pipeline")
    docs = load(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"stage{number}")
    return docs
