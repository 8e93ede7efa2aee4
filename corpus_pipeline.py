"""A training corpus from raw documents, in five stages over Parquet.

Every stage reads what the one before has kept, so a later stage never sees a document
that an earlier one dropped, nor a line that it deleted.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.llm import bpe, decontaminate, linededup, minhash, quality
from ratingloom.llm.common import quoted, set_aside, table, without, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later repeats of line runs; documents that this leaves empty go.

    n_chars, if the table has it, follows the text.
    """
    renamed, back = set_aside(docs, *linededup.ADDED)
    cleaned = linededup.dedup_lines(renamed).where("n_removed_lines = 0 OR text != ''")
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned.select(*back)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 0.8 of its five-word shingles."""
    return minhash.keep_one(docs, shingle=5, percent=80)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their ids, and whether the ids give back the text's bytes."""
    encoded = bpe.encode_documents(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )
    whole = F.coalesce(F.col("text"), F.lit("")).cast("binary") == F.col("decoded")
    kept = without(docs, "n_tokens", "token_ids", "round_trip")
    return encoded.select(*map(quoted, kept), "n_tokens", "token_ids", whole.alias("round_trip"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("MinHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", benchmark_stage),
    ("byte-level BPE", token_stage),
]

#: Line runs are named by hashes and BPE merges step by step; SQL expresses neither.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
