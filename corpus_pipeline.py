"""From raw documents to piece ids: quality, near copies, benchmark leaks, secrets, SentencePiece."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, near_copies, pieces, quality, secrets
from tidemark.llm.files import settled
from tidemark.llm.queries import table, tokenizer_file


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return quality.good(docs)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of copies and near copies."""
    return near_copies.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark windows."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked."""
    return secrets.redact(docs, words=secrets.vocabulary_words(tokenizer_file("word_bpe_49k.json")))


def piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document."""
    return pieces.encode(docs.select("doc_id", "lang", "source", "text"), tokenizer_file("piece_bpe_32k.model")).drop("text")


STAGES = [
    ("quality classifier", quality_stage), ("near copies", near_copy_stage), ("decontamination", decontamination_stage), ("secrets", secret_stage), ("pieces", piece_stage)]

#: A trained classifier has no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
