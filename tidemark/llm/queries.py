"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, fill_middle, language, near_copies, pieces, private, quality, repeats, secrets, token_files, top_k, vector_codes, warc
from tidemark.llm.oracles import ORACLES  # noqa: F401
from tidemark.session import scratch_dir


def tokenizer_file(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score and decision of every document."""
    return quality.report(table(spark, sf_dir, "documents"))


def op2_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 400-byte strings that occur again, and its words in passages of over 50 words that other documents hold."""
    return repeats.report(table(spark, sf_dir, "documents"), passage=repeats.PASSAGE)


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return secrets.report(table(spark, sf_dir, "documents"), words=secrets.vocabulary_words(tokenizer_file("word_bpe_49k.json")))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, written and read back through their index."""
    folder = scratch_dir(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), folder, tokenizer_file("word_bpe_49k.json"))
    return token_files.read(spark, folder).drop("ordinal")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from four fifths of them."""
    return language.report(table(spark, sf_dir, "documents"))


def op6_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and links of every document."""
    return near_copies.near_copies(table(spark, sf_dir, "documents"))


def op7_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best inner products of every hundredth vector."""
    return top_k.report(table(spark, sf_dir, "embeddings"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as web archives and read back."""
    folder = scratch_dir(spark, "warc")
    warc.write(warc.with_roles(table(spark, sf_dir, "pages")), folder)
    return warc.read(spark, folder)


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document, and whether they decode to its text."""
    return pieces.report(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of all vectors and what they lose."""
    return vector_codes.report(table(spark, sf_dir, "embeddings"))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document, and the terms that disclose it."""
    return private.report(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut for fill-in-middle training, and what comes back from it."""
    return fill_middle.report(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_quality_classifier, op2_repeated_strings, op3_secret_scans, op4_token_files, op5_language_id, op6_near_copies, op7_top_k_search, op8_decontamination, op9_warc, op10_sentencepiece, op11_vector_codes, op12_personal_data, op13_fill_in_middle)}
