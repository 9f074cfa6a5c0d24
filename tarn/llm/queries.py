"""The package's queries, each over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import oracles
from .common import Scratch, table
from .jaccard import near_components
from .media import media_columns
from .quality import quality
from .secrets import scan_secrets
from .substrings import dedup_digests
from .tokens import byte_encode, pack, token_counts
from .toxicity import score_documents
from .warc import page_records, read_warc, write_warc

WORD_BPE, BYTE_BPE, END = "word_bpe_49k.json", "byte_bpe_multi_50k.tiktoken", 2


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(table(spark, sf_dir, "documents"), Scratch(spark, "jaccard")).drop("class_id")


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_digests(table(spark, sf_dir, "documents"), Scratch(spark, "substrings"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_encode(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "warc")
    return page_records(read_warc(write_warc(table(spark, sf_dir, "pages"), scratch), payloads=False))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), END, Scratch(spark, "packing"))


def op9_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_columns(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), Scratch(spark, "quality")).drop("n_words_left")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_jaccard": op1_ngram_jaccard,
        "op2_substrings": op2_substrings,
        "op3_token_counts": op3_token_counts,
        "op4_byte_bpe": op4_byte_bpe,
        "op5_warc": op5_warc,
        "op6_toxicity": op6_toxicity,
        "op7_secrets": op7_secrets,
        "op8_packing": op8_packing,
        "op9_media": op9_media,
        "op10_quality": op10_quality,
    }


def oracle_sql() -> dict[str, str]:
    """Texts' tokens, images, scores and entropy spans are beyond SQL; tests hold those queries against brute force."""
    return {"op1_ngram_jaccard": oracles.JACCARD, "op2_substrings": oracles.SUBSTRINGS, "op5_warc": oracles.WARC, "op10_quality": oracles.QUALITY}
