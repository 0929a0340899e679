"""Registered queries of the text operators, one per operator, over whole tables."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from beatline.llm import conversations, decontamination, lexical_search
from beatline.llm.common import table
from beatline.session import scratch_path

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {"op3_decontamination": decontamination.ORACLE, "op11_conversation_repair": conversations.ORACLE,
                           "op13_lexical_search": lexical_search.ORACLE}

#: Vocabulary files; the folder is a parameter of the installation.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")


def tokenizer_file(name: str) -> str:
    return f"{TOKENIZERS}/{name}"


def query(fn: Run) -> Run:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    from beatline.llm.toxicity import scored_documents
    return scored_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    from beatline.llm.quality import scored_documents
    return scored_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside occurrences of benchmark windows."""
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from beatline.llm.html_text import extract
    return extract(table(spark, sf_dir, "pages"))


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the blocks of lines that an earlier one holds."""
    from beatline.llm.line_dedup import dedup
    return dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), count="n_removed")


@query
def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    from beatline.llm.secrets import digest
    return digest(table(spark, sf_dir, "documents"))


@query
def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near-duplicates of every document."""
    from beatline.llm.near_dedup import classes
    return classes(table(spark, sf_dir, "documents"))


@query
def op8_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    from beatline.llm.spotsigs import digest
    return digest(table(spark, sf_dir, "documents"))


@query
def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document written as directly addressable codes and read back."""
    import public_tokenizers

    from beatline.llm.token_store import read_token_files, write_token_files
    out = scratch_path(spark, f"op9-{uuid.uuid4().hex}")
    write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), out)
    return read_token_files(spark, out)


@query
def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two best segmentations of every document: size, digest and score of both, exact round trip of the best."""
    from beatline.llm.sentencepiece_codec import digest
    return digest(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired text of every damaged conversation."""
    return conversations.digest(conversations.damaged(table(spark, sf_dir, "conversations")))


@query
def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    import public_tokenizers

    from beatline.llm.token_counts import token_counts
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents of the highest score for every benchmark item."""
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
