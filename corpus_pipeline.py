"""Corpus pipeline: raw documents to token ids, as five stages over ``documents``.

1. quality: documents that the quality classifier rejects go.
2. line_dedup: blocks of lines that an earlier document holds go; every document stays.
3. near_dedup: one document of every class of near-duplicates stays.
4. decontamination: documents that hold a benchmark window go.
5. sentencepiece: the rest is segmented into pieces.

Every stage gets what its predecessor kept, written as Parquet in the shared folder
and read again.  All but the last return the columns of ``documents``.  Whole texts
are used throughout.

Null texts are empty texts and null ids documents of their own, as the stages' modules say;
columns of any name pass through the first four stages.  An empty table gives no rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from beatline.llm.common import code_points, table
from beatline.llm.decontamination import decontaminated
from beatline.llm.line_dedup import dedup
from beatline.llm.near_dedup import representatives
from beatline.llm.quality import keep_good
from beatline.llm.queries import tokenizer_file
from beatline.llm.sentencepiece_codec import encode
from beatline.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = dedup(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", code_points(out["text"]))
    return out.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode(docs, tokenizer_file("piece_bpe_32k.model"))


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

#: A fitted classifier, alignment and segmentation are beyond SQL; tests hold brute-force versions against the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}-{uuid.uuid4().hex}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.schema(docs.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
