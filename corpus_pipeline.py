"""The corpus pipeline: documents in, token digests of the clean ones out.

Each stage is a function of (spark, docs, sf_dir); its result is written as
Parquet into the shared work folder and read back as the next one's docs.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from martflow.llm import bpe, decontam, langid, neardup, secretscan
from martflow.llm.textcore import stored
from martflow.sources.tables import read_table

#: Predictions of a language below this posterior are rejected.
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language (operator 10); the others go."""
    own = [f"c{i}" for i in range(len(docs.columns))]  # no name of the judgement
    name, text, lang = (own[docs.columns.index(c)] for c in ("doc_id", "text", "lang"))
    judged = langid.identify(docs.toDF(*own), name, text, lang, keep=tuple(own))
    return judged.where(langid.accepted(LEAST_SCORE)).select(*own).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (operator 2): five-word
    shingles, similarity 0.8 or more, the smallest doc_id stays."""
    return neardup.deduplicate(docs, words=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item (operator 4)."""
    return decontam.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets (operator 1) replaced by a mark, n_chars
    following the text; documents without secrets stay as they are."""
    return secretscan.redact(docs, length_col="n_chars")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document its byte-level BPE digests (operator 5)."""
    return bpe.encode_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"),
                              public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("tokens", tokens),
]

#: BPE merges have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
