"""The registered queries of the operators: name -> (spark, sf_dir) -> DataFrame.

Each applies its operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.llm import (ann, bpe, counts, decontam, idfile, langid, licences, lm, neardup,
                          ranked, secretscan, spelling, toxicity)
from martflow.sources.tables import read_table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER_IDS = 50257

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.secret_report(read_table(spark, sf_dir, "documents"))


@query
def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read_table(spark, sf_dir, "documents"), words=2, percent=80)


@query
def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(read_table(spark, sf_dir, "documents"), least=2)


@query
def op4_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(read_table(spark, sf_dir, "documents"),
                                  read_table(spark, sf_dir, "benchmark"))


@query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(read_table(spark, sf_dir, "documents"), RANKS,
                              public_tokenizers.PATTERN)


@query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idfile.read_ids(idfile.write_ids(read_table(spark, sf_dir, "documents"), TOKENIZER,
                                            TOKENIZER_IDS, end_id=2, added_tokens=True))


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.counted_edits(read_table(spark, sf_dir, "documents"), RANKS,
                                public_tokenizers.PATTERN, edits=counts.tidy_edits)


@query
def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read_table(spark, sf_dir, "embeddings"), every=20, k=20)


@query
def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.license_scan(read_table(spark, sf_dir, "documents"))


@query
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read_table(spark, sf_dir, "documents"))


@query
def op11_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(read_table(spark, sf_dir, "documents"), least_letters=5,
                                    least_count=3, spoil=97, ratio=2)


@query
def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    spans = F.transform("spans", lambda x: F.concat_ws(":", x["start"], x["end"]))
    return scored.select("doc_id", "held_out", "score", "predicted", F.array_join(spans, ",").alias("spans"))


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(read_table(spark, sf_dir, "documents"),
                         read_table(spark, sf_dir, "benchmark"), k=10)
