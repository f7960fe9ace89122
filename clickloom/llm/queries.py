"""Registered queries of the corpus operators: thin, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import quality, toxicity
from .backoff import backoff_scores
from .common import read
from .contamination import find_passages
from .exact import exact_copies
from .learning import held_out
from .lexical import search
from .lines import drop_repeated_lines
from .phrases import collocations
from .pieces import encode_and_check
from .similar import near_copies
from .simhash import simhash_classes
from .substrings import drop_repeats
from .wordpiece import token_counts


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_copies(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_repeated_lines(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = backoff_scores(read(spark, sf_dir, "documents"))
    # Sums of logarithms come in any order: what they share is given.
    return out.select("doc_id", "n_words", "n_backoff", F.round("mean_log_score", 6).alias("mean_log_score"))


def _scored(out: DataFrame, threshold: float) -> DataFrame:
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return _scored(quality.score(docs, quality.fit(docs, read(spark, sf_dir, "labels"))), 0.3)


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = encode_and_check(docs)
    return out.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", "parity", "round_trip")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_repeats(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = find_passages(docs, read(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "hit_items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(read(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return _scored(toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels"))), 0.5)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"))


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_classes(read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_exact_dedup, op3_line_dedup, op4_lm_scores, op5_quality, op6_sentencepiece, op7_suffix_dedup, op8_decontamination, op9_similar, op10_toxicity, op11_collocations, op12_search, op13_simhash)}
