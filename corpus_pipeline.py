"""A training-corpus pipeline over ``documents``, in stages that each call one corpus operator.

Every stage takes all rows its predecessor kept.  The first four return the
columns of ``documents``; the last adds token ids.  Stages define the odd cases
as their operators do: a null text is an empty one and stays, unless it is a
copy; repeated rows are one document; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.common import pin, read
from clickloom.llm.contamination import drop_contaminated
from clickloom.llm.exact import drop_copies
from clickloom.llm.pieces import encode_and_check
from clickloom.llm.similar import drop_near_copies
from clickloom.llm.toxicity import drop_toxic, fit


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is 0.5 or more go."""
    return drop_toxic(docs, fit(docs, read(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with one text the one with the largest id stays."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are linked by near copies the one with the smallest id stays."""
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, compared with the reference library word by word and decoded again as a whole."""
    out = encode_and_check(docs.select("doc_id", "text"))
    return out.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", "parity", "round_trip")


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

#: No SQL for the learned scorer and the tokenizer; a test compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES):
            docs = pin(docs)
    return docs
