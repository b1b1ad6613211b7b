"""A corpus pipeline over ``documents``: each stage's result is written as parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import toxicity as toxic
from salesmart.llm.common import table
from salesmart.llm.decontaminate import decontaminate
from salesmart.llm.exact_dedup import drop_exact_copies
from salesmart.llm.near_dedup import drop_near_copies
from salesmart.llm.sentencepieces import encode_and_decode
from salesmart.session import materialize


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model rejects go. It learns from the labelled documents that are not held out."""
    model = toxic.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxic.drop_toxic(docs, model)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: sets of five-word shingles, a similarity of 0.8 or more."""
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids, and whether they decode to the text."""
    return encode_and_decode(docs.select("doc_id", "text")).select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_ids"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

#: Models and similarity estimates are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
