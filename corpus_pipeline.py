"""The corpus pipeline: toxic documents go, then exact copies, then near copies; what is left is
mixed to the sources' target weights and encoded. Every stage reads all that the stage before it
kept, as a Parquet table in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import exact_dedup, mixing, near_dedup, pieces, toxicity
from textloom.llm.shared import documents, remainder, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels.where(remainder("doc_id", 5) != 0))
    return toxicity.reject(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text: the one with the largest identifier."""
    return exact_dedup.deduplicate(docs, keep="max")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of 0.8 on five-word shingles join."""
    return near_dedup.near_deduplicate(docs, words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix's documents as piece identifiers; decoding them was tried for each."""
    encoded = pieces.encode(docs)
    return encoded.select(F.col("id").alias("doc_id"), "n_pieces", "round_trip", F.col("ids").alias("piece_ids"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("minhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: The toxicity stage's model is not a statement; tests hold every stage against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
