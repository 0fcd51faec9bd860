"""A training corpus from documents: toxic ones go, then exact and near copies, then benchmark leaks; the rest is encoded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from netloom.llm import decontamination, exact_dedup, ngram_join, sentencepiece_codec, toxicity
from netloom.storage import discard, materialize


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain, trained on the labelled ones among ``docs``, does not call toxic."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def remove_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with the same text, the one with the smallest doc_id."""
    return exact_dedup.drop_duplicates(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that share 0.8 or more of their five-word shingles, the one with the smallest doc_id."""
    return ngram_join.drop_similar(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item occurs, reworded in its slots or not."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_pieces and whether decoding gives the text back."""
    return sentencepiece_codec.encode_with_check(docs)


STAGES = [
    ("toxicity", remove_toxic),
    ("exact dedup", remove_exact_copies),
    ("n-gram Jaccard join", remove_near_copies),
    ("benchmark decontamination", remove_benchmark),
    ("SentencePiece encoding", encode),
]

#: SQL cannot express the trained chain or the piece lattice; tests hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if number:
            discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
