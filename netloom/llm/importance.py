"""Importance resampling with hashed n-gram models.

A text is a bag of hashed token unigrams and bigrams.  Two models give the
probability of each hash bucket: one counted over the target documents, one
over all documents.  The log ratio of the models, summed over a text, is its
log importance.  Gumbel noise is added and the k largest sums are taken, which
draws k documents without replacement in proportion to their importance.

Both models count all their documents.  The k-th largest key is found by
counting key prefixes, 16 bits a pass, so nothing is sorted in one place.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netloom.llm.common import bounded_broadcast, materialize, texts_of, worker_cache

BUCKET_BITS = 14
TOKENS = re.compile(r"\w+|[^\w\s]+")
#: Characters of text counted at a time.
BLOCK_CHARS = 2_000_000


class _TokenHash(dict):
    def __missing__(self, token: str) -> int:
        value = self[token] = xxhash.xxh64_intdigest(token)
        return value


class Bags:
    """Buckets of the unigrams and bigrams of texts."""

    def __init__(self, bits: int = BUCKET_BITS):
        self.shift, self.known = np.uint64(64 - bits), _TokenHash()

    def buckets(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of all texts, and for each bucket the index of its text."""
        if len(self.known) > 500_000:
            self.known.clear()
        split = [TOKENS.findall((t or "").lower()) for t in texts]
        count = np.array([len(s) for s in split], np.int64)
        h = np.fromiter((self.known[w] for s in split for w in s), np.uint64, int(count.sum()))
        owner = np.repeat(np.arange(len(texts)), count)
        pair = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[1:] + np.uint64(0x632BE59BD9B4E019))
        pair *= np.uint64(0xBF58476D1CE4E5B9)
        inside = owner[1:] == owner[:-1]
        return np.concatenate([h >> self.shift, pair[inside] >> self.shift]).astype(np.int64), np.concatenate([owner, owner[1:][inside]])

    def blocks(self, texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        first, chars = 0, 0
        for k, t in enumerate(texts):
            chars += len(t or "") + 1
            if chars >= BLOCK_CHARS or k + 1 == len(texts):
                yield first, k + 1, *self.buckets(texts[first : k + 1])
                first, chars = k + 1, 0


def bucket_counts(docs: DataFrame, is_target: Column, text_col: str = "text", bits: int = BUCKET_BITS) -> DataFrame:
    """bucket, raw, target: how often each bucket occurs in all documents and in the target ones."""

    def run(batches):
        bags = worker_cache(("bags", bits), lambda: Bags(bits))
        raw, target = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
        for batch in batches:
            chosen = np.array(batch.column(1).to_pylist(), bool)
            for first, last, bucket, owner in bags.blocks(batch.column(0).to_pylist()):
                raw += np.bincount(bucket, minlength=1 << bits)
                target += np.bincount(bucket[chosen[first:last][owner]], minlength=1 << bits)
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(raw[at]), pa.array(target[at])], ["bucket", "raw", "target"])

    counted = texts_of(docs).select(F.col(text_col).alias("text"), F.coalesce(is_target, F.lit(False)).alias("chosen")).mapInArrow(run, "bucket int, raw long, target long")
    return counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame, bits: int = BUCKET_BITS) -> np.ndarray:
    """log p_target - log p_raw of each bucket, one added to every count; the table has 2**bits rows."""
    raw, target = np.ones(1 << bits), np.ones(1 << bits)
    for r in counts.collect():
        raw[r["bucket"]] += r["raw"]
        target[r["bucket"]] += r["target"]
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def gumbel(doc_id: int | None, text: str | None, seed: int) -> float:
    """Gumbel noise that the id, the text and the seed fix."""
    u = (xxhash.xxh64_intdigest(f"{doc_id}\0{text or ''}", seed) + 0.5) / 2.0**64
    return -math.log(-math.log(u)) if u < 1 else 40.0


def keyed(docs: DataFrame, ratio: np.ndarray, seed: int, id_col: str = "doc_id", text_col: str = "text", bits: int = BUCKET_BITS) -> DataFrame:
    """doc_id, n_grams, log_weight, key of each document."""

    def run(batches):
        bags = worker_cache(("bags", bits), lambda: Bags(bits))
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, last, bucket, owner in bags.blocks(texts):
                n = np.bincount(owner, minlength=last - first)
                weight = np.bincount(owner, ratio[bucket], last - first).astype(float)
                noise = [gumbel(i, t, seed) for i, t in zip(ids[first:last], texts[first:last])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(n), pa.array(weight), pa.array(weight + np.array(noise))], ["doc_id", "n_grams", "log_weight", "key"])

    return texts_of(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, n_grams long, log_weight double, key double")


def with_order(rows: DataFrame) -> DataFrame:
    """Adds ``rank_bits``: a long that orders like ``key``; 20 binary digits after the point count."""
    return rows.withColumn("rank_bits", F.round(F.col("key") * (1 << 20)).cast("long") + F.lit(1 << 62))


def kth_largest(rows: DataFrame, k: int, column: str = "rank_bits") -> int | None:
    """The k-th largest value of a column of non-negative longs (None if there are fewer): four passes that count 16 bits each."""
    prefix = None
    for shift in (48, 32, 16, 0):
        part = rows if prefix is None else rows.where(F.shiftright(column, shift + 16) == prefix)
        counts = part.groupBy((F.shiftright(column, shift)).alias("p")).count().collect()  # at most 65,536 rows
        for r in sorted(counts, key=lambda r: -r["p"]):
            if r["count"] >= k:
                prefix = r["p"]
                break
            k -= r["count"]
        else:
            return None
    return prefix


def resample(docs: DataFrame, is_target: Column, fraction: float, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", bits: int = BUCKET_BITS) -> DataFrame:
    """One row per document: doc_id, n_grams, log_weight, key, selected.

    ``selected`` marks the ``ceil(fraction * rows)`` rows of largest key; rows
    that tie with the last of them are selected too (equal rows tie).  Texts
    that are null or have no token weigh as an average text (log weight 0).
    Without target rows all weights follow from the added counts alone.  An
    empty table gives no rows; other columns of ``docs`` are ignored.
    """
    ratio = log_ratios(bucket_counts(docs, is_target, text_col, bits), bits)
    rows = materialize(with_order(keyed(docs, ratio, seed, id_col, text_col, bits)), "importance")
    k = math.ceil(fraction * rows.count())
    last = kth_largest(rows, k) if k else None
    chosen = F.lit(False) if k == 0 else F.lit(True) if last is None else F.col("rank_bits") >= F.lit(last)
    return rows.select("doc_id", "n_grams", "log_weight", "key", chosen.alias("selected"))


#: The share of documents that the query draws.
FRACTION = 0.85


def op3_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").select(F.col("doc_id").alias("good")).distinct()
    marked = docs.join(bounded_broadcast(good, 24), docs.doc_id == F.col("good"), "left")
    return resample(marked, F.col("good").isNotNull(), FRACTION, seed=1)
