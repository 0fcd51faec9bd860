"""Helpers shared by the training-data operators."""

from __future__ import annotations

import math
import os

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netloom.storage import discard, drop_scratch, materialize, scratch

__all__ = ["BROADCAST_BYTES", "TEXT_ROWS", "Bitmap", "bounded_broadcast", "discard", "drop_scratch", "fresh", "local_files", "materialize", "scratch", "texts_of", "worker_cache"]

#: Data that is broadcast is counted first and must stay below this size.
BROADCAST_BYTES = 32 << 20

def bounded_broadcast(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast if the counted rows fit the bound, else leave the join to a shuffle."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


class Bitmap:
    """Bits of a set of 64-bit hashes, to leave out early what a join would not match.

    Its size grows with the set up to ``MOST_BITS``; a fuller one lets more pass.
    """

    #: Bits a hash, and most bits of all (16 MB).
    EACH, MOST = 1024, 1 << 27

    def __init__(self, hashes: DataFrame, column: str):
        """The bits reach the driver as at most ``MOST`` / 64 words, whatever the number of hashes."""
        self.shift = 64 - min(self.MOST.bit_length() - 1, max(16, math.ceil(math.log2(1 + self.EACH * hashes.count()))))
        at = F.expr(f"shiftrightunsigned({column}, {self.shift})")
        words = hashes.groupBy(F.shiftright(at, 6).cast("int").alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned({column}, {self.shift}) & 63 AS INT))")).alias("bits")).toArrow()
        bits = np.zeros(1 << (64 - self.shift - 6), np.int64)
        bits[np.asarray(words.column("word"))] = np.asarray(words.column("bits"))
        self.bits = bits.view(np.uint8)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        """Positions of the hashes that are probably in the set."""
        at = (hashes.view(np.uint64) >> np.uint64(self.shift)).astype(np.int64)
        return np.flatnonzero((self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1)


def fresh(name: str, *frames: DataFrame) -> str:
    """``name``, lengthened until no column of ``frames`` has it."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name in taken:
        name += "_"
    return name


#: Rows that pass to Python at a time where rows hold whole texts.
TEXT_ROWS = 2000


def texts_of(df: DataFrame) -> DataFrame:
    """``df``, with the session set to pass rows to Python in batches small enough for whole texts.

    A batch stands several times in memory (Arrow, Python objects, results),
    and two tasks of an executor have one each.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= TEXT_ROWS:
        conf.set(name, str(TEXT_ROWS))
    return df


_CACHE: dict = {}


def worker_cache(key, build):
    """What a Python worker keeps from task to task: one thing at a time.

    A worker serves one operator after another.  Asking for another key drops
    what the worker held before, so tables of past operators don't add up.
    """
    if key not in _CACHE:
        _CACHE.clear()
        _CACHE[key] = build()
    return _CACHE[key]


def local_files() -> str:
    """The folder of the public tokenizer files; NETLOOM_TOKENIZERS overrides it."""
    named = os.environ.get("NETLOOM_TOKENIZERS")
    if named:
        return named
    import public_tokenizers

    return os.path.dirname(public_tokenizers.path("word_bpe_49k.json"))
