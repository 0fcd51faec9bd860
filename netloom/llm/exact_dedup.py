"""Exact deduplication with a log-structured merge index over text digests.

Each batch of documents is inserted; a table is dealt to several by a hash of its ids.  Every task of an insert is a memtable: it is
flushed as a sorted run of (digest, id) rows.  The run's distinct digests become
a segment of level 1: sorted (digest, smallest id, number of rows), with a filter,
a bitmap of hashed digests.  When a level has ``FANOUT`` segments they are merged
into one of the next level, which keeps the smallest identifiers.

A digest of more than one row is a hit: it repeats in its batch, or the filter of an
older segment lets it pass and the segment has it; digests that no filter lets
pass never reach an older segment.  The bytes behind hits are compared: the
smallest and the largest text of a digest must be the same string.  Digests that
fail are grouped again by the text itself.

Only DataFrame functions are used.  Hot groups shrink in the map-side half of
each aggregation, and the join back from runs to the index is a plain equi-join
that adaptive execution can split.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netloom.llm.common import BROADCAST_BYTES, bounded_broadcast, drop_scratch, fresh, materialize, scratch

#: Segments of a level that are merged into one of the next.
FANOUT = 4
#: Batches that a table is inserted in: the last is looked up in a merged level.
PARTS = FANOUT + 1
#: Bits a digest in a segment's filter.
FILTER_BITS = 16

RUN_OPTIONS = {
    "compression": "zstd",
    "parquet.bloom.filter.enabled#digest": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
    "parquet.bloom.filter.max.bytes": str(1 << 18),
}


def normalized(text: Column) -> Column:
    """Runs of the six ASCII white-space characters become one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def sha256_bytes(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


@dataclass
class Segment:
    """Sorted entries (digest, first, size), ``first`` being the struct that orders rows of a digest; and the filter (bucket, bits)."""

    entries: DataFrame
    path: str
    filter: DataFrame
    bits: int


class DedupIndex:
    """Runs, segments and hits of the documents inserted so far.

    ``digest`` maps the normalised text column to the binary index key; the
    default is SHA-256.  A weak digest only costs more byte comparisons.
    """

    def __init__(self, spark: SparkSession, id_col: str = "doc_id", text_col: str = "text", digest=sha256_bytes, broadcast_limit: int = BROADCAST_BYTES, fanout: int = FANOUT):
        self.spark, self.id_col, self.text_col, self.digest, self.limit, self.fanout = spark, id_col, text_col, digest, broadcast_limit, fanout
        self.sources: list[DataFrame] = []
        self.runs: list[DataFrame] = []
        self.probes = self.merges = 0
        self.hits: list[DataFrame] = []
        self.levels: list[list[Segment]] = []

    def _keyed(self, docs: DataFrame) -> DataFrame:
        """doc, norm (normalised text), digest; other columns of the input play no part."""
        text = docs.select(F.col(self.id_col).alias("doc"), normalized(F.col(self.text_col)).alias("norm"))
        return text.withColumn("digest", self.digest(F.col("norm")))

    def insert(self, docs: DataFrame, parts: int = 1) -> None:
        """Insert ``docs`` as one batch, or as ``parts`` batches dealt by a hash of the id: texts are read once for all of them.

        Each batch is flushed as a run, its digests are looked up in the older segments, and levels that are full are merged.
        """
        self.sources.append(docs)
        for run in self._flush(docs, parts):
            self._index(run)

    def _index(self, run: DataFrame) -> None:
        entries = run.groupBy("digest").agg(F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "batch", "row")).alias("first"), F.count(F.lit(1)).alias("size"))
        segment = self._segment(entries)
        self.hits.append(segment.entries.where("size > 1").select("digest"))
        for level in self.levels:
            self.hits += [materialize(self._found(segment.entries, older), "dedup-hits") for older in level]
        self.runs.append(run)
        self._push(segment, 0)

    def _flush(self, docs: DataFrame, parts: int) -> list[DataFrame]:
        """The runs of the batches, written in one pass; each is a folder of its own."""
        batch = (F.pmod(F.xxhash64("doc"), F.lit(parts)) + len(self.runs)).cast("int").alias("batch")
        rows = self._keyed(docs).select("digest", "doc", batch, F.monotonically_increasing_id().alias("row"), F.sha2(F.col("norm").cast("binary"), 256).alias("sha"))
        if self.digest is sha256_bytes:  # the key is the digest itself; the column would say it twice
            rows = rows.drop("sha")
        path = scratch(self.spark, "dedup-run")
        rows.sortWithinPartitions("batch", "digest").write.options(**RUN_OPTIONS).partitionBy("batch").parquet(path)
        runs = self.spark.read.schema(rows.schema).parquet(path)
        return [runs.where(F.col("batch") == len(self.runs) + k) for k in range(parts)]

    def _segment(self, entries: DataFrame) -> Segment:
        path = scratch(self.spark, "dedup-segment")
        entries.sortWithinPartitions("digest").write.options(**RUN_OPTIONS).parquet(path)
        entries = self.spark.read.schema(entries.schema).parquet(path)
        bits = FILTER_BITS * max(1, entries.count())
        at = _filter_place(bits)
        made = entries.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
        return Segment(entries, path, materialize(made, "dedup-filter"), bits)

    def _found(self, entries: DataFrame, older: Segment) -> DataFrame:
        """Digests of ``entries`` that ``older`` has; only those that its filter lets pass are looked up."""
        self.probes += 1
        at = _filter_place(older.bits)
        place = F.bitmap_bit_position(at)
        marked = F.conv(F.hex(F.substring("bits", F.expr("cast(place div 8 AS INT)") + 1, 1)), 16, 10).cast("int").bitwiseAND(F.expr("shiftleft(1, cast(place % 8 AS INT))")) != 0
        passed = entries.select("digest", F.bitmap_bucket_number(at).alias("bucket"), place.alias("place")).join(bounded_broadcast(older.filter, 4200, self.limit), "bucket").where(marked).select("digest")
        return older.entries.select("digest").join(bounded_broadcast(materialize(passed, "dedup-passed"), 96, self.limit), "digest", "left_semi")

    def _push(self, segment: Segment, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        held = self.levels[level]
        held.append(segment)
        if len(held) >= self.fanout:
            self.levels[level] = []
            self._push(self._merged(held), level + 1)

    def _merged(self, segments: list[Segment]) -> Segment:
        """One segment of several, with the smallest first row of each digest; the merged ones are removed."""
        self.merges += 1
        entries = reduce(DataFrame.unionByName, [s.entries for s in segments])
        out = self._segment(entries.groupBy("digest").agg(F.min("first").alias("first"), F.sum("size").alias("size")))
        kept = {id(h) for h in self.hits}
        self.hits = [materialize(h, "dedup-hits") if id(h) in kept else h for h in self.hits]  # hits may read what is removed
        for s in segments:
            drop_scratch(self.spark, s.path)
        return out

    def compact(self) -> DataFrame:
        """All segments merged into one: digest, keep, first, size."""
        segments = [s for level in self.levels for s in level]
        if len(segments) > 1:
            segments = [self._merged(segments)]
        self.levels = [[] for _ in self.levels[:-1]] + [segments]
        return segments[0].entries.withColumn("keep", F.col("first.doc"))

    def collided(self) -> DataFrame:
        """Hit digests behind which more than one text stands."""
        hits = bounded_broadcast(reduce(DataFrame.union, self.hits).distinct(), 96, self.limit)
        texts = self._texts().select("digest", "norm").join(hits, "digest", "left_semi")
        both = texts.groupBy("digest").agg(F.min("norm").alias("low"), F.max("norm").alias("high"))
        return materialize(both.where("low <> high").select("digest"), "dedup-collided")

    def _texts(self) -> DataFrame:
        return reduce(DataFrame.unionByName, [self._keyed(d) for d in self.sources])

    def rows(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.runs)

    def groups(self) -> DataFrame:
        """One row per document: doc, keep, size, kept, sha (hex of the normalised text)."""
        collided, index = self.collided(), self.compact()
        same = self.digest is sha256_bytes
        sha = F.lower(F.hex("digest")) if same else F.col("sha")
        broken = not collided.isEmpty()
        runs = self.rows().join(bounded_broadcast(collided, 96, self.limit), "digest", "left_anti") if broken else self.rows()
        kept = (F.col("batch") == F.col("first.batch")) & (F.col("row") == F.col("first.row"))
        out = runs.join(index, "digest").select("doc", "keep", "size", kept.alias("kept"), sha.alias("sha"))
        return out.unionByName(self._by_text(collided)) if broken else out

    def _by_text(self, collided: DataFrame) -> DataFrame:
        """The documents of collided digests, grouped by the text itself."""
        rows = self._texts().join(bounded_broadcast(collided, 96, self.limit), "digest", "left_semi").select("doc", "norm", F.monotonically_increasing_id().alias("row"))
        rows = materialize(rows, "dedup-bytes")
        first = rows.groupBy("norm").agg(F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "row")).alias("first"), F.count(F.lit(1)).alias("size"))
        joined = rows.join(first, "norm")
        return joined.select("doc", F.col("first.doc").alias("keep"), "size", (F.col("row") == F.col("first.row")).alias("kept"), F.sha2(F.col("norm").cast("binary"), 256).alias("sha"))

    def find(self, text: str) -> DataFrame:
        """Rows of the runs that hold ``text``; the files' own filters and bounds spare the other runs."""
        key = self.spark.createDataFrame([(text,)], "text string").select(self.digest(normalized(F.col("text"))).alias("k")).first()["k"]
        return self.rows().where(F.col("digest") == F.lit(bytes(key)))


def _filter_place(bits: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(bits)) + 1


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int = PARTS, **options) -> DataFrame:
    """Group documents by equal text, inserted in ``parts`` batches.

    Returns one row per input row: doc_id, keep_id, group_size, kept,
    text_sha256.  Texts are equal when they are the same after white-space runs
    become one space; null counts as empty.  The smallest doc_id stays, null ids
    come last, and of rows that agree in id and text exactly one stays.  An
    empty table gives an empty result; other columns are ignored.
    """
    index = DedupIndex(docs.sparkSession, id_col, text_col, **options)
    index.insert(docs, parts)
    return index.groups().select(F.col("doc").alias("doc_id"), F.col("keep").alias("keep_id"), F.col("size").alias("group_size"), "kept", F.col("sha").alias("text_sha256"))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`exact_duplicates` keeps, with all their columns."""
    index = DedupIndex(docs.sparkSession, id_col, text_col)
    index.insert(docs, PARTS)
    if not index.collided().isEmpty():
        raise ValueError("two texts share a SHA-256 digest")
    # A row goes if a smaller id has its text.  The pair (id, digest) names it.
    key, doc, digest = (fresh(n, docs) for n in ("key", "doc", "digest"))
    pair = [F.col("doc").alias(doc), F.col("digest").alias(digest)]
    gone = materialize(index.rows().join(index.compact().where("size > 1"), "digest").where("not (doc <=> keep)").select(*pair), "dedup-gone")
    again = materialize(index.rows().groupBy("doc", "digest").count().where("count > 1").select(*pair), "dedup-again")
    keyed = docs.withColumn(key, sha256_bytes(normalized(F.col(text_col))))
    on = lambda other: keyed[id_col].eqNullSafe(other[doc]) & (keyed[key] == other[digest])
    left = keyed.join(bounded_broadcast(gone, 128), on(gone), "left_anti")
    if again.isEmpty():
        return left.drop(key)
    # Rows that repeat in id and text: one of each stays, the smallest by its other columns' digest.
    several = left.join(bounded_broadcast(again, 128), on(again), "left_semi")
    first = several.groupBy(id_col, key).agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("first"))
    return left.join(bounded_broadcast(again, 128), on(again), "left_anti").drop(key).unionByName(first.select("first.*"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP4_SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
), h AS (SELECT doc_id, sha256(t) AS text_sha256 FROM n)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM h WINDOW w AS (PARTITION BY text_sha256)
"""
