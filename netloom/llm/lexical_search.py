"""Ranked lexical search by the threshold algorithm.

``write_index`` cuts a corpus into segments of bounded size, wherever its rows
happen to be, and writes one row per (segment, term): the documents that hold
the term, by number, and how often.  A row with the empty term lists the
segment's documents and their lengths.

``search`` reads the lists of the query terms only.  Inside a segment each list
is put in order of impact and the lists are turned into a forward index.  All
lists of a query are then read in turn to the same depth; each document that
comes up for the first time is scored in full through the forward index, and
reading ends once the impacts at that depth add up to less than the k-th best
score, strictly, so that ties are complete.  A task keeps the best k of a query
from segment to segment, so later segments end sooner.  Impacts depend on the
corpus' mean length, which moves with every document, so the order is made when
a list is read and not when it is written.

Null and empty texts hold no term and are in no result.  Rows that share a
doc_id are documents of their own; a null doc_id comes after all others.  Each
row of the queries is one query, repeated rows too; one without terms gets no
rows.  Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netloom.llm.common import BROADCAST_BYTES, discard, drop_scratch, materialize, scratch, texts_of

#: Bytes of text in a segment; a longer document has one of its own.
SEGMENT_BYTES = 16 << 20
#: Depth to which lists are read before the first test; it doubles from test to test.
FIRST_DEPTH = 16
#: A query's results are merged in so many groups first, so that no task gets those of all tasks.
MERGE_GROUPS = 64

#: Upper-case ASCII letters to lower case, other ASCII but digits and lower-case letters to spaces.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

POSTINGS = "segment long, term binary, docs array<int>, tf array<int>, ids array<long>"


def terms_of(text: bytes | None) -> list[bytes]:
    """Terms of a UTF-8 text in order: runs of letters, digits and all that isn't ASCII."""
    return (text or b"").translate(_FOLD).split()


class _Numbers(dict):
    def __missing__(self, term: bytes) -> int:
        number = self[term] = len(self)
        return number


def _lists(segment: int, ids: list[int | None], bags: list[np.ndarray], numbers: dict) -> Iterator[pa.RecordBatch]:
    """The rows of one segment, some thousand at a time."""
    length = np.fromiter(map(len, bags), np.int64, len(bags))
    yield _batch([segment], [b""], np.array([0, len(ids)]), length, np.zeros(len(ids)), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(ids, pa.int64())))
    pairs, tf = np.unique(np.concatenate(bags) * len(ids) + np.repeat(np.arange(len(ids)), length), return_counts=True)
    term, doc = np.divmod(pairs, len(ids))
    bounds = np.searchsorted(term, np.arange(len(numbers) + 1))
    names = list(numbers)
    for a in range(0, len(names), 5000):
        b = min(a + 5000, len(names))
        inside = slice(bounds[a], bounds[b])
        yield _batch([segment] * (b - a), names[a:b], bounds[a : b + 1] - bounds[a], doc[inside], tf[inside], pa.nulls(b - a, pa.list_(pa.int64())))


def _batch(segment, term, offsets, docs, tf, ids) -> pa.RecordBatch:
    at = pa.array(offsets, pa.int32())
    lists = [pa.ListArray.from_arrays(at, pa.array(x.astype(np.int32))) for x in (docs, tf)]
    return pa.RecordBatch.from_arrays([pa.array(segment, pa.int64()), pa.array(term, pa.binary()), *lists, ids], ["segment", "term", "docs", "tf", "ids"])


def _inverted(segment_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, held, ids, bags, numbers = TaskContext.get().partitionId() << 32, 0, [], [], _Numbers()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                terms = terms_of(text.as_py())
                if terms:
                    ids.append(doc)
                    bags.append(np.fromiter(map(numbers.__getitem__, terms), np.int64, len(terms)))
                    held += len(text.as_buffer())
                if held >= segment_bytes:
                    yield from _lists(segment, ids, bags, numbers)
                    segment, held, ids, bags, numbers = segment + 1, 0, [], [], _Numbers()
        if ids:
            yield from _lists(segment, ids, bags, numbers)

    return run


def write_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_bytes: int = SEGMENT_BYTES) -> str:
    """Write the lists of ``docs`` and return their folder."""
    path = scratch(docs.sparkSession, "lexical-index")
    rows = texts_of(docs).select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("binary").alias("text"))
    rows.mapInArrow(_inverted(segment_bytes), POSTINGS).write.option("compression", "zstd").parquet(path)
    return path


class _Best:
    """The k best documents of a query so far."""

    def __init__(self, k: int):
        self.k, self.score, self.doc, self.null = k, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def floor(self) -> int:
        """The k-th score, below which nothing can enter; 0 while there are fewer."""
        return int(self.score[-1]) if len(self.score) == self.k else 0

    def add(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        able = score >= max(self.floor(), 1)
        score, doc, null = (np.concatenate([a, b[able]]) for a, b in ((self.score, score), (self.doc, doc), (self.null, null)))
        order = np.lexsort((doc, null, -score))[: self.k]
        self.score, self.doc, self.null = score[order], doc[order], null[order]


class _Segment:
    """Impact-ordered lists of the query terms in one segment, and its forward index over them."""

    def __init__(self, ids: np.ndarray, null: np.ndarray, n: np.ndarray, lists: dict[int, tuple[np.ndarray, np.ndarray]], n_docs: int, n_terms: int, width: int):
        self.ids, self.null = ids, null
        m = 75 + 25 * n * n_docs // n_terms
        self.lists = {}
        for term, (docs, tf) in lists.items():
            impact = 1_000_000_000 * tf // (1000 * tf + 12 * m[docs])
            order = np.argsort(-impact, kind="stable")
            self.lists[term] = docs[order], impact[order]
        docs = np.concatenate([d for d, _ in self.lists.values()])
        order = np.argsort(docs, kind="stable")
        self.term = np.repeat(np.fromiter(self.lists, np.int64, len(self.lists)), [len(d) for d, _ in self.lists.values()])[order]
        self.impact = np.concatenate([i for _, i in self.lists.values()])[order]
        self.bounds = np.searchsorted(docs[order], np.arange(len(ids) + 1))
        self.weight = np.zeros(width, np.int64)

    def scores(self, docs: np.ndarray) -> np.ndarray:
        """Full scores of documents, from their rows of the forward index and the weights set."""
        start, count = self.bounds[docs], self.bounds[docs + 1] - self.bounds[docs]
        ends = np.cumsum(count)
        at = np.arange(ends[-1]) + np.repeat(start - (ends - count), count)
        return np.add.reduceat(self.impact[at] * self.weight[self.term[at]], ends - count)

    def search(self, terms: list[int], weights: list[int], best: _Best) -> None:
        here = [(*self.lists[t], w) for t, w in zip(terms, weights) if t in self.lists]
        if not here:
            return
        self.weight[terms] = weights
        seen, depth, last = np.zeros(len(self.ids), bool), 0, max(len(d) for d, _, _ in here)
        while depth < last:
            reach = max(FIRST_DEPTH, 2 * depth)
            new = np.unique(np.concatenate([d[depth:reach] for d, _, _ in here]))
            new, depth = new[~seen[new]], reach
            if len(new):
                seen[new] = True
                best.add(self.scores(new), self.ids[new], self.null[new])
            if sum(w * int(i[depth - 1]) for _, i, w in here if depth <= len(i)) < best.floor():
                break
        self.weight[terms] = 0


def _searched(queries: list[tuple], numbers: dict[bytes, int], n_docs: int, n_terms: int, k: int):
    """queries: (number, item, term numbers, weights)."""

    def segments(batches):
        now, head, lists = None, None, {}
        for batch in batches:
            docs, tf, ids = (batch.column(c) for c in ("docs", "tf", "ids"))
            at, flat_docs, flat_tf = np.asarray(docs.offsets), np.asarray(docs.values), np.asarray(tf.values)
            for row, (segment, term) in enumerate(zip(batch.column("segment").to_pylist(), batch.column("term").to_pylist())):
                if segment != now:
                    if lists:
                        yield *head, lists
                    now, head, lists = segment, None, {}
                inside = slice(at[row], at[row + 1])
                if term:
                    lists[numbers[term]] = flat_docs[inside].astype(np.int64), flat_tf[inside].astype(np.int64)
                else:
                    own = ids[row].values
                    head = np.asarray(own.fill_null(0)), np.asarray(own.is_null()), flat_docs[inside].astype(np.int64)
        if lists:
            yield *head, lists

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [_Best(k) for _ in queries]
        for ids, null, n, lists in segments(batches):
            segment = _Segment(ids, null, n, lists, n_docs, n_terms, len(numbers))
            for (_, _, terms, weights), found in zip(queries, best):
                segment.search(terms, weights, found)
        for (number, item, _, _), found in zip(queries, best):
            if len(found.score):
                size = len(found.score)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * size, pa.int64()), pa.array([item] * size, pa.int64()), pa.array(found.doc, mask=found.null), pa.array(found.score), pa.array([TaskContext.get().partitionId()] * size, pa.int32())],
                    ["query", "item_id", "doc_id", "score", "task"],
                )

    return run


def _query_terms(batches):
    for batch in batches:
        bags = [Counter(terms_of(t)) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("query"), batch.column("item_id"), pa.array([list(b) for b in bags], pa.list_(pa.binary())), pa.array([list(b.values()) for b in bags], pa.list_(pa.int32()))], ["query", "item_id", "terms", "times"])


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _block(spark: SparkSession, postings: DataFrame, queries: DataFrame, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """The best k of each task for one bounded block of queries."""
    wanted = queries.select(F.explode("terms").alias("term")).distinct()
    df = {r["term"]: r["df"] for r in postings.join(F.broadcast(wanted), "term", "left_semi").groupBy("term").agg(F.sum(F.size("docs")).alias("df")).collect()}
    numbers = {bytes(t): i for i, t in enumerate(sorted(df))}
    weight = {numbers[bytes(t)]: term_weight(n_docs, d) for t, d in df.items()}
    rows = []
    for r in queries.collect():
        held = [(numbers[bytes(t)], c) for t, c in zip(r["terms"], r["times"]) if bytes(t) in numbers]
        if held:
            rows.append((r["query"], r["item_id"], [t for t, _ in held], [c * weight[t] for t, c in held]))
    if not rows:
        return spark.createDataFrame([], "query long, item_id long, doc_id long, score long, task int")
    named = spark.createDataFrame([(b"",), *((t,) for t in numbers)], "term binary")
    near = postings.join(F.broadcast(named), "term", "left_semi").repartition("segment").sortWithinPartitions("segment", "term")
    return texts_of(near).mapInArrow(_searched(rows, numbers, n_docs, n_terms, k), "query long, item_id long, doc_id long, score long, task int")


def search(spark: SparkSession, index: str, items: DataFrame, k: int = 20, item_col: str = "item_id", text_col: str = "text", block_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score of the ``k`` best documents of each query.

    Queries are taken in blocks of ``block_bytes`` at most (one at a time if
    one is larger); the driver and each task hold a block with its weights.
    """
    postings = spark.read.schema(POSTINGS).parquet(index)
    total = postings.where("term = X''").select(F.size("docs").alias("d"), F.expr("aggregate(docs, 0L, (a, x) -> a + x)").alias("t")).agg(F.sum("d"), F.sum("t")).first()
    n_docs, n_terms = total[0] or 0, total[1] or 0
    rows = texts_of(items).select(F.monotonically_increasing_id().alias("query"), F.col(item_col).cast("long").alias("item_id"), F.col(text_col).cast("binary").alias("text"))
    queries = materialize(rows.mapInArrow(_query_terms, "query long, item_id long, terms array<binary>, times array<int>"), "lexical-queries")
    size = queries.select(F.sum(F.size("terms") * 48 + F.expr("aggregate(terms, 0L, (a, x) -> a + length(x))"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes)) if n_docs else 0
    found = spark.createDataFrame([], "query long, item_id long, doc_id long, score long, task int")
    for b in range(blocks):
        found = found.unionByName(_block(spark, postings, queries.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == b), n_docs, n_terms, k))
    discard(queries)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    some = found.withColumn("at", F.row_number().over(Window.partitionBy("query", F.pmod("task", F.lit(MERGE_GROUPS))).orderBy(*order))).where(F.col("at") <= k)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= k)
    return best.select("item_id", "rank", "doc_id", "score")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of each benchmark item."""
    index = write_index(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    found = materialize(search(spark, index, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), 20), "lexical-results")
    drop_scratch(spark, index)
    return found


OP13_SQL = r"""
WITH words AS MATERIALIZED (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents
), pairs AS MATERIALIZED (
    SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL
), docs AS MATERIALIZED (
    SELECT doc_id, sum(tf)::BIGINT AS n FROM pairs GROUP BY doc_id
), total AS (
    SELECT count(*) AS nd, sum(n)::BIGINT AS l FROM docs
), weights AS (
    SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM pairs, total GROUP BY term, nd
), asked AS (
    SELECT item_id, term, count(*) AS times
    FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
    GROUP BY ALL
), scored AS (
    SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nd) // l))))::BIGINT AS score
    FROM asked JOIN pairs USING (term) JOIN weights USING (term) JOIN docs USING (doc_id), total
    GROUP BY item_id, doc_id
)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20
"""
