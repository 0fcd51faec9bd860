"""N-gram Jaccard self-join by MinHash banding.

A text is the set of its word n-grams.  Texts with equal sets form a class, and
only one signature a class goes on.  Signatures are cut into bands whose
number and width follow from the recall wanted at the threshold.

1. Classes that share a band hash meet in the task of that bucket, with a sketch
   of one byte a hash each.  Pairs whose sketches agree far less often than the
   threshold asks for are no candidates; of the others a task gives a spanning
   forest, not all pairs.  Bands can therefore not chain texts that are unlike.
2. The connected components of the forests bound what may be similar.  Inside
   them every pair of n-gram sets is compared in full.

Neither step holds a large group in one task.  A bucket or component of more
classes than a task takes is dealt into blocks, and each pair of blocks is a
task of its own; blocks grow with the group, so copies of its rows grow with
its root.  In step 2 blocks hold sets of similar size, and a set only meets the
sets of its own and the next size class, which are all that can reach the
threshold.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netloom.llm.common import Bitmap, bounded_broadcast, discard, fresh, materialize, texts_of, worker_cache
from netloom.llm.components import components

N, THRESHOLD, RECALL, HASHES = 5, 0.8, 0.9999, 320
#: Classes of a group that one task takes whole; a larger group is dealt into blocks.
BLOCK = 128
#: The same for a bucket, whose rows are small.
BUCKET_BLOCK = 512
#: Most classes in a block, which bounds a task to twice as many.
LARGEST_BLOCK = 1024
#: Standard deviations below the threshold at which sketches still make a candidate; 7 lose less than one pair in 10^11.
SLACK = 7

WORDS = re.compile(r"\w+")
_MASK = (1 << 64) - 1


def choose_bands(threshold: float, recall: float, hashes: int) -> tuple[int, int]:
    """(bands, rows): the widest rows whose bands reach ``recall`` at ``threshold`` with at most ``hashes`` hashes."""
    best = None
    for rows in range(1, hashes + 1):
        hit = threshold**rows
        bands = 1 if hit >= recall else math.ceil(math.log(1 - recall) / math.log1p(-hit))
        if bands * rows <= hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError("too few hashes for this recall")
    return best


class _WordHash(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: str) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


class Shingler:
    """n-gram sets and signatures of texts."""

    def __init__(self, n: int = N, bands: int = 1, rows: int = 1, seed: int = 7):
        self.n, self.bands, self.rows, self.known = n, bands, rows, _WordHash()
        rng = np.random.default_rng(seed)
        self.weights = rng.integers(1, 1 << 63, n, dtype=np.uint64) | np.uint64(1)
        self.a = (rng.integers(0, 1 << 32, bands * rows, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)[:, None]
        self.b = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint64).astype(np.uint32)[:, None]
        self.mix = rng.integers(1, 1 << 63, rows, dtype=np.uint64) | np.uint64(1)
        self.salt = rng.integers(1, 1 << 63, bands, dtype=np.uint64)

    def grams(self, text: str | None) -> np.ndarray:
        """Sorted distinct 64-bit hashes of the word n-grams; fewer words than n make one gram of all, no word none."""
        words = WORDS.findall((text or "").lower())
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.known) > 500_000:
            self.known.clear()
        h = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        width = min(self.n, len(h))
        count = len(h) - width + 1
        g = np.full(count, (width * 0x9E3779B97F4A7C15) & _MASK, np.uint64)
        for k in range(width):
            g += h[k : k + count] * self.weights[k]
        g ^= g >> np.uint64(31)
        g *= np.uint64(0xBF58476D1CE4E5B9)
        g ^= g >> np.uint64(29)
        return np.unique(g)

    def band_hashes(self, grams: np.ndarray) -> tuple[np.ndarray, bytes]:
        """The hash of each band, and the low byte of each minimum."""
        x = (grams >> np.uint64(32)).astype(np.uint32)
        low = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        for k in range(0, len(x), 512):
            np.minimum(low, (self.a * x[k : k + 512] + self.b).min(axis=1), out=low)
        h = (low.astype(np.uint64).reshape(self.bands, self.rows) + np.uint64(1)) * self.mix
        h = h.sum(axis=1, dtype=np.uint64) ^ self.salt
        h *= np.uint64(0x94D049BB133111EB)
        return (h ^ (h >> np.uint64(32))).view(np.int64), low.astype(np.uint8).tobytes()


def signature(grams: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(grams.tobytes())


SIGNATURES = "doc_id long, sig binary, n int, bands array<long>, sketch binary"


def signatures(docs: DataFrame, n: int, bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, sig, n, bands, sketch of each document; the last two are null where the task has given them for the same set before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, given = worker_cache(("shingler", n, bands, rows), lambda: Shingler(n, bands, rows)), set()
        for batch in batches:
            sigs, sizes, flat, offsets, sketches = [], [], [], [0], []
            for text in batch.column(1).to_pylist():
                grams = shingler.grams(text)
                sig = signature(grams)
                fresh = len(grams) > 0 and sig not in given
                sketch = None
                if fresh:
                    given.add(sig)
                    own, sketch = shingler.band_hashes(grams)
                    flat.append(own)
                sigs.append(sig)
                sizes.append(len(grams))
                sketches.append(sketch)
                offsets.append(offsets[-1] + bands * fresh)
            values = pa.array(np.concatenate(flat) if flat else np.zeros(0, np.int64))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values, mask=pa.array([x is None for x in sketches], pa.bool_()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sigs, pa.binary()), pa.array(sizes, pa.int32()), lists, pa.array(sketches, pa.binary())], ["doc_id", "sig", "n", "bands", "sketch"])

    return texts_of(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null").mapInArrow(run, SIGNATURES)


def _block_count(members: Column, block: int) -> Column:
    """Blocks of a group too large for one task: 16 to a group until they are full."""
    size = F.least(F.lit(LARGEST_BLOCK), F.greatest(F.lit(max(1, block // 2)), F.ceil(members / 16)))
    return F.ceil(members / size).cast("int")


def _upto(count: Column) -> Column:
    return F.when(F.coalesce(count, F.lit(0)) > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


def candidates(classes: DataFrame, threshold: float, block: int) -> tuple[DataFrame, list[DataFrame]]:
    """(a, b) edges (class numbers) of a spanning forest of the classes that share a band and whose sketches agree nearly as the threshold asks; and the tables it reads."""
    members = classes.select(F.explode("bands").alias("band")).groupBy("band").agg(F.count(F.lit(1)).alias("members"))
    shared = materialize(members.where("members > 1"), "buckets")
    known = Bitmap(shared, "band")

    def probably_shared(batches):
        for batch in batches:
            bands = batch.column(1)
            at = pa.array(known.holds(np.asarray(bands.flatten())))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pc.list_parent_indices(bands).take(at)), bands.flatten().take(at)], ["num", "band"])

    blocks = F.when(F.col("members") <= block, F.lit(1)).otherwise(_block_count(F.col("members"), block))
    bands = classes.select("num", "bands").mapInArrow(probably_shared, "num long, band long")
    held = bands.join(shared.select("band", blocks.alias("blocks")), "band").groupBy("num").agg(F.collect_list(F.struct("band", "blocks")).alias("buckets"))  # at most one a band
    held = materialize(held, "held")
    k = F.pmod(F.xxhash64("num", "bucket.band"), F.col("bucket.blocks")).cast("int")
    dealt = classes.select("num", "sketch").join(held, "num").select("num", "sketch", F.explode("buckets").alias("bucket")).withColumn("k", k)
    dealt = dealt.select("num", "sketch", F.col("bucket.band").alias("band"), "k", F.explode(_upto(F.col("bucket.blocks"))).alias("x"))
    key = F.xxhash64("band", F.least("k", "x"), F.greatest("k", "x"))
    rows = dealt.select(key.alias("key"), "band", F.least("k", "x").alias("i"), F.greatest("k", "x").alias("j"), (F.col("k") > F.col("x")).alias("second"), "num", "sketch")
    edges = rows.repartition("key").sortWithinPartitions("key", "band", "i", "j", "num").mapInArrow(_forests(threshold), "a long, b long").distinct()
    return edges, [shared, held]


def least_agreement(threshold: float, hashes: int) -> int:
    """The number of equal sketch bytes that pairs at the threshold reach but for ``SLACK`` standard deviations."""
    return math.ceil(hashes * threshold - SLACK * math.sqrt(hashes * threshold * (1 - threshold)))


def trees(sketches: np.ndarray, least: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The components of the graph of sketches (rows) that agree in ``least`` places, and the edges of a spanning forest.

    Rows come by number, so the buckets of a group mostly hang their rows on the
    same few smallest ones and give the same edges.
    """
    left, edges, tree = np.arange(len(sketches)), [], np.zeros(len(sketches), np.int64)
    while len(left):
        root = left[0]
        reached, left = [root], left[1:]
        while reached:
            at = reached.pop()
            tree[at] = root
            near = (sketches[left] == sketches[at]).sum(axis=1) >= least
            edges += [(x, int(at)) for x in left[near].tolist()]
            reached += left[near].tolist()
            left = left[~near]
    return tree, edges


def bridges(sketches: np.ndarray, second: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Edges that join the trees of two blocks; inside a block there is another task for them."""
    sides = [np.flatnonzero(~second), np.flatnonzero(second)]
    of = [trees(sketches[side], least)[0] for side in sides]
    root = {(k, t): (k, t) for k in (0, 1) for t in np.unique(of[k]).tolist()}

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    edges = []
    for t in np.unique(of[0]).tolist():
        for at in np.flatnonzero(of[0] == t).tolist():
            rest = np.array([u for u in np.unique(of[1]).tolist() if find((1, u)) != find((0, t))], np.int64)
            if not len(rest):
                break
            near = np.flatnonzero(np.isin(of[1], rest))
            near = near[(sketches[sides[1][near]] == sketches[sides[0][at]]).sum(axis=1) >= least]
            for u, k in zip(*np.unique(of[1][near], return_index=True)):
                edges.append((int(sides[0][at]), int(sides[1][near[k]])))
                root[find((1, int(u)))] = find((0, t))
    return edges


def _forests(threshold: float):
    def run(batches):
        group, rows = None, {}

        def done() -> list[tuple[int, int]]:
            if len(rows) < 2:
                return []
            nums, sketches = list(rows), np.frombuffer(b"".join(s for s, _ in rows.values()), np.uint8).reshape(len(rows), -1)
            least = least_agreement(threshold, sketches.shape[1])
            edges = trees(sketches, least)[1] if group[1] == group[2] else bridges(sketches, np.array([x for _, x in rows.values()]), least)
            return [(nums[a], nums[b]) for a, b in edges]

        for batch in batches:
            edges = []
            for band, i, j, second, num, sketch in zip(*(batch.column(c).to_pylist() for c in ("band", "i", "j", "second", "num", "sketch"))):
                if (band, i, j) != group:
                    edges += done()
                    group, rows = (band, i, j), {}
                rows[num] = (sketch, second)
            yield _pairs(edges)
        yield _pairs(done())

    def _pairs(edges):
        return pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], ["a", "b"])

    return run


def _tasks(members: DataFrame, threshold: float, block: int) -> DataFrame:
    """id, sig, key, side: where each member is compared; side 0 with all others, 1 and 2 with each other."""
    size = members.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    sized = members.join(size, "component").withColumn("band", F.floor(F.ln("n") / math.log(1 / threshold)).cast("int"))
    small = sized.where(F.col("members") <= block).select("id", "sig", F.col("component").cast("string").alias("key"), F.lit(0).alias("side"))
    large = sized.where(F.col("members") > block)
    blocks = materialize(large.groupBy("component", "band").agg(_block_count(F.count(F.lit(1)), block).alias("blocks")), "blocks")
    near = lambda by, name: blocks.select("component", (F.col("band") - by).alias("band"), F.col("blocks").alias(name))
    with_blocks = large.join(near(0, "own"), ["component", "band"]).join(near(1, "above"), ["component", "band"], "left").join(near(-1, "below"), ["component", "band"], "left")
    with_blocks = with_blocks.withColumn("k", F.pmod(F.xxhash64("id", "sig"), F.col("own")).cast("int"))
    key = lambda lower, i, upper, j: F.concat_ws(":", "component", lower, i, upper, j)
    band, k = F.col("band"), F.col("k")
    same = F.transform(_upto(F.col("own")), lambda x: F.struct(key(band, F.least(k, x), band, F.greatest(k, x)).alias("key"), F.when(k == x, 0).when(k < x, 1).otherwise(2).alias("side")))
    up = F.transform(_upto(F.col("above")), lambda x: F.struct(key(band, k, band + 1, x).alias("key"), F.lit(1).alias("side")))
    down = F.transform(_upto(F.col("below")), lambda x: F.struct(key(band - 1, x, band, k).alias("key"), F.lit(2).alias("side")))
    return small.unionByName(with_blocks.select("id", "sig", F.inline(F.concat(same, up, down))))


def _sets(n: int):
    def run(batches):
        shingler = worker_cache(("shingler", n, 1, 1), lambda: Shingler(n))
        for batch in batches:
            grams = [shingler.grams(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(signature, grams), pa.binary()), pa.array([g.tobytes() for g in grams], pa.binary())], ["id", "sig", "grams"])

    return run


def compare(ids: np.ndarray, sets: list[np.ndarray], sides: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All links among ``sets`` of side 0, or between those of sides 1 and 2: index, index, similarity."""
    flat = np.concatenate(sets)
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count[column] > 1
    _, column = np.unique(column[shared], return_inverse=True)
    owner = owner[shared]
    common = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    width = max(64, (4 << 20) // len(sets))
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, (first, first + width))
        part = np.zeros((len(sets), min(width, int(column[-1]) + 1 - first)), np.float32)
        part[owner[a:b], column[a:b] - first] = 1
        common += part @ part.T
    union = size[:, None] + size[None, :] - common
    linked = common >= threshold * union - 1e-6
    linked &= ids[:, None] != ids[None, :]
    if sides.any():
        linked &= sides[:, None] != sides[None, :]
    i, j = np.nonzero(np.triu(linked, 1))
    return i, j, common[i, j] / union[i, j]


def _verified(threshold: float, as_pairs: bool):
    """Links of each task, whose rows come one after the other."""

    def of_task(rows: dict) -> Iterator[tuple]:
        ids = np.array([r[0] for r in rows.values()])
        i, j, similarity = compare(ids, [r[1] for r in rows.values()], np.array([r[2] for r in rows.values()]), threshold)
        if as_pairs:
            yield from zip(np.minimum(ids[i], ids[j]).tolist(), np.maximum(ids[i], ids[j]).tolist(), similarity.tolist())
            return
        count = np.bincount(i, minlength=len(ids)) + np.bincount(j, minlength=len(ids))
        label = ids.copy()
        while len(i):
            before = label.copy()
            np.minimum.at(label, i, label[j])
            np.minimum.at(label, j, label[i])
            if (before == label).all():
                break
        for k in np.flatnonzero(count).tolist():
            yield int(ids[k]), int(label[k]), float(count[k])

    def run(batches):
        key, rows, out = None, {}, []
        for batch in batches:
            for k, i, side, raw in zip(*(batch.column(c).to_pylist() for c in ("key", "id", "side", "grams"))):
                if k != key:
                    if len(rows) > 1:
                        out += of_task(rows)
                    key, rows = k, {}
                rows[i, raw] = (i, np.frombuffer(raw, np.uint64), side)  # a repeated row counts once
            yield _links(out)
            out = []
        if len(rows) > 1:
            yield _links(list(of_task(rows)))

    def _links(out):
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.float64()))], ["a", "b", "value"])

    return run


class JaccardJoin:
    """The self-join of ``docs``; see :func:`similar_documents` for the cases it defines."""

    def __init__(self, docs: DataFrame, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = HASHES, block: int = BLOCK, bucket_block: int = BUCKET_BLOCK, id_col: str = "doc_id", text_col: str = "text"):
        self.docs, self.n, self.threshold, self.block, self.id_col, self.text_col = docs, n, threshold, block, id_col, text_col
        self.bands, self.rows = choose_bands(threshold, recall, hashes)
        self.signed = materialize(signatures(docs, n, self.bands, self.rows, id_col, text_col), "signatures")
        classes = self.signed.where("n > 0").groupBy("sig").agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("bands", ignorenulls=True).alias("bands"), F.first("sketch", ignorenulls=True).alias("sketch"))
        self.classes = materialize(classes.withColumn("num", F.monotonically_increasing_id()), "classes")
        edges, used = candidates(self.classes, threshold, bucket_block)
        groups = components(edges).withColumnRenamed("id", "num")
        self.members = materialize(self.classes.select("num", "id", "sig", "n").join(groups, "num").drop("num"), "members")
        discard(groups, *used)

    def _compared(self, as_pairs: bool) -> tuple[DataFrame, list[DataFrame]]:
        """The links, and the tables that they are computed from."""
        tasks = materialize(_tasks(self.members, self.threshold, self.block), "tasks")
        ids = self.members.select("id").distinct()
        texts = self.docs.select(F.col(self.id_col).cast("long").alias("id"), F.col(self.text_col).alias("text"))
        sets = materialize(texts.join(bounded_broadcast(ids, 48), "id", "left_semi").mapInArrow(_sets(self.n), "id long, sig binary, grams binary"), "sets")
        dealt = tasks.join(sets, ["id", "sig"]).select("key", "side", "id", "grams")
        # Ranges of keys hold about the same number of rows each, whatever the sizes of the groups.
        links = dealt.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(_verified(self.threshold, as_pairs), "a long, b long, value double")
        return links, [tasks, sets]

    def pairs(self) -> DataFrame:
        """id_a, id_b, similarity of all linked classes; their number can grow with the square of a group."""
        return self._compared(True)[0].select(F.col("a").alias("id_a"), F.col("b").alias("id_b"), F.col("value").alias("similarity"))

    def documents(self) -> DataFrame:
        found, used = self._compared(False)
        links = materialize(found, "links")
        discard(*used)
        count = links.groupBy(F.col("a").alias("id")).agg(F.sum("value").cast("long").alias("n_links"))
        groups = components(links.select("a", "b"))
        classes = self.classes.select("sig", "id", "copies").join(groups, "id", "left").join(count, "id", "left")
        classes = classes.select("sig", F.coalesce("component", "id").alias("class_id"), F.col("id").alias("set_id"), "copies", F.coalesce("n_links", F.lit(0)).alias("n_links"))
        docs = self.signed.where("n > 0").select("doc_id", "sig").join(classes, "sig").drop("sig")
        alone = self.signed.where("n = 0").select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("set_id"), F.lit(1).cast("long").alias("copies"), F.lit(0).cast("long").alias("n_links"))
        nameless = self.docs.where(F.col(self.id_col).isNull()).select(*(F.lit(None).cast("long").alias(c) for c in docs.columns))
        return docs.unionByName(alone).unionByName(nameless)


def similar_documents(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, class_id, set_id, copies, n_links.

    ``set_id`` is the smallest doc_id with the same n-gram set and ``copies``
    the number of rows with it; ``n_links`` counts the other n-gram sets of
    similarity at or above the threshold; ``class_id`` is the smallest doc_id
    that chains of links reach.  Texts without a word, null ones too, have no
    n-grams and link to nothing, not even to each other.  Rows with a null
    doc_id come back with nulls.  Rows that share a doc_id are one document
    with several sets: they share classes.  An empty table gives no rows; other
    columns are ignored.
    """
    return JaccardJoin(docs, **options).documents()


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without those that have a smaller doc_id in their class; rows with a null id stay."""
    found = similar_documents(docs, id_col=id_col, text_col=text_col, **options)
    name = fresh("gone", docs)
    gone = materialize(found.where("doc_id <> class_id").select(F.col("doc_id").alias(name)).distinct(), "similar-gone")
    return docs.join(bounded_broadcast(gone, 24), docs[id_col] == F.col(name), "left_anti")


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
