"""k-means over integer vectors with annulus search.

Vectors are made integers once, written, and read again each round.  A round
sorts the centroids by norm.  The distance of a vector to the two centroids whose
norms are next to its own bounds the distance to the nearest one from above, so
only centroids whose norm differs from the vector's by no more than that bound
can be nearest or as near: two binary searches find them, and these alone are
compared, exactly.  Tasks add up their vectors by cluster, so what is shuffled
and what the driver sees is a number for each centroid, component and task.

Kept are vectors with exactly ``dims`` components, all present and finite; other
rows, null vectors among them, are in no result.  Rows that share a vec_id are
vectors of their own; a null vec_id comes last among the candidates for first
centroids, and rows with the same id stand there by their components.  With
fewer vectors than ``k`` there are as many centroids; without any the result is
empty.  A component of more than ``MOST`` once it is an integer is an error, as
sums of squares would not fit 64 bits.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netloom.llm.common import discard, materialize

#: Largest component; 64 squares of twice as much fit 64 bits.
MOST = 1 << 27
#: Pairs of a vector and a candidate compared at a time.
PAIRS = 1 << 15


def integer_vectors(df: DataFrame, dims: int, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """vec_id, v: kept vectors with each component as floor(scale * component)."""
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform("v", lambda x: F.floor(x * F.lit(float(scale))))
    kept = rows.where((F.size("v") == dims) & finite).select("vec_id", whole.alias("v"))
    fits = F.forall("v", lambda x: F.abs(x) <= MOST)
    return kept.select("vec_id", F.when(fits, F.col("v").cast("array<int>")).otherwise(F.raise_error(F.lit("a component is too large for exact distances"))).alias("v"))


class Annulus:
    """Nearest centroid of each of many vectors, exactly; of equally near ones the smaller number."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids.astype(np.int64)
        norms = np.sqrt((self.centroids.astype(np.float64) ** 2).sum(1))
        self.order = np.argsort(norms, kind="stable")
        self.norms = norms[self.order]
        self.compared = 0

    def _distances(self, vectors: np.ndarray, rows: np.ndarray, places: np.ndarray) -> np.ndarray:
        out = np.empty(len(rows), np.int64)
        for a in range(0, len(rows), PAIRS):
            cut = slice(a, a + PAIRS)
            apart = vectors[rows[cut]] - self.centroids[self.order[places[cut]]]
            out[cut] = np.einsum("ij,ij->i", apart, apart)
        self.compared += len(rows)
        return out

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cluster, squared distance) of each row of ``vectors`` (64-bit integers)."""
        n, k = len(vectors), len(self.norms)
        every = np.arange(n)
        norm = np.sqrt((vectors.astype(np.float64) ** 2).sum(1))
        above = np.minimum(np.searchsorted(self.norms, norm), k - 1)
        near = np.minimum(self._distances(vectors, every, above), self._distances(vectors, every, np.maximum(above - 1, 0)))
        bound = np.sqrt(near.astype(np.float64))
        bound += 1e-6 + 1e-12 * (bound + norm + self.norms[-1])  # rounding never leaves out a centroid on the border
        low, high = np.searchsorted(self.norms, norm - bound, "left"), np.searchsorted(self.norms, norm + bound, "right")
        cluster, least = np.empty(n, np.int64), np.empty(n, np.int64)
        step = max(1, 4 * PAIRS // k)
        for a in range(0, n, step):
            count = (high - low)[a : a + step]
            ends = np.cumsum(count)
            rows = np.repeat(every[a : a + step], count)
            places = np.arange(ends[-1]) + np.repeat(low[a : a + step] - (ends - count), count)
            apart = self._distances(vectors, rows, places)
            best = np.minimum.reduceat(apart, ends - count)
            number = np.where(apart == np.repeat(best, count), self.order[places], k)
            cluster[a : a + step], least[a : a + step] = np.minimum.reduceat(number, ends - count), best
        return cluster, least


def _matrix(column) -> np.ndarray:
    flat = column.flatten()
    return np.asarray(flat).astype(np.int64).reshape(len(column), -1)


def _sums(centroids: np.ndarray):
    """Per task and centroid with vectors: cluster, place (-1 for their number), total."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, k, dims = Annulus(centroids), *centroids.shape
        total = np.zeros((k, dims + 1), np.int64)
        for batch in batches:
            if batch.num_rows:
                vectors = _matrix(batch.column("v"))
                cluster, _ = search.nearest(vectors)
                order = np.argsort(cluster, kind="stable")
                present, first = np.unique(cluster[order], return_index=True)
                total[present, 1:] += np.add.reduceat(vectors[order], first, axis=0)
                total[:, 0] += np.bincount(cluster, minlength=k)
        at = np.flatnonzero(total[:, 0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(at, dims + 1).astype(np.int32)), pa.array(np.tile(np.arange(-1, dims, dtype=np.int32), len(at))), pa.array(total[at].ravel())], ["cluster", "place", "total"]
        )

    return run


def _assigned(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Annulus(centroids)
        for batch in batches:
            if batch.num_rows:
                cluster, apart = search.nearest(_matrix(batch.column("v")))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(apart)], ["vec_id", "cluster", "distance"])

    return run


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 of ``seed:vec_id``, in that order."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return np.array([r["v"] for r in vectors.select("v", "vec_id", key.alias("key")).orderBy(F.asc_nulls_last("key"), F.asc_nulls_last("vec_id"), "v").limit(k).collect()], np.int64)


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after a round: the floor of the mean of their vectors; those without any stay."""
    rows = vectors.mapInArrow(_sums(centroids), "cluster int, place int, total long").groupBy("cluster", "place").agg(F.sum("total").alias("total")).collect()
    total = {(r["cluster"], r["place"]): r["total"] for r in rows}
    out = centroids.copy()
    for c in {c for c, _ in total}:
        out[c] = [total[c, p] // total[c, -1] for p in range(centroids.shape[1])]
    return out


def cluster(df: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of each kept vector."""
    spark = df.sparkSession
    vectors = materialize(integer_vectors(df, dims, scale, id_col, vec_col), "vectors")
    centroids = first_centroids(vectors, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    assigned = materialize(vectors.mapInArrow(_assigned(centroids), "vec_id long, cluster int, distance long"), "assigned")
    discard(vectors)
    of = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    facts = [(c, s, sum(of.values()), sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, s in of.items()]
    return assigned.join(F.broadcast(spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight clusters of ``embeddings``, ten rounds."""
    return cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _sql(rounds: int, k: int) -> str:
    """The same rounds written out: every vector against every centroid."""
    parts = [
        "kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)",
        "long AS MATERIALIZED (SELECT r, generate_subscripts(v, 1) AS p, unnest(v) AS x FROM kept)",
        f"first AS (SELECT r, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c FROM kept QUALIFY c < {k})",
        "c0 AS MATERIALIZED (SELECT c, p, x FROM first JOIN long USING (r))",
    ]
    for n in range(rounds + 1):
        parts.append(f"d{n} AS MATERIALIZED (SELECT r, c, sum((l.x - m.x) * (l.x - m.x))::BIGINT AS d FROM long l JOIN c{n} m USING (p) GROUP BY r, c)")
        parts.append(f"a{n} AS MATERIALIZED (SELECT r, c, d FROM d{n} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)")
        if n < rounds:
            parts.append(f"s{n} AS (SELECT c, p, sum(x)::BIGINT AS s, count(*) AS n FROM a{n} JOIN long USING (r) GROUP BY c, p)")
            parts.append(f"c{n + 1} AS MATERIALIZED (SELECT o.c, o.p, coalesce((s - ((s % n) + n) % n) // n, o.x) AS x FROM c{n} o LEFT JOIN s{n} USING (c, p))")
    last = rounds
    parts.append(f"h AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY p)) AS centroid_sha256 FROM c{last} GROUP BY c)")
    return "WITH " + ",\n".join(parts) + (
        f"\nSELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256\n"
        f"FROM a{last} JOIN h USING (c) JOIN kept USING (r)"
    )


OP12_SQL = _sql(10, 8)
