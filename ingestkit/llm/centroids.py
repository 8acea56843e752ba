"""Centroid clustering of integer vectors with Ptolemaic pivots.

Every vector caches its distances to a few fixed pivots once. For two pivots p and q Ptolemy's inequality
bounds the distance of a vector v to a centroid c from below by
``|d(v,p) d(c,q) - d(v,q) d(c,p)| / d(p,q)``, so a round needs the pivot distances of its centroids only.
A vector is compared exactly with the centroid of the least bound; the others are compared exactly unless
their bound, rounded down by more than the error of the floating-point steps, is above that distance.
The exact comparisons are in whole numbers, so assignments, means and sums are exact at any partitioning.

A round is one pass over the written vectors: each task adds up its vectors per centroid, and what leaves
it is one row per centroid. The driver holds ``k`` centroids and at most ``PIVOTS`` pivots.

Defined results: vectors of another length, null vectors and vectors with a null, NaN or infinite component
are left out; repeated ids and rows are vectors of their own, and ties in the choice of the first centroids
go to the smaller id and then to the smaller components; a null id counts as the text ``null``. With fewer
vectors than ``k`` there are as many centroids as vectors, equal centroids leave the later ones empty, and an
empty table gives no rows. Components beyond ``LIMIT`` after scaling are an error, as squared distances would
not fit a long. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ingestkit.llm.common import tidy, written

DIM = 64
SCALE = 1024
SEED = "3"
CENTROIDS = 8
ROUNDS = 10
#: Most pivots; with 6 there are 15 pairs and as many bounds.
PIVOTS = 6
#: Largest component after scaling: 64 squares of twice this are below 2**61.
LIMIT = 1 << 26
#: Relative slack of the bounds; the few operations of a bound err by less than 2**-49.
SLACK = 2.0**-46
#: Vectors compared at a time.
CHUNK = 8_192


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dim: int = DIM,
                    scale: int = SCALE) -> DataFrame:
    """(vec_id, x): the vectors kept, with components ``floor(scale * x)``."""

    def whole(v: Column) -> Column:
        y = F.floor(v * F.lit(float(scale)))
        far = F.raise_error(F.concat(F.lit("component out of range: "), v.cast("string"))).cast("long")
        return F.when(F.abs(v) <= F.lit(float(LIMIT // scale)), y).otherwise(far).cast("int")

    def finite(v: Column) -> Column:
        return F.coalesce(F.abs(v) < F.lit(float("inf")), F.lit(False))  # NaN is above infinity

    v = F.col(vector_col).cast("array<double>")
    good = F.coalesce(F.size(v) == dim, F.lit(False)) & F.forall(v, finite)
    return df.where(good).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(v, whole).alias("x"))


def first_centroids(vectors: DataFrame, k: int = CENTROIDS, seed: str = SEED) -> np.ndarray:
    """The ``k`` vectors with the smallest digests of their ids, in ascending order; k rows reach the driver."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null")))
    rows = vectors.orderBy(F.sha2(name, 256), "vec_id", "x").limit(k).select("x").collect()
    return np.array([r["x"] for r in rows], np.int64)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of ``x`` to one vector, exactly."""
    d = x - c
    return np.einsum("ij,ij->i", d, d)


@dataclass(frozen=True)
class Pivots:
    """Fixed pivots and the pairs of them that give bounds."""

    points: np.ndarray

    @staticmethod
    def of(candidates: np.ndarray, most: int = PIVOTS) -> Pivots:
        """The first of each equal candidates, then greedily the farthest from those taken."""
        taken: list[np.ndarray] = []
        if len(candidates):
            away = np.full(len(candidates), np.iinfo(np.int64).max)
            at = 0
            while len(taken) < most and away[at] > 0:
                taken.append(candidates[at])
                away = np.minimum(away, squared(candidates, candidates[at]))
                at = int(away.argmax())
        return Pivots(np.array(taken, np.int64).reshape(len(taken), -1))

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Row per vector of ``x``, column per pivot."""
        return np.sqrt(np.stack([squared(x, p) for p in self.points], 1).astype(np.float64)) if len(self.points) else np.zeros((len(x), 0))

    def bounds(self, cached: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        """Lower bounds of the distances to every centroid from cached pivot distances, rounded down."""
        own, n = self.distances(centroids), len(self.points)
        between = self.distances(self.points)
        out = np.zeros((len(cached), len(centroids)))
        for p in range(n):
            for q in range(p):
                a, b = np.outer(cached[:, p], own[:, q]), np.outer(cached[:, q], own[:, p])
                np.maximum(out, (np.abs(a - b) - (a + b) * SLACK) * ((1 - SLACK) / between[p, q]), out=out)
        return out


def nearest(x: np.ndarray, cached: np.ndarray, centroids: np.ndarray, pivots: Pivots) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cluster, squared distance, exact comparisons) per vector; ties go to the smaller number."""
    low = pivots.bounds(cached, centroids)
    cluster = low.argmin(1)
    d = x - centroids[cluster]
    best = np.einsum("ij,ij->i", d, d)
    checked, first = np.ones(len(x), np.int32), cluster.copy()
    low = low * low * (1 - SLACK)
    for c in range(len(centroids)):
        rows = np.nonzero((low[:, c] <= best) & (first != c))[0]
        if len(rows):
            d = squared(x[rows], centroids[c])
            better = (d < best[rows]) | ((d == best[rows]) & (c < cluster[rows]))
            best[rows[better]], cluster[rows[better]] = d[better], c
            checked[rows] += 1
    return cluster, best, checked


def _chunks(batches: Iterator[pa.RecordBatch], dim: int, pivots: Pivots) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    for whole in batches:
        for at in range(0, len(whole), CHUNK):
            b = whole.slice(at, CHUNK)
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.int64)
            cached = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(x), len(pivots.points))
            yield b.column(0), x, cached


def with_pivots(vectors: DataFrame, pivots: Pivots, dim: int = DIM) -> DataFrame:
    """``vectors`` with the distances to the pivots, as computed once for all rounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.int64)
            cached = pivots.distances(x)
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * cached.shape[1])
            far = pa.ListArray.from_arrays(offsets, pa.array(cached.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), far], ["vec_id", "x", "pivots"])

    return vectors.select("vec_id", "x").mapInArrow(tidy(run), "vec_id long, x array<int>, pivots array<double>")


def sums(ready: DataFrame, centroids: np.ndarray, pivots: Pivots) -> DataFrame:
    """(cluster, place, total, n): component sums and counts of the vectors nearest to each centroid."""
    k, dim = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for _, x, cached in _chunks(batches, dim, pivots):
            cluster, _, _ = nearest(x, cached, centroids, pivots)
            for c in np.unique(cluster):
                total[c] += x[cluster == c].sum(0)
            n += np.bincount(cluster, minlength=k)
        some = np.nonzero(n)[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(list(total[some]), pa.list_(pa.int64())), pa.array(n[some])],
            ["cluster", "total", "n"],
        )

    parts = ready.mapInArrow(tidy(run), "cluster int, total array<long>, n long")
    wide = parts.select("cluster", "n", F.posexplode("total").alias("place", "total"))
    # tasks add at most their own rows times LIMIT; decimals carry the sum over all tasks
    return wide.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))


def moved(centroids: np.ndarray, ready: DataFrame, pivots: Pivots) -> np.ndarray:
    """The centroids after a round: exact floors of the means, empty ones as they were. ``k * dim`` rows
    reach the driver."""
    out = centroids.copy()
    for r in sums(ready, centroids, pivots).collect():
        out[r["cluster"], r["place"]] = int(r["total"]) // r["n"]
    return out


def assigned(ready: DataFrame, centroids: np.ndarray, pivots: Pivots) -> DataFrame:
    """(vec_id, cluster, distance, checked): nearest centroid, squared distance, and how many centroids
    the vector was compared with exactly."""
    dim = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x, cached in _chunks(batches, dim, pivots):
            cluster, best, checked = nearest(x, cached, centroids, pivots)
            columns = [ids, pa.array(cluster.astype(np.int32)), pa.array(best), pa.array(checked)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance", "checked"])

    return ready.mapInArrow(tidy(run), "vec_id long, cluster int, distance long, checked int")


def clusters(df: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: str = SEED, id_col: str = "vec_id",
             vector_col: str = "embedding", dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 and checked, one row per vector kept."""
    spark = df.sparkSession
    vectors = written(integer_vectors(df, id_col, vector_col, dim, scale), "vectors")
    centroids = first_centroids(vectors, k, seed)
    if not len(centroids):
        return spark.createDataFrame(
            [], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, checked int"
        )
    pivots = Pivots.of(centroids)
    ready = written(with_pivots(vectors, pivots, dim), "pivots")
    for _ in range(rounds):
        after = moved(centroids, ready, pivots)
        if (after == centroids).all():  # a fixed point: further rounds change nothing
            break
        centroids = after
    found = written(assigned(ready, centroids, pivots), "assigned")
    per = {r["cluster"]: r["d"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}  # at most k rows
    names = [hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for v in centroids.tolist()]
    facts = spark.createDataFrame(
        [(c, d, sum(per.values()), names[c]) for c, d in per.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return found.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "checked"
    )


def oracle_sql(k: int = CENTROIDS, rounds: int = ROUNDS, seed: str = SEED, dim: int = DIM, scale: int = SCALE) -> str:
    """DuckDB SQL of the same result, every vector compared with every centroid."""

    def near(centroids: str) -> str:
        return f"""SELECT v.id, c.cluster,
  CAST(list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(v.x, c.x)]) AS BIGINT) AS d
  FROM v, {centroids} c QUALIFY row_number() OVER (PARTITION BY v.id ORDER BY d, c.cluster) = 1"""

    steps = []
    for r in range(rounds):
        steps.append(f"n{r} AS MATERIALIZED ({near(f'c{r}')})")
        steps.append(f"""m{r} AS (SELECT n.cluster, j, sum(v.x[j]) AS s, count(*) AS n FROM n{r} n JOIN v USING (id),
  range(1, {dim + 1}) t(j) GROUP BY n.cluster, j)""")
        steps.append(f"""c{r + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN
  (SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS x FROM m{r} GROUP BY cluster) m USING (cluster))""")
    steps.append(f"n AS MATERIALIZED ({near(f'c{rounds}')})")
    return f"""WITH k AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
v AS MATERIALIZED (SELECT row_number() OVER () AS id, vec_id, [CAST(floor({scale} * y) AS BIGINT) for y in e] AS x FROM k
  WHERE len(e) = {dim} AND len([y for y in e if y IS NOT NULL AND isfinite(y)]) = {dim}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, vec_id, x) - 1 AS cluster, x FROM
  (SELECT *, sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), 'null')) AS h FROM v) ORDER BY h, vec_id, x LIMIT {k}),
{",\n".join(steps)}
SELECT v.vec_id, CAST(n.cluster AS INTEGER) AS cluster, n.d AS distance,
  CAST(sum(n.d) OVER (PARTITION BY n.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(n.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM n JOIN v USING (id) JOIN c{rounds} c ON c.cluster = n.cluster"""
