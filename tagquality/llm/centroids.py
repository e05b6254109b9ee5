"""Centroid clustering by equal-average equal-variance search.

Vectors are integers: floor(scale * x) of each component. Centroids are sorted by the sum of their components;
the search for a vector's nearest centroid begins where the vector's own sum would be and goes outward on both
sides. With d components, means m and deviations s, the squared distance is at least
d * (m - m')^2, so that a vector is done once the next mean is too far; and at least
d * ((m - m')^2 + (s - s')^2), so that many of the centroids before that are passed over. Bounds are
floating-point with a margin; what they leave is compared by exact integer distances.

A vector is kept if it has exactly DIMENSIONS components, none null or not finite. A component of
LARGEST or more after scaling is an error, as a distance would not fit a long. Rows that repeat count each time;
a null vec_id stays null. Ties of distance go to the smaller centroid number; an empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagquality.llm.common import written

DIMENSIONS = 64
CENTROIDS = 8
ROUNDS = 10
SCALE = 1024
SEED = 3
LARGEST = 1 << 27


def integer_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, v array<int>) of the kept rows of `vectors` (vec_id, embedding)."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = rows.where((F.size("x") == dimensions) & F.forall("x", good))
    large = F.raise_error(F.lit(f"a component reaches {LARGEST} after scaling"))
    whole = lambda x: F.when(F.abs(x * scale) < LARGEST, F.floor(x * scale)).otherwise(large).cast("int")
    return rows.select("vec_id", F.transform("x", whole).alias("v"))


class Search:
    """The centroids of a round, sorted by the sum of their components."""

    def __init__(self, centroids: np.ndarray) -> None:
        sums = centroids.sum(axis=1)
        self.order = np.argsort(sums, kind="stable")
        self.centroids, self.sums = centroids[self.order], sums[self.order]
        self.deviations = _deviations(self.centroids, self.sums)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of the centroid nearest to each row of `x`; ties to the smaller number."""
        size, count = x.shape[1], len(self.order)
        sums = x.sum(axis=1)
        deviations = _deviations(x, sums)
        right = np.searchsorted(self.sums, sums)
        left = right - 1
        best = np.full(len(x), np.iinfo(np.int64).max)
        number = np.full(len(x), -1)
        active = np.arange(len(x))
        while len(active):
            lo, hi, mine = left[active], right[active], sums[active]
            far_left = np.where(lo >= 0, mine - self.sums[np.maximum(lo, 0)], np.iinfo(np.int64).max)
            far_right = np.where(hi < count, self.sums[np.minimum(hi, count - 1)] - mine, np.iinfo(np.int64).max)
            take_left = far_left <= far_right
            gap = np.minimum(far_left, far_right)
            # Beyond these bounds no distance can be as small as the best so far.
            limit = best[active] * (1 + 1e-9) + 1
            mean = gap.astype(np.float64) ** 2 / size
            go = ((lo >= 0) | (hi < count)) & (mean <= limit)
            active, take_left, mean, limit = active[go], take_left[go], mean[go], limit[go]
            at = np.where(take_left, left[active], right[active])
            left[active] -= take_left
            right[active] += ~take_left
            near = mean + size * (deviations[active] - self.deviations[at]) ** 2 * (1 - 1e-9) <= limit
            rows, at = active[near], at[near]
            distance = ((x[rows] - self.centroids[at]) ** 2).sum(axis=1)
            names = self.order[at]
            better = (distance < best[rows]) | ((distance == best[rows]) & (names < number[rows]))
            best[rows[better]], number[rows[better]] = distance[better], names[better]
        return number, best


def _deviations(x: np.ndarray, sums: np.ndarray) -> np.ndarray:
    mean = sums[:, None] / x.shape[1]
    return np.sqrt(((x - mean) ** 2).mean(axis=1))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("v").flatten().to_numpy().astype(np.int64).reshape(batch.num_rows, -1)


def _moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """One round: partial sums of each task, then of all; an empty centroid stays."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(np.array(centroids))
        counts, sums = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), len(centroids[0])), np.int64)
        for batch in batches:
            x = _matrix(batch)
            number, _ = search.nearest(x)
            for c in np.unique(number):
                mine = number == c
                counts[c] += mine.sum()
                sums[c] += x[mine].sum(axis=0)
        # The sum of each component of each cluster; place -1 has the vectors of the cluster.
        seen = np.flatnonzero(counts)
        total = np.column_stack([counts, sums])[seen]
        number, place = np.repeat(seen, total.shape[1]), np.tile(np.arange(-1, total.shape[1] - 1), len(seen))
        columns = [pa.array(number.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(total.ravel())]
        yield pa.RecordBatch.from_arrays(columns, names=["cluster", "place", "s"])

    partial = vectors.select("v").mapInArrow(run, "cluster int, place int, s long")
    partial = partial.groupBy("cluster", "place").agg(F.sum(F.col("s").cast("decimal(20,0)")).alias("s"))
    sums = {(r["cluster"], r["place"]): int(r["s"]) for r in partial.collect()}
    return [
        [sums[k, i] // sums[k, -1] for i in range(len(c))] if (k, -1) in sums else c for k, c in enumerate(centroids)
    ]


def _assigned(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(np.array(centroids))
        for batch in batches:
            number, distance = search.nearest(_matrix(batch))
            columns = [batch.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(run, "vec_id long, cluster int, distance long")


def first_centroids(vectors: DataFrame, count: int = CENTROIDS, seed: int = SEED) -> list[list[int]]:
    """The `count` vectors whose id has the smallest hash, in ascending order; ids that repeat by id and components."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    drawn = vectors.select(F.sha2(name, 256).alias("h"), "vec_id", "v").orderBy("h", "vec_id", "v").limit(count)
    return [list(r["v"]) for r in drawn.collect()]


def cluster(
    vectors: DataFrame, dimensions: int = DIMENSIONS, count: int = CENTROIDS, rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each kept vector.

    The driver holds `count` centroids and their sums, whatever the number of vectors.
    """
    spark = vectors.sparkSession
    rows = written(integer_vectors(vectors, dimensions, scale), "vectors")
    centroids = first_centroids(rows, count, seed)
    if not centroids:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        centroids = _moved(rows, centroids)
    found = written(_assigned(rows, centroids), "clusters")
    sums = {r["cluster"]: int(r["d"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("d")).collect()}
    digest = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    facts = [(k, sums[k], sum(sums.values()), digest(c)) for k, c in enumerate(centroids) if k in sums]
    side = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(side), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
