"""Centroid clustering by equal-average equal-variance nearest-neighbour search.

Components become integers, so every distance is exact. Centroids are sorted by
the sum of their components; a vector's search begins where its own sum lies and
goes outward, always to the nearer side. With d components, sums S and deviations
v (root of the squared differences from the mean), any two vectors hold

    distance >= (S - S')**2 / d + (v - v')**2.

The first term alone ends a vector's search, as it only grows outward; both
together skip a centroid; what neither rejects is computed in integers. The
second term is taken a little smaller than computed, by more than floats can err.

A round is one pass without a shuffle of vectors: tasks send sums of their
vectors, one row a cluster and component, and only centroids (clusters x
components numbers) reach the driver and the tasks.

Cases: vectors of another number of components, with a null or non-finite
component, and null vectors are left out; components that would be beyond 2**27
either way count as 2**27, so that distances fit a long; vectors may be equal and
ids repeated or null, each row is a vector of its own and comes out (a null id is
hashed as an empty one; of equal hashes the lesser vector comes first); with fewer
vectors than clusters each one is a centroid; a table without usable vectors gives
no rows; other columns are left behind. A sum of distances beyond a long is null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, prepare

DIMENSIONS = 64
CLUSTERS = 16
ROUNDS = 3
#: Steps to a unit of a component.
SCALE = 64
#: Largest integer a component can have.
REACH = 1 << 27

ASSIGNED = "vec_id {}, cluster int, distance long"
SUMS = "cluster int, place int, total long, vectors long"
RESULT = (
    "vec_id {}, cluster int, distance long, cluster_inertia long, inertia long, "
    "centroid array<long>"
)


def whole_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """Usable vectors in integers: vec_id and point."""
    x = "embedding"
    usable = (F.size(x) == dimensions) & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    )
    low, high = F.lit(float(-REACH)), F.lit(float(REACH))
    point = F.transform(
        x, lambda c: F.floor(F.least(F.greatest(SCALE * c.cast("double"), low), high)).cast("int")
    )
    return vectors.select("vec_id", x).where(usable).select("vec_id", point.alias("point"))


class Centroids:
    """Centroids in the order of their sums, and the search among them."""

    def __init__(self, points: list[list[int]]) -> None:
        given = np.array(points, np.int64)
        order = np.argsort(given.sum(axis=1), kind="stable")
        self.number = order.astype(np.int64)
        self.points = given[order]
        self.sums, self.squares, self.spread = _moments(self.points)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of each vector's nearest centroid.

        Of several as near the one of smallest number. Also tells how many distances
        were computed.
        """
        count, dimensions = len(self.sums), points.shape[1]
        sums, squares, spread = _moments(points)
        best = np.full(len(points), np.iinfo(np.int64).max)
        found = np.full(len(points), np.iinfo(np.int64).max)
        right = np.searchsorted(self.sums, sums)
        left = right - 1
        live = np.arange(len(points))
        computed = 0
        for _ in range(count):
            below, above = left[live], right[live]
            to_left = np.where(below >= 0, sums[live] - self.sums[np.maximum(below, 0)], -1)
            to_right = np.where(
                above < count, self.sums[np.minimum(above, count - 1)] - sums[live], -1
            )
            go_left = (to_left >= 0) & ((to_right < 0) | (to_left <= to_right))
            here = np.where(go_left, below, above)
            left[live] -= go_left
            right[live] += ~go_left
            gap = np.where(go_left, to_left, to_right).astype(float)
            mean_part = gap * gap / dimensions * _BELOW
            going = mean_part <= best[live]
            live, here, mean_part = live[going], here[going], mean_part[going]
            if not len(live):
                break
            error = _SPREAD_ERROR * np.sqrt(np.maximum(squares[live], self.squares[here]))
            apart = np.maximum(np.abs(spread[live] - self.spread[here]) - error, 0)
            near = mean_part + apart * apart * _BELOW <= best[live]
            asked, centre = live[near], here[near]
            differences = points[asked] - self.points[centre]
            distance = np.einsum("ij,ij->i", differences, differences)
            computed += len(asked)
            number = self.number[centre]
            closer = (distance < best[asked]) | (
                (distance == best[asked]) & (number < found[asked])
            )
            best[asked[closer]] = distance[closer]
            found[asked[closer]] = number[closer]
        return found, best, computed


#: Factor that keeps a bound below its true value, whatever floats round away.
_BELOW = 1 - 2.0**-40
#: What a deviation can be wrong by, in parts of the root of its vector's squares.
_SPREAD_ERROR = 2.0**-22


def _moments(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums, sums of squares and deviations of vectors."""
    sums = points.sum(axis=1)
    squares = np.einsum("ij,ij->i", points, points).astype(float)
    spread = np.sqrt(np.maximum(squares - sums.astype(float) ** 2 / points.shape[1], 0))
    return sums, squares, spread


def _points(batch: pa.RecordBatch, dimensions: int) -> np.ndarray:
    values = batch.column("point").flatten().to_numpy(zero_copy_only=False)
    return values.astype(np.int64).reshape(-1, dimensions)


def assigned(points: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Each vector's nearest centroid: vec_id, cluster and distance."""
    kind = points.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Centroids(centroids)
        for batch in batches:
            cluster, distance, _ = search.nearest(_points(batch, len(centroids[0])))
            yield pa.record_batch(
                {
                    "vec_id": batch.column("vec_id"),
                    "cluster": pa.array(cluster.astype(np.int32)),
                    "distance": pa.array(distance),
                }
            )

    return points.mapInArrow(run, ASSIGNED.format(kind))


def moved(points: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Centroids after one round: floors of their vectors' means, empty ones unchanged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Centroids(centroids)
        totals = np.zeros((len(centroids), len(centroids[0])), np.int64)
        vectors = np.zeros(len(centroids), np.int64)
        for batch in batches:
            held = _points(batch, len(centroids[0]))
            cluster, _, _ = search.nearest(held)
            np.add.at(totals, cluster, held)
            vectors += np.bincount(cluster, minlength=len(centroids))
        full = np.flatnonzero(vectors)
        size = totals.shape[1]
        yield pa.record_batch(
            {
                "cluster": pa.array(np.repeat(full, size).astype(np.int32)),
                "place": pa.array(np.tile(np.arange(size), len(full)).astype(np.int32)),
                "total": pa.array(totals[full].ravel()),
                "vectors": pa.array(np.repeat(vectors[full], size)),
            }
        )

    sums = points.select("point").mapInArrow(run, SUMS)
    # At most clusters x components rows, whatever the vectors.
    whole = sums.groupBy("cluster", "place").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"),
        F.sum("vectors").alias("vectors"),
    )
    following = [list(c) for c in centroids]
    for row in whole.collect():
        following[row.cluster][row.place] = int(row.total) // row.vectors
    return following


def first_centroids(points: DataFrame, clusters: int = CLUSTERS) -> list[list[int]]:
    """The vectors whose ids have the smallest hashes."""
    name = F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = points.select(F.sha2(name, 256).alias("hash"), "point").orderBy("hash", "point")
    return [list(row.point) for row in rows.limit(clusters).collect()]


def clustered(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
) -> DataFrame:
    """Each usable vector with its cluster.

    ``vectors`` has vec_id and embedding. Returns vec_id, cluster, distance (squared),
    cluster_inertia and inertia (distances summed over the cluster and over all) and
    centroid (its components).
    """
    spark = prepare(vectors.sparkSession)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    work = Scratch(spark, "centroids")
    points = work.stored(whole_vectors(vectors, dimensions), "points")
    centroids = first_centroids(points, clusters)
    if not centroids:
        work.remove()
        return spark.createDataFrame([], RESULT.format(kind))
    for _ in range(rounds):
        centroids = moved(points, centroids)
    found = work.result(assigned(points, centroids))
    # One row for each cluster: no more than there are centroids.
    sums = found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")
    )
    totals = {row.cluster: int(row.total) for row in sums.collect()}
    table = spark.createDataFrame(
        [
            (number, _long(total), _long(sum(totals.values())), centroids[number])
            for number, total in totals.items()
        ],
        "cluster int, cluster_inertia long, inertia long, centroid array<long>",
    )
    return found.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )


def _long(value: int) -> int | None:
    return value if value < 1 << 63 else None
