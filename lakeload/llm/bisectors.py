"""Centroid clustering by a bisector tournament, in integers.

Between two centroids a < b lies a bisector: x is nearer to b just where
``2 (b - a) . x > |b|^2 - |a|^2``. The normals and thresholds of all pairs are computed once a
round. A vector then meets k - 1 of them: the winner so far against the next centroid, and
zero leaves the smaller number in. All tests are exact, so no distances are compared; the
distance to the last winner is computed at the end, exactly.

Vectors are never shuffled. A round is one pass in which each task sums its vectors by
cluster; only those sums meet, added up before and after the shuffle.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved, unused

CLUSTERS = 16
ROUNDS = 3
DIMENSIONS = 64
SCALE = 64
SLICE_NUMBERS = 1 << 20  # components that a task works on at a time
LIMB_BITS = 32  # sums travel in pieces of so many bits
LAST = 2**63 - 1


def kept(vectors: str, dimensions: int) -> Column:
    """Whether a vector has that many components, none null, NaN or infinite."""
    whole = F.size(vectors) == dimensions
    x_fits = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(whole & F.forall(vectors, x_fits), F.lit(False))


def integers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of doubles: 64-bit integers, or Python's where those are too short."""
    scaled = np.floor(values * float(scale))
    if not values.size or np.abs(scaled).max() < 2.0**62:
        return scaled.astype(np.int64)
    # From 2^53 on a double is an integer, and its product may leave the doubles.
    exact = [int(x) * scale if abs(x) >= 2.0**53 else math.floor(x * scale) for x in values.ravel().tolist()]
    return np.array(exact, object).reshape(values.shape)


class Bisectors:
    """The normals and thresholds of all pairs of centroids; k * (k - 1) / 2 of them."""

    def __init__(self, centroids: list[list[int]]):
        self.centroids = np.array(centroids, object)
        self.dimensions = self.centroids.shape[1]
        self.reach = max((abs(c) for row in centroids for c in row), default=0)
        squares = [sum(c * c for c in row) for row in centroids]
        count = len(centroids)
        self.normals = np.zeros((count, count, self.dimensions), object)
        self.thresholds = np.zeros((count, count), object)
        for a in range(count):
            for b in range(a + 1, count):
                self.normals[a, b] = 2 * (self.centroids[b] - self.centroids[a])
                self.thresholds[a, b] = squares[b] - squares[a]
        if self._fits(self.reach):
            self.short = [part.astype(np.int64) for part in (self.normals, self.thresholds, self.centroids)]

    def _fits(self, reach: int) -> bool:
        """Whether sums of products with numbers up to this one stay within 64 bits."""
        return 8 * self.dimensions * max(reach, self.reach) ** 2 < 2**62

    def nearest(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid of each row, ties to the smaller number, and the squared distance."""
        reach = max(abs(int(numbers.max())), abs(int(numbers.min()))) if numbers.size else 0
        if self._fits(reach):
            normals, thresholds, centroids = self.short
            numbers = numbers.astype(np.int64)
        else:
            normals, thresholds, centroids = self.normals, self.thresholds, self.centroids
            numbers = numbers.astype(object)
        winners = np.zeros(len(numbers), np.int64)
        for challenger in range(1, len(centroids)):
            side = (numbers * normals[winners, challenger]).sum(axis=1) - thresholds[winners, challenger]
            winners = np.where(side > 0, challenger, winners)
        apart = numbers - centroids[winners]
        return winners, (apart * apart).sum(axis=1)


def _matrices(batch: pa.RecordBatch, dimensions: int, scale: int):
    """The second column as matrices of integers, some rows at a time."""
    step = max(SLICE_NUMBERS // max(dimensions, 1), 1)
    for start in range(0, len(batch), step):
        part = batch.slice(start, step)
        flat = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        yield part.column(0), integers(flat.reshape(len(part), dimensions), scale)


def limbs(value: int) -> list[int]:
    """Pieces of 32 bits, lowest first; the last one carries the sign."""
    pieces = []
    while not -(1 << LIMB_BITS - 1) <= value < 1 << LIMB_BITS - 1:
        pieces.append(value & (1 << LIMB_BITS) - 1)
        value >>= LIMB_BITS
    return [*pieces, value]


def _sums(centroids: list[list[int]], dimensions: int, scale: int):
    """A task's sums by cluster and component, in pieces, and the vectors (component -1)."""

    def run(batches):
        bisectors = Bisectors(centroids)
        totals = np.zeros((len(centroids), dimensions), object)
        counts = np.zeros(len(centroids), np.int64)
        for batch in batches:
            for _, numbers in _matrices(batch, dimensions, scale):
                winners, _ = bisectors.nearest(numbers)
                counts += np.bincount(winners, minlength=len(centroids))
                for cluster in np.unique(winners):
                    chosen = numbers[winners == cluster]
                    # A slice of 64-bit numbers may add up to more than 64 bits.
                    wide = chosen.dtype != object and np.abs(chosen).max(initial=0) >= 2**42
                    totals[cluster] += (chosen.astype(object) if wide else chosen).sum(axis=0)
        rows = [(c, -1, 0, int(n)) for c, n in enumerate(counts) if n]
        for c, *_ in list(rows):
            for at, total in enumerate(totals[c].tolist()):
                rows += [(c, at, limb, piece) for limb, piece in enumerate(limbs(int(total)))]
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        names = ["cluster", "component", "limb", "piece"]
        types = [pa.int32(), pa.int32(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return run


def _moved(vectors: DataFrame, centroids: list[list[int]], scale: int) -> list[list[int]]:
    """Every centroid that has vectors at the floor of their mean; the others as they are."""
    dimensions = len(centroids[0])
    pieces = vectors.mapInArrow(
        _sums(centroids, dimensions, scale), "cluster int, component int, limb int, piece long"
    )
    # Clusters times components rows, whatever the number of vectors.
    added = pieces.groupBy("cluster", "component", "limb").agg(F.sum("piece").alias("piece")).collect()
    totals: dict[tuple[int, int], int] = {}
    for row in added:
        at = (row.cluster, row.component)
        totals[at] = totals.get(at, 0) + (row.piece << LIMB_BITS * row.limb)
    return [
        [totals[c, i] // totals[c, -1] for i in range(dimensions)] if (c, -1) in totals else before
        for c, before in enumerate(centroids)
    ]


def _assigned(centroids: list[list[int]], scale: int):
    def run(batches):
        bisectors = Bisectors(centroids)
        for batch in batches:
            for ids, numbers in _matrices(batch, len(centroids[0]), scale):
                winners, distances = bisectors.nearest(numbers)
                if distances.dtype == object:
                    distances = np.array([min(d, LAST) for d in distances.tolist()], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(winners, pa.int32()), pa.array(distances, pa.int64())],
                    ["vec_id", "cluster", "distance"],
                )

    return run


def first_centroids(vectors: DataFrame, clusters: int, scale: int) -> list[list[int]]:
    """The vectors with the smallest hashes of their ids, in that order, as integers.

    Ties, of a repeated id, go by the vectors themselves; rows without an id come last.
    """
    hashed = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    order = [hashed.asc_nulls_last(), F.col("vector")]
    rows = vectors.orderBy(*order).limit(clusters).select("vector").collect()
    found = np.array([r.vector for r in rows], np.float64)
    return [list(map(int, row)) for row in integers(found, scale)]


def cluster(
    rows: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
) -> DataFrame:
    """One row for each vector taken part: its cluster and squared distance, with both inertias.

    ``rows`` has ``vec_id`` and ``embedding``, read once for the first centroids, once a round
    and once for the result; other columns are ignored, whatever their names. Vectors that are
    null, of another length, or hold null or non-finite components take no part and have no
    row. Repeated rows each count and have a row each; ids may be null or repeated. With fewer
    vectors than ``clusters`` each is a centroid; equal centroids lose to the smallest number.
    An empty table gives an empty result.

    Components of any size are carried exactly. A distance or an inertia beyond 64 bits is
    given as the last 64-bit integer. Tasks hold ``clusters ** 2 * dimensions`` integers.
    """
    chosen = rows.select("vec_id", F.col("embedding").alias("vector")).where(kept("vector", dimensions))
    result = "vec_id long, cluster int, distance long"
    centroids = first_centroids(chosen, clusters, scale)
    if not centroids:
        empty = rows.sparkSession.createDataFrame([], result)
        missing = F.lit(None).cast("long")
        return empty.select(
            "*", missing.alias("cluster_inertia"), missing.alias("inertia"),
            F.lit(None).cast("string").alias("centroid_sha256"),
        )
    for _ in range(rounds):
        centroids = _moved(chosen, centroids, scale)
    found = saved(chosen.mapInArrow(_assigned(centroids, scale), result), "clusters")

    held = F.sum(F.col("distance").cast("decimal(38,0)"))
    by_cluster = {r.cluster: int(r.held) for r in found.groupBy("cluster").agg(held.alias("held")).collect()}
    everything = min(sum(by_cluster.values()), LAST)
    # One row for each centroid.
    facts = [
        (
            number,
            min(by_cluster.get(number, 0), LAST),
            everything,
            hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest(),
        )
        for number, centroid in enumerate(centroids)
    ]
    own = unused("of", found.columns)
    named = rows.sparkSession.createDataFrame(
        facts, f"{own} int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return found.join(F.broadcast(named), F.col("cluster") == F.col(own)).drop(own)
