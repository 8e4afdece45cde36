"""The tournament against plain distances, in Python integers."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from lakeload.llm import bisectors

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, clusters=16, rounds=3, dimensions=64, scale=64):
    kept = [
        (i, [math.floor(x * scale) if abs(x) < 2**53 else int(x) * scale for x in v])
        for i, v in rows
        if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:clusters]]

    def near(v):
        found = [(sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids)]
        return min(found)[::-1]

    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(near(v)[0], []).append(v)
        for n, vs in members.items():
            centroids[n] = [sum(column) // len(vs) for column in zip(*vs, strict=True)]
    out = [(i, *near(v)) for i, v in kept]
    last = 2**63 - 1
    held = Counter()
    for _, c, d in out:
        held[c] += d
    text = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    total = min(sum(held.values()), last)
    return Counter((i, c, min(d, last), min(held[c], last), total, text[c]) for i, c, d in out)


def got(frame):
    names = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return Counter(tuple(r[n] for n in names) for r in frame.collect())


@pytest.fixture(scope="module")
def draw():
    rng = np.random.default_rng(5)
    return lambda n, d=64: rng.normal(size=(n, d)).tolist()


def test_given_vectors(given):
    rows = [(r.vec_id, r.embedding) for r in given("embeddings").collect()]
    assert got(bisectors.cluster(given("embeddings"))) == brute(rows)


@pytest.mark.parametrize("clusters, rounds, dimensions", [(1, 2, 3), (5, 0, 2), (7, 4, 3), (40, 3, 2)])
def test_other_sizes(spark, draw, clusters, rounds, dimensions):
    rows = list(enumerate(draw(200, dimensions)))
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(5)
    found = bisectors.cluster(frame, clusters, rounds, dimensions, 8)
    assert got(found) == brute(rows, clusters, rounds, dimensions, 8)


def test_ties_go_to_the_smaller_number():
    both = bisectors.Bisectors([[0, 0], [2, 0], [0, 2], [0, 0]])
    winners, distances = both.nearest(np.array([[1, 1], [1, 0], [0, 0], [3, 3], [0, 1]]))
    assert winners.tolist() == [0, 0, 0, 1, 0] and distances.tolist() == [2, 1, 0, 10, 1]


def test_awkward_rows(spark, draw):
    whole = draw(6)
    rows = [(i, v) for i, v in enumerate(whole)]
    rows += [(0, whole[0]), (0, whole[1]), (None, whole[2]), (None, whole[2])]
    rows += [(20, None), (21, []), (22, whole[0][:63]), (23, [None, *whole[0][:63]])]
    rows += [(24, [float("nan"), *whole[0][:63]]), (25, [float("-inf"), *whole[0][:63]])]
    frame = spark.createDataFrame([(i, v, None) for i, v in rows], SCHEMA)
    for name in ("vector", "cluster", "distance", "of", "inertia"):
        frame = frame.selectExpr("*", f"'x' AS {name}")
    assert got(bisectors.cluster(frame)) == brute(rows)
    assert got(bisectors.cluster(frame.limit(0))) == Counter()
    assert bisectors.cluster(frame.limit(0)).columns == bisectors.cluster(frame).columns


def test_components_of_any_size_are_exact(spark, draw):
    rows = list(enumerate(draw(30)))
    for i, size in enumerate((1e7, 1e12, 1e18, 1e40, 1.7e308)):
        rows[i] = (i, [x * size if abs(x * size) < 1.7e308 else size for x in rows[i][1]])
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(3)
    assert got(bisectors.cluster(frame, 4)) == brute(rows, 4)


def test_limbs_add_up():
    for value in (0, 1, -1, 2**31, -(2**31), -(2**31) - 1, 2**200 + 17, -(2**90)):
        assert sum(p << 32 * i for i, p in enumerate(bisectors.limbs(value))) == value


