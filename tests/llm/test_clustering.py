"""Clustering against Lloyd's rounds in plain integers."""

import hashlib
import math

import numpy as np
import pytest

from cityflow.llm import clustering as c
from cityflow.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def whole(x):
    return math.floor(x * 64) if abs(x) < 2**53 else int(x) * 64


def expected(rows, k=16, rounds=3, dimensions=64):
    """vec_id, cluster, distance, cluster inertia, inertia and centroid of every vector kept."""
    rows = [
        (i, [whole(x) for x in v], v) for i, v, *_ in rows
        if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)
    ]
    hashed = sorted(rows, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[2]))
    centroids = [v for _, v, _ in hashed[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, w)), n) for n, w in enumerate(centroids))

    for _ in range(rounds):
        members = {}
        for _, v, _ in rows:
            members.setdefault(nearest(v)[1], []).append(v)
        centroids = [
            [sum(x) // len(members[n]) for x in zip(*members[n])] if n in members else w for n, w in enumerate(centroids)
        ]
    found = [(i, *nearest(v)) for i, v, _ in rows]
    within = {}
    for _, d, n in found:
        within[n] = within.get(n, 0) + d
    return sorted(
        ((i, n, d, within[n], sum(within.values()), ",".join(map(str, centroids[n]))) for i, d, n in found), key=str
    )


def result(frame):
    wanted = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
    return sorted((tuple(r[w] for w in wanted) for r in frame.collect()), key=str)


def test_edges(spark):
    """Also ties, repeated rows, a missing id, and vectors that take no part."""
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, [0.0, 0.0], 1), (2, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [0.5, 0.0], 1), (4, [-0.01, -1.5], None),
        (5, None, 1), (6, [], 1), (7, [1.0], 1), (8, [1.0, None], 1), (9, [inf, 1.0], 1), (10, [nan, 1.0], 1),
        (None, [3.0, 3.0], 1), (None, [2.0, -3.0], 1), (11, [1e-300, -1e-300], 1),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    for k in (1, 2, 3, 50):
        assert result(c.cluster(frame, k, 3, 2)) == expected(rows, k, 3, 2)
    more = spark.createDataFrame(
        [(*r, 1, "x", "y") for r in rows], SCHEMA + ", cluster int, far string, distance string"
    )
    assert result(c.cluster(more, 2, 3, 2)) == expected(rows, 2, 3, 2)
    assert c.cluster(frame.limit(0), 2, 3, 2).collect() == []
    assert c.cluster(frame.filter("vec_id = 5")).collect() == []


def test_components_beyond_64_bits(spark):
    rows = [(i, [x, y], 0) for i, (x, y) in enumerate([(1e300, 1.0), (1e300, 2.0), (-1.7e308, 5.0), (1.0, 2.0), (3e9, -3e9), (4.0, 2.0)])]
    found = result(c.cluster(spark.createDataFrame(rows, SCHEMA), 2, 2, 2))
    wanted = expected(rows, 2, 2, 2)

    def fits(x):
        return x if abs(x) < 2**63 else None

    assert [r[:3] for r in found] == sorted(((i, n, fits(d)) for i, n, d, *_ in wanted), key=str)
    assert {(r[0], r[5]) for r in found} == {(r[0], r[5]) for r in wanted}
    assert all(r[4] is None for r in found)


def test_copies_and_clusters(spark):
    """A third of the rows are one vector; tight clusters are told apart with few comparisons."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 64)) * 4
    rows = [(i, (centres[i % 12] + rng.normal(size=64) * 0.05).tolist(), 0) for i in range(400)]
    rows += [(1000 + i, rows[0][1], 0) for i in range(200)]
    found = c.cluster(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert result(found) == expected(rows)
    assert found.groupBy().avg("compared").first()[0] < 6


@pytest.mark.parametrize("spread", [0.0, 0.3, 30.0])
def test_bounds_are_below_the_distances(spread):
    rng = np.random.default_rng(int(spread * 10))
    rows = np.round(rng.normal(size=(300, 8)) * spread * 64).astype(np.int64) + rng.integers(-2, 2, (300, 8)) * 1000
    to = rows[::20]
    pivots = c.choose(rows[:100], to)
    low = pivots.bounds(pivots.far(rows), pivots.far(to))
    true = np.stack([c.squared(rows, t) for t in to], axis=1)
    assert (low <= true).all()
    chosen, best, compared = c.nearest(rows, pivots.far(rows), to, pivots)
    assert (chosen == true.argmin(axis=1)).all() and (best == true.min(axis=1)).all() and compared.max() <= len(to)


def test_limbs():
    for value in (0, -1, 2**59, -(2**61), 2**200 + 7, -(2**1030) - 3):
        assert sum(part << (60 * place) for place, part in enumerate(c.limbs(value))) == value
        assert all(-(2**63) <= part < 2**63 for part in c.limbs(value))


def test_registered_query_equals_plain_rounds(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    found = QUERIES["op13_centroid_clustering"](spark, sf_dir).collect()
    wanted = {r[0]: (*r[1:5], hashlib.sha256(r[5].encode()).hexdigest()) for r in expected(rows)}
    assert len(found) == len(wanted)
    assert all(tuple(r)[1:] == wanted[r["vec_id"]] for r in found)
