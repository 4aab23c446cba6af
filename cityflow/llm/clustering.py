"""Centroid clustering of integer vectors with exact assignments, pruned by Ptolemaic pivots.

In Euclidean space Ptolemy's inequality gives, for a vector v, a centroid c and pivots p and q,

    d(v, c) >= |d(v, p) d(c, q) - d(v, q) d(c, p)| / d(p, q).

The distances of every vector to the pivots never change, so they are computed once and stored beside
the vectors; a round adds those of its few centroids. A centroid whose bound, rounded down by more
than floating point can err, lies above the smallest distance found is passed over; the others, the
survivors, are compared in whole numbers. Pruning therefore never changes a result.

A component x counts as ``floor(SCALE * x)``. The first centroids are the ``k`` vectors with the smallest
hash of ``<seed>:<vec_id>``. A round assigns every vector to its nearest centroid, the smaller number among
equals, and replaces a centroid by the rounded-down means of its vectors; one without vectors stays.
Tasks send sums of whole numbers, a row per cluster and component, so neither a large cluster nor copies
of one vector weigh on one task, and no order of tasks changes a digit.

Vectors about equally far from all centroids, as random ones in many dimensions are, leave no bound to
prune by and are compared with every centroid; vectors in clusters are compared with few.

Bounds: pivots are chosen from ``SAMPLE`` vectors (the first by the same hash); ``k`` centroids and their
sums are what the driver holds. Every vector is assigned.

Defined cases: a vector that is null, has another number of components, or holds a null or a non-finite
one is left out; of equal hashes (repeated ids) the smaller vector comes first, and rows without an id
come last; with fewer than ``k`` vectors there are as many centroids as vectors; repeated rows count
each; components beyond the range of 64-bit arithmetic are compared in Python's integers, and a distance
or a sum of them that does not fit into a long is null; no vectors give no rows; further columns are ignored.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityflow.llm.common import saved

K, ROUNDS, DIMENSIONS, SCALE = 16, 3, 64, 64.0
PIVOTS, PAIRS, SAMPLE = 16, 16, 512
# wider than the rounding of the few products, roots and quotients of a bound
_SLACK = 2.0**-46
_LIMB = 60
_LONG = 2**63


def kept(vectors: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """vec_id and embedding of the vectors that take part."""
    finite = "forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    return vectors.selectExpr("CAST(vec_id AS bigint) vec_id", "embedding").filter(
        f"embedding IS NOT NULL AND size(embedding) = {dimensions} AND {finite}"
    )


def reach(dimensions: int) -> int:
    """Components below this give squared distances below 2**62."""
    return 2 ** ((62 - max(dimensions - 1, 0).bit_length()) // 2 - 1)


def whole(rows: np.ndarray) -> np.ndarray:
    """``floor(SCALE * x)`` of every component; Python's integers where 64 bits might not do."""
    limit = reach(rows.shape[1])
    with np.errstate(over="ignore"):
        scaled = np.floor(rows * SCALE)
    if not rows.size or np.abs(scaled).max() < limit:
        return scaled.astype(np.int64)
    exact = np.empty(rows.shape, dtype=object)
    for at, x in np.ndenumerate(rows):
        # a double beyond 2**53 is a whole number
        exact[at] = int(x) * int(SCALE) if abs(x) > 2.0**53 else int(np.floor(x * SCALE))
    return exact


def squared(rows: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Squared distances of rows of whole numbers to one of them."""
    apart = rows - to
    return (apart * apart).sum(axis=1)


@dataclass
class Pivots:
    """Fixed points, the pairs of them that are used, and the pairs' distances."""

    points: np.ndarray
    pairs: list[tuple[int, int]]
    between: list[float]

    def far(self, rows: np.ndarray) -> np.ndarray:
        """Distances of rows to the points."""
        if not len(self.points):
            return np.zeros((len(rows), 0))
        return np.sqrt(np.stack([squared(rows, p) for p in self.points], axis=1).astype(np.float64))

    def bounds(self, rows: np.ndarray, to: np.ndarray) -> np.ndarray:
        """Squares that no squared distance between a row and a centroid is below, from their
        distances to the points; always rounded down."""
        best = np.zeros((len(rows), len(to)))
        for (i, j), d in zip(self.pairs, self.between):
            one, other = np.outer(rows[:, i], to[:, j]), np.outer(rows[:, j], to[:, i])
            np.maximum(best, (np.abs(one - other) - (one + other) * _SLACK) / d, out=best)
        return best * best * (1 - _SLACK)


def choose(sample: np.ndarray, centroids: np.ndarray, wanted: int = PIVOTS, pairs: int = PAIRS) -> Pivots:
    """Points far from each other, and the pairs of them that bound the sample's distances best."""
    if not len(sample) or sample.dtype == object:
        return Pivots(sample[:0], [], [])
    points = [sample[0]]
    nearest = squared(sample, points[0])
    while len(points) < wanted and nearest.max() > 0:
        points.append(sample[int(nearest.argmax())])
        nearest = np.minimum(nearest, squared(sample, points[-1]))
    found = Pivots(np.array(points), [], [])
    between = found.far(found.points)
    ranked = []
    if centroids.dtype != object:
        rows, to = found.far(sample), found.far(centroids)
        for i in range(len(points)):
            for j in range(i):
                one = Pivots(found.points, [(i, j)], [float(between[i, j])])
                ranked.append((-float(np.sqrt(one.bounds(rows, to)).mean()), i, j))
    found.pairs = [(i, j) for _, i, j in sorted(ranked)[:pairs]]
    found.between = [float(between[i, j]) for i, j in found.pairs]
    return found


def nearest(rows: np.ndarray, far: np.ndarray, centroids: np.ndarray, pivots: Pivots) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the nearest centroid, squared distance and number of centroids compared, per row."""
    k = len(centroids)
    if rows.dtype == object or centroids.dtype == object:
        apart = np.stack([squared(rows.astype(object), c) for c in centroids.astype(object)], axis=1)
        chosen = np.array([min(range(k), key=line.__getitem__) for line in apart], dtype=np.int64)
        return chosen, apart[np.arange(len(rows)), chosen], np.full(len(rows), k)
    low = pivots.bounds(far, pivots.far(centroids))
    first = low.argmin(axis=1)
    chosen = first.copy()
    apart = rows - centroids[chosen]
    best = (apart * apart).sum(axis=1)
    compared = np.ones(len(rows), dtype=np.int64)
    for c in range(k):
        survivors = np.flatnonzero((low[:, c] <= best) & (first != c))
        if not len(survivors):
            continue
        d = squared(rows[survivors], centroids[c])
        compared[survivors] += 1
        nearer = (d < best[survivors]) | ((d == best[survivors]) & (c < chosen[survivors]))
        chosen[survivors[nearer]], best[survivors[nearer]] = c, d[nearer]
    return chosen, best, compared


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def with_pivot_distances(vectors: DataFrame, pivots: Pivots, dimensions: int) -> DataFrame:
    """The vectors with their distances to the pivots."""
    kind = vectors.schema["embedding"].dataType.simpleString()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = whole(_matrix(batch.column(1), dimensions))
            # out of range: compared without bounds
            far = pivots.far(rows) if rows.dtype != object else np.zeros((len(rows), len(pivots.points)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(list(far), pa.list_(pa.float64()))], ["vec_id", "embedding", "far"]
            )

    return vectors.mapInArrow(measure, f"vec_id bigint, embedding {kind}, far array<double>")


def _assigned(batch: pa.RecordBatch, centroids: np.ndarray, pivots: Pivots) -> tuple:
    rows = whole(_matrix(batch.column(1), centroids.shape[1]))
    far = _matrix(batch.column(2), len(pivots.points))
    return (rows, *nearest(rows, far, centroids, pivots))


def limbs(value: int) -> list[int]:
    """``value`` as numbers that fit into a long: the sum of ``limb * 2**(60 * place)``."""
    parts = []
    while not -(2**_LIMB) < value < 2**_LIMB:
        parts.append(value & (2**_LIMB - 1))
        value >>= _LIMB
    return [*parts, value]


def moved(measured: DataFrame, centroids: np.ndarray, pivots: Pivots) -> np.ndarray:
    """The centroids after one round."""
    k, width = centroids.shape

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, width), dtype=object), [0] * k
        for batch in batches:
            rows, chosen, _, _ = _assigned(batch, centroids, pivots)
            for c in np.unique(chosen):
                own = rows[chosen == c]
                sums[c] += own.sum(axis=0).astype(object)
                counts[c] += len(own)
        found = [
            (c, slot, place, part)
            for c in range(k) if counts[c]
            for slot, value in enumerate((counts[c], *sums[c]))
            for place, part in enumerate(limbs(int(value)))
        ]
        columns = list(zip(*found)) or [()] * 4
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, kinds)], ["cluster", "slot", "place", "part"]
        )

    parts = (
        measured.mapInArrow(totals, "cluster int, slot int, place int, part bigint")
        .groupBy("cluster", "slot", "place")
        .agg(F.expr("sum(CAST(part AS DECIMAL(38,0))) AS part"))
    )
    sums: dict[int, list[int]] = {}
    for row in parts.collect():  # k * (components + 1) numbers
        sums.setdefault(row["cluster"], [0] * (width + 1))[row["slot"]] += int(row["part"]) << (_LIMB * row["place"])
    result = [[s // sums[c][0] for s in sums[c][1:]] if c in sums else centroids[c].tolist() for c in range(k)]
    return _numbers(result, width)


def _numbers(rows: list[list[int]], width: int) -> np.ndarray:
    small = all(abs(x) < reach(width) for row in rows for x in row)
    return np.array(rows, dtype=np.int64 if small else object).reshape(len(rows), width)


def assigned(measured: DataFrame, centroids: np.ndarray, pivots: Pivots) -> DataFrame:
    """vec_id, cluster, distance (squared) and the number of centroids compared, per vector."""
    schema = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64()), ("compared", pa.int32())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, chosen, best, compared = _assigned(batch, centroids, pivots)
            fits = best if best.dtype != object else [d if d < _LONG else None for d in best]
            columns = (batch.column(0), chosen, fits, compared)
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c).cast(f.type) for c, f in zip(columns, schema)], schema=schema
            )

    return measured.mapInArrow(rows, "vec_id bigint, cluster int, distance bigint, compared int")


def _total(column: str) -> str:
    return f"IF(count({column}) = count(*), try_sum({column}), NULL)"


def cluster(
    vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, seed: int = 1
) -> DataFrame:
    """One row per vector kept: vec_id, cluster, distance (squared), compared (centroids it was compared
    with at last), centroid (its components as decimal text, joined by commas), cluster_inertia, inertia."""
    spark = vectors.sparkSession
    rows = kept(vectors, dimensions)
    first = (
        rows.selectExpr("embedding", f"sha2(concat('{seed}:', CAST(vec_id AS STRING)), 256) AS h")
        .orderBy(F.col("h").asc_nulls_last(), "embedding")
        .limit(max(SAMPLE, k))
        .collect()
    )
    if not first:
        return spark.createDataFrame(
            [], "vec_id bigint, cluster int, distance bigint, compared int, centroid string, cluster_inertia bigint, inertia bigint"
        )
    sample = np.array([r["embedding"] for r in first], dtype=np.float64).reshape(len(first), dimensions)
    centroids = _numbers(whole(sample[:k]).tolist(), dimensions)
    within = np.abs(sample).max(axis=1, initial=0) < reach(dimensions) / SCALE - 1
    pivots = choose(whole(sample[within]), centroids)
    measured = saved(with_pivot_distances(rows, pivots, dimensions), "pivot-distances")
    for _ in range(rounds):
        centroids = moved(measured, centroids, pivots)
    found = saved(assigned(measured, centroids, pivots), "clusters")
    each = found.groupBy("cluster").agg(F.expr(f"{_total('distance')} AS cluster_inertia"))
    inertias = {r["cluster"]: r["cluster_inertia"] for r in each.collect()}  # k rows
    whole_sum = None if None in inertias.values() else sum(inertias.values())
    summary = [
        (c, ",".join(str(x) for x in centroids[c].tolist()), inertias[c], whole_sum if whole_sum is None or whole_sum < _LONG else None)
        for c in inertias
    ]
    totals = spark.createDataFrame(summary, "cluster int, centroid string, cluster_inertia bigint, inertia bigint")
    return found.join(F.broadcast(totals), "cluster").select(
        "vec_id", "cluster", "distance", "compared", "centroid", "cluster_inertia", "inertia"
    )

