"""Near-duplicate vectors through a pivot-permutation index.

1. Equal vectors of a label are one, with their number.
2. Pivots are reference points spread over a sample of the vectors (farthest first). The sample has at
   most ``SAMPLE`` vectors, taken by a hash; the number of pivots grows with the root of the number of
   vectors. Fitting is all the sample is for: every vector is indexed. Pivots inside a tight group are in
   an order near to random for its members, which then share too few. So pivots are tried on pairs around
   the sample's vectors (``trials``), and the last chosen, those inside groups, are given up until
   ``LEAST_RECALL`` of the pairs are candidates; with ``NEAREST`` pivots or fewer all pairs are compared.
3. A vector is described by its ``NEAREST`` nearest pivots, nearest first, and stands in the inverted
   lists of those pivots, per label. Two vectors that share ``SHARED`` pivots or more are candidates;
   the list of their first common pivot owns the pair. So a vector's last ``SHARED - 1`` pivots need no
   entry.
4. A list is dealt in blocks of about ``BLOCK`` vectors, and each pair of blocks is one group, so that no
   list, however long, meets in one task. Candidates are counted and verified by their cosine in double
   precision as products of matrices. A group gives each vector's number of links and the first vector it is
   connected with in the group, never the pairs.
5. Components follow from those ties.

Recall over random pairs at the threshold is 0.99 or more with these parameters (64 dimensions, up to
2,000 pivots), and groups of vectors near each other are held to the same by the trial; tests measure
both against brute force.

Defined cases: vectors that are null, empty or zero, or hold null or non-finite components, and vectors
without a label, link with nothing, nor do vectors of different lengths; repeated rows count as equal
vectors, also with the same vec_id; a null vec_id never names a component unless there is no other; no
rows give no rows; further columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityflow.llm.common import saved
from cityflow.llm.components import components

COSINE = 0.93
SAMPLE = 8192
NEAREST, SHARED = 8, 2
LEAST_PIVOTS, MOST_PIVOTS = 64, 4096
LEAST_RECALL = 0.99
TRIED, TRIAL_PAIRS, AROUND = 1024, 2048, 32
BLOCK = 384
LONG = 4 * BLOCK

_GROUP = ("label", "dim", "pivot", "second", "i", "j")
_LIST = ["label", "dim", "pivot"]
_FOUND = pa.schema([("node", pa.int64()), ("root", pa.int64()), ("links", pa.int64())])


def units(rows: np.ndarray) -> np.ndarray:
    """Rows of length one. They are first scaled by a power of two, which rounds nothing, so that squares of
    very large or small components stay in range."""
    largest = np.abs(rows).max(axis=1, initial=0)
    rows = np.ldexp(rows, -np.frexp(largest)[1][:, None])
    return rows / np.linalg.norm(rows, axis=1)[:, None]


def pivots_of(sample: np.ndarray, number: int) -> np.ndarray:
    """At most ``number`` unit vectors of the sample, each the one least like those before it."""
    sample = units(sample)
    chosen, likeness = [0], np.full(len(sample), -2.0)
    while len(chosen) < min(number, len(sample)):
        likeness = np.maximum(likeness, sample @ sample[chosen[-1]])
        chosen.append(int(likeness.argmin()))
    return sample[chosen]


def permutations(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The nearest pivots of each vector, nearest first; ties by number."""
    return np.argsort(-(units(vectors) @ pivots.T), axis=1, kind="stable")[:, :NEAREST].astype(np.int32)


def trials(sample: np.ndarray, cosine: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs that have to be found: linked ones of the sample, and for its vectors without a link a
    partner at the threshold, in the direction of one of the ``AROUND`` nearest vectors."""
    rng, sample = np.random.default_rng(0), units(sample)
    tried = rng.choice(len(sample), min(TRIED, len(sample)), replace=False)
    likeness = sample[tried] @ sample.T
    likeness[np.arange(len(tried)), tried] = -2
    i, j = np.nonzero(likeness >= cosine)
    drawn = rng.choice(len(i), min(TRIAL_PAIRS, len(i)), replace=False)
    linked = sample[tried[i[drawn]]], sample[j[drawn]]
    alone = np.flatnonzero(likeness.max(axis=1) < cosine)
    most = min(AROUND, len(sample) - 1)
    nearest = np.argpartition(-likeness[alone], most - 1, axis=1)[:, :most]
    own, other = sample[tried[alone]], sample[nearest[np.arange(len(alone)), rng.integers(0, most, len(alone))]]
    away = other - (other * own).sum(axis=1)[:, None] * own
    length = np.linalg.norm(away, axis=1)[:, None]
    apart = length[:, 0] > 1e-9  # an opposite vector shows no direction
    made = own[apart], cosine * own[apart] + np.sqrt(1 - cosine**2) * away[apart] / length[apart]
    return [pair for pair in (linked, made) if len(pair[0])]


def recall(pair: tuple[np.ndarray, np.ndarray], pivots: np.ndarray) -> float:
    """The share of the pairs that are candidates."""
    one, other = (permutations(vectors, pivots) for vectors in pair)
    return float(((one[:, :, None] == other[:, None, :]).sum(axis=(1, 2)) >= SHARED).mean())


def reliable(pivots: np.ndarray, sample: np.ndarray, cosine: float) -> np.ndarray:
    """The first pivots, as many as find the trial pairs; one, which all vectors share, if no more than ``NEAREST`` do."""
    pairs = trials(sample, cosine)
    while len(pivots) > NEAREST and any(recall(pair, pivots) < LEAST_RECALL for pair in pairs):
        pivots = pivots[: len(pivots) * 3 // 4]
    return pivots if len(pivots) > NEAREST else pivots[:1]


def checked(rows: DataFrame) -> DataFrame:
    """vec_id, label, v: the vector in double precision, null where it links with nothing."""
    return rows.selectExpr(
        "CAST(vec_id AS bigint) AS vec_id", "CAST(label AS bigint) AS label", "CAST(embedding AS array<double>) AS v"
    ).withColumn(
        "v",
        F.expr(
            "IF(label IS NOT NULL AND size(v) > 0 AND forall(v, x -> x IS NOT NULL AND abs(x) < double('inf'))"
            " AND exists(v, x -> x <> 0), v, NULL)"
        ),
    )


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def postings(vectors: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """node, label, dim, size, nearest (pivots, nearest first) and v. Without pivots for its length a
    vector gets pivot 0 alone, which every other one of that length has as well."""

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                near = permutations(matrix(part.column("v")), pivots[dim]) if dim in pivots else np.zeros((len(part), 1), np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in ("node", "label", "dim", "size")), pa.array(near.tolist(), pa.list_(pa.int32())), part.column("v")],
                    names=["node", "label", "dim", "size", "nearest", "v"],
                )

    return vectors.select("node", "label", "dim", "size", "v").mapInArrow(
        described, "node bigint, label bigint, dim int, size bigint, nearest array<int>, v array<double>"
    )


def spanning(near: np.ndarray) -> np.ndarray:
    """The first member of every member's component, for a symmetric boolean matrix."""
    root = np.arange(len(near))
    while True:
        low = np.minimum(root, np.where(near, root, len(near)).min(axis=1))
        low = low[low]
        if (low == root).all():
            return root
        root = low


def links_of_group(nodes, sizes, nearest, vectors, blocks, pivot: int, second: int, i: int, j: int, cosine: float):
    """node, root, links for the members of a pair of blocks of a list that link: one pivot's, or that of two."""
    needed = SHARED if len(nearest[0]) >= NEAREST else 1
    columns, place = np.unique(nearest, return_inverse=True)
    has = np.zeros((len(nodes), len(columns)), np.float32)
    np.put_along_axis(has, place.reshape(nearest.shape), 1, axis=1)
    # the list of a pair's first common pivot has it, or that of its first two
    lower = has[:, (columns < pivot) | (columns > pivot) & (columns < second)]
    near = (vectors @ vectors.T >= cosine) & (has @ has.T >= needed) & (lower @ lower.T == 0)
    near &= (blocks[:, None] != blocks[None, :]) if i != j else True
    np.fill_diagonal(near, False)
    linked = np.flatnonzero(near.any(axis=1))
    if not len(linked):
        return None
    near = near[np.ix_(linked, linked)]
    return nodes[linked], nodes[linked][spanning(near)], near @ sizes[linked]


def links(posted: DataFrame, cosine: float) -> DataFrame:
    """node, root, links per pair of blocks."""
    entries = posted.selectExpr(
        "*", f"explode(IF(size(nearest) < {NEAREST}, nearest, slice(array_sort(nearest), 1, {NEAREST - SHARED + 1}))) AS pivot"
    )
    lists = saved(entries.groupBy(*_LIST).agg(F.count("*").alias("n")).filter("n > 1"), "pivot-lists")
    # an overlong list is dealt by a second common pivot, where vectors have to share two
    seconds = f"IF(n > {LONG} AND size(nearest) >= {NEAREST}, filter(nearest, x -> x > pivot), array(-1))"
    listed = entries.join(lists, _LIST).selectExpr("*", f"explode({seconds}) AS second").drop("n")
    both = [*_LIST, "second"]
    blocks = saved(
        listed.groupBy(*both).agg(F.count("*").alias("n")).filter("n > 1").selectExpr(*both, f"CAST(ceil(n / {BLOCK}) AS int) AS blocks"),
        "pivot-blocks",
    )
    dealt = (
        listed.join(blocks, both)
        .withColumn("block", F.expr("CAST(pmod(xxhash64(node, pivot), blocks) AS int)"))
        .selectExpr("*", "explode(sequence(0, blocks - 1)) AS other")
        .selectExpr(
            *both, "least(block, other) AS i", "greatest(block, other) AS j",
            "node", "size", "nearest", "block", "v",
        )
        .repartition(*_GROUP)
        .sortWithinPartitions(*_GROUP)
    )

    def of_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(group: pa.Table):
            if len(group) < 2:
                return
            pivot, second, i, j = (group[name][0].as_py() for name in _GROUP[2:])
            found = links_of_group(
                group["node"].to_numpy(), group["size"].to_numpy(), matrix(group["nearest"].combine_chunks()),
                units(matrix(group["v"].combine_chunks())), group["block"].to_numpy(), pivot, second, i, j, cosine,
            )
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], schema=_FOUND)

        waiting = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if waiting is None else pa.concat_tables([waiting, rows])
            if not len(rows):
                continue
            keys = np.column_stack([rows[name].to_numpy() for name in _GROUP])
            edges = [0, *(np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1).tolist()]
            for start, end in zip(edges, edges[1:]):
                yield from result(rows.slice(start, end - start))
            waiting = rows.slice(edges[-1]).combine_chunks()
        if waiting is not None and len(waiting):
            yield from result(waiting)

    return dealt.mapInArrow(of_groups, "node bigint, root bigint, links bigint")


def near_duplicates(rows: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``rows`` (vec_id, embedding, label)."""
    given = checked(rows)
    distinct = saved(
        given.filter("v IS NOT NULL")
        .groupBy("label", "v")
        .agg(F.min("vec_id").alias("low"), F.count("*").alias("size"))
        .select("label", F.expr("size(v)").alias("dim"), "v", "low", "size", F.monotonically_increasing_id().alias("node")),
        "vectors",
    )
    # at most SAMPLE vectors of a length come to the driver
    pivots = {}
    for dim, number in distinct.groupBy("dim").agg(F.count("*").alias("n")).filter(f"n > {NEAREST}").collect():
        sample = distinct.filter(F.col("dim") == dim).orderBy(F.xxhash64("v"), "label").limit(SAMPLE).select("v").collect()
        vectors = np.array([row["v"] for row in sample])
        wanted = int(np.clip(4 * np.sqrt(number), LEAST_PIVOTS, MOST_PIVOTS))
        pivots[dim] = reliable(pivots_of(vectors, wanted), vectors, cosine)
    found = saved(links(postings(distinct, pivots), cosine), "vector-links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    member = saved(components(found.select("node", "root")), "vector-members")
    lows = member.join(distinct.select("node", "low"), "node").groupBy("root").agg(F.min("low").alias("component_low"))
    whole = saved(
        distinct.join(counts, "node", "left")
        .join(member.join(lows, "root").select("node", "component_low"), "node", "left")
        .selectExpr("label", "v", "coalesce(links, 0L) + size - 1 AS n_links", "coalesce(component_low, low) AS component_id"),
        "vector-components",
    )
    return (
        given.join(whole, ["label", "v"], "left")
        .selectExpr("vec_id", "coalesce(n_links, 0L) AS n_links", "coalesce(component_id, vec_id) AS component_id")
        .withColumn("kept", F.expr("vec_id <=> component_id"))
    )
