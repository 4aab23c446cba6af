"""Near-duplicate vectors against all pairs."""

import numpy as np
import pytest

from cityflow.llm import embedding_dedup as e
from cityflow.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def expected(rows):
    """(vec_id, n_links, component_id) by all pairs; rows stand for themselves."""
    valid = [
        i for i, (_, v, label) in enumerate(rows)
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)
    ]
    links, root = [0] * len(rows), list(range(len(rows)))
    for label in {(rows[i][2], len(rows[i][1])) for i in valid}:
        own = [i for i in valid if (rows[i][2], len(rows[i][1])) == label]
        x = e.units(np.array([rows[i][1] for i in own], np.float32).astype(float))
        near = x @ x.T >= e.COSINE
        np.fill_diagonal(near, False)
        first = e.spanning(near)
        for k, i in enumerate(own):
            links[i], root[i] = int(near[k].sum()), own[first[k]]
    low = {}
    for i, r in enumerate(root):
        low.setdefault(r, []).append(rows[i][0])
    low = {r: min((x for x in ids if x is not None), default=None) for r, ids in low.items()}
    return sorted(((rows[i][0], links[i], low[root[i]]) for i in range(len(rows))), key=str)


def result(frame):
    rows = frame.collect()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in rows)
    return sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in rows), key=str)


def around(rng, centre, n, cosine):
    """Vectors at that cosine from a centre."""
    noise = rng.normal(size=(n, len(centre)))
    noise -= (noise @ centre)[:, None] * centre
    return cosine * centre + np.sqrt(1 - cosine**2) * e.units(noise)


def test_edges(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [], 1),
        (7, [0.0, 0.0], 1), (8, [1.0, None], 1), (9, [inf, 1.0], 1), (10, [nan, 1.0], 1), (11, [1.0, 0.0, 0.0], 1),
        (12, [1.0, 0.1, 0.0], 1), (12, [1.0, 0.1, 0.0], 1), (13, [0.0, 1.0], 1), (14, [-0.0, 1.0], 1), (None, [0.0, 1.0], 1),
        (15, [3e38, 3e38], 3), (16, [3e38, 3e38], 3), (17, [1e-38, 1e-38], 3),
    ]
    assert result(e.near_duplicates(spark.createDataFrame(rows, SCHEMA))) == expected(rows)
    more = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA + ", node bigint, pivot int, v string")
    assert result(e.near_duplicates(more)) == expected(rows)
    assert e.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("block", [e.BLOCK, 16])
def test_clusters_and_a_hot_group(spark, monkeypatch, block):
    """A third of all vectors near one centre, copies of one vector, and lists of many blocks."""
    monkeypatch.setattr(e, "BLOCK", block)
    rng = np.random.default_rng(0)
    centres = e.units(rng.normal(size=(200, 64)))
    vectors = [around(rng, centres[0], 300, 0.99), np.repeat(centres[1:2], 40, axis=0), centres]
    vectors += [around(rng, c, 2, 0.97) for c in centres[2:100]]
    stacked = np.concatenate(vectors).astype(np.float32)
    rows = [(i, v.tolist(), int(i % 2)) for i, v in enumerate(stacked)]
    assert result(e.near_duplicates(spark.createDataFrame(rows, SCHEMA))) == expected(rows)


def test_recall_at_the_threshold(spark):
    """Pairs of random directions at a cosine just above the threshold are the hardest to retrieve."""
    rng = np.random.default_rng(1)
    centres = e.units(rng.normal(size=(1500, 64)))
    partners = np.concatenate([around(rng, c, 1, 0.932) for c in centres])
    rows = [(i, v.tolist(), 0) for i, v in enumerate(np.concatenate((centres, partners)).astype(np.float32))]
    wanted = sum(n for _, n, _ in expected(rows))
    found = sum(n for _, n, _ in result(e.near_duplicates(spark.createDataFrame(rows, SCHEMA))))
    assert wanted >= 3000 and 0.97 * wanted <= found <= wanted


@pytest.mark.parametrize("share", [0.6, 0.95, 1.0])
def test_recall_in_tight_groups(spark, monkeypatch, share):
    """Five tight groups and fewer other directions in the sample than pivots wanted."""
    monkeypatch.setattr(e, "SAMPLE", 512)
    rng = np.random.default_rng(3)
    n = 4000
    vectors = [around(rng, c, int(n * share) // 5, 0.95**0.5) for c in e.units(rng.normal(size=(5, 64)))]
    vectors.append(e.units(rng.normal(size=(n - int(n * share), 64))) if share < 1 else np.empty((0, 64)))
    rows = [(i, v.tolist(), 0) for i, v in enumerate(np.concatenate(vectors).astype(np.float32))]
    wanted = sum(links for _, links, _ in expected(rows))
    found = sum(links for _, links, _ in result(e.near_duplicates(spark.createDataFrame(rows, SCHEMA))))
    assert 0.98 * wanted <= found <= wanted


def test_pivots_are_spread():
    rng = np.random.default_rng(2)
    sample = np.concatenate((around(rng, np.eye(8)[0], 500, 0.999), np.eye(8)[1:]))
    pivots = e.pivots_of(sample, 8)
    assert (pivots @ pivots.T - np.eye(8)).max() < 0.2


def test_registered_query_equals_all_pairs(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert result(QUERIES["op1_embedding_near_dedup"](spark, sf_dir)) == expected(rows)


def test_overlong_lists_are_dealt_by_a_second_pivot(spark, monkeypatch):
    """The same links, whether lists are split by blocks alone or by a second pivot first."""
    rng = np.random.default_rng(8)
    centres = e.units(rng.normal(size=(150, 24)))
    rows = [(k, v.tolist(), 1) for k, v in enumerate(np.concatenate([around(rng, c, 6, 0.975) for c in centres]))]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(4)
    whole = result(e.near_duplicates(frame))
    monkeypatch.setattr(e, "LONG", 8)
    monkeypatch.setattr(e, "BLOCK", 16)
    assert result(e.near_duplicates(frame)) == whole
    assert sum(r[1] for r in whole) > 1000


def test_large_and_small_components(spark):
    rng = np.random.default_rng(9)
    one = e.units(rng.normal(size=(20, 8)))
    rows = []
    for k, v in enumerate(one):
        rows += [(2 * k, (v * 10.0 ** rng.integers(-300, 300)).tolist(), k), (2 * k + 1, (around(rng, v, 1, 0.95)[0] * 1e200).tolist(), k)]
    found = e.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")).collect()
    assert all(r["n_links"] == 1 and r["component_id"] == r["vec_id"] // 2 * 2 for r in found)


def test_every_length_has_pivots_of_its_own(spark, monkeypatch):
    """Also a length that a common sample would hardly hold."""
    made = []
    monkeypatch.setattr(e, "SAMPLE", 64)
    monkeypatch.setattr(e, "pivots_of", lambda sample, number, f=e.pivots_of: made.append(sample.shape) or f(sample, number))
    rng = np.random.default_rng(10)
    rows = [(k, rng.normal(size=6 if k % 40 == 0 else 12).tolist(), 1) for k in range(1600)]
    found = result(e.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")))
    assert sorted(made) == [(40, 6), (64, 12)] and len(found) == 1600
