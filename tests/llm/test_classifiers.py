"""The toxicity chain and the site-aware quality classifier."""

import random

import numpy as np
import pytest

from cityflow.llm import logistic, quality, toxicity
from cityflow.llm.queries import QUERIES
from helpers import CLASHING, DOCUMENTS, EDGES, clashing, stored

WORDS = [f"{a}{b}{c}" for a in ("re", "to", "an", "li") for b in ("mo", "ta", "se") for c in ("n", "l", "rt", "st")]
BAD = ["vilegor", "vilebam", "snarkit"]


def corpus(n, seed=0, toxic=0.3, junk=0.3):
    """(doc_id, text, toxic, quality): toxic texts hold bad words, junk ones repeat or shout."""
    rng = random.Random(seed)
    for i in range(n):
        words = [rng.choice(WORDS) for _ in range(rng.randint(20, 60))]
        bad, low = rng.random() < toxic, rng.random() < junk
        if low:
            words = [w.upper() + "!!" for w in words] if rng.random() < 0.5 else [w for w in words for _ in range(4)]
        if bad:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        yield i, " ".join(words), int(bad), int(not low)


def frames(spark, tmp_path, rows, schema=DOCUMENTS, also=()):
    docs = [(i, t, "en", f"s{i % 3}", len(t)) for i, t, _, _ in rows] + list(also)
    labels = spark.createDataFrame([(i, q, x) for i, _, x, q in rows], "doc_id bigint, quality int, toxic int")
    return stored(spark, tmp_path, clashing(docs) if schema == CLASHING else docs, schema), labels


def test_logistic_regression_has_zero_gradient():
    rng = np.random.default_rng(0)
    rows = [np.flatnonzero(rng.random(12) < 0.3).tolist() for _ in range(400)]
    dense = rng.normal(size=(400, 2))
    x = logistic.Sparse(rows, 12, dense)
    full = np.zeros((400, 14))
    for i, r in enumerate(rows):
        full[i, r] = 1
    full[:, 12:] = dense
    w = rng.normal(size=14)
    assert np.allclose(x.times(w), full @ w) and np.allclose(x.back(full[:, 0]), full.T @ full[:, 0])
    y = (full @ w + rng.normal(size=400) > 0).astype(float)
    found = logistic.fit(x, y, 0.01, steps=500)
    residual = logistic.sigmoid(full @ found[:-1] + found[-1]) - y
    assert np.abs(full.T @ residual / 400 + 0.01 * found[:-1]).max() < 1e-4
    assert abs(residual.mean()) < 1e-4


def test_one_class_gives_a_constant():
    x = logistic.Sparse([[0], []], 1)
    assert logistic.fit(x, np.zeros(2), 0.1)[0] == 0


def test_chain_finds_toxic_texts_and_leaves_clean_ones(spark, tmp_path):
    rows = list(corpus(600))
    docs, labels = frames(spark, tmp_path, rows)
    chain = toxicity.learn(docs, labels)
    new = list(corpus(400, seed=9)) + [(400 + i, f"Ton {w}ish ret", 1, 1) for i, w in enumerate(BAD)]
    fresh, _ = frames(spark, tmp_path, new)
    found = {r["doc_id"]: r for r in toxicity.score(fresh, chain).collect()}
    assert [found[i]["rejected"] for i, _, _, _ in new] == [bool(x) for _, _, x, _ in new]
    assert len(chain.weights) == len(toxicity.CATEGORIES)
    # later models have one weight more per earlier category
    assert [len(w) - len(chain.vocabulary) - 1 for w in chain.weights] == [0, 1, 2]


def test_later_models_learn_from_predictions_out_of_fold(monkeypatch):
    """The column of an earlier category in training is none of the final model's own predictions."""
    rng = random.Random(1)
    rows = [[rng.randrange(5)] for _ in range(80)]
    y = np.array([[r[0] == 1, r[0] in (1, 2)] for r in rows], int)
    y[::7] = 1 - y[::7]
    seen = []
    fit = toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda x, *a: seen.append(x) or fit(x, *a))
    chain = toxicity.fit_chain({str(i): i for i in range(5)}, rows, y)
    own = toxicity.Chain(chain.vocabulary, chain.weights[:1]).probabilities(rows)[:, 0]
    used = logistic.sigmoid(seen[1 + toxicity.FOLDS].dense[:, 0])
    expected = np.empty(80)
    for k in range(toxicity.FOLDS):
        train, held = [i for i in range(80) if i % toxicity.FOLDS != k], [i for i in range(80) if i % toxicity.FOLDS == k]
        w = fit(logistic.Sparse([rows[i] for i in train], 5), y[train, 0].astype(float), toxicity.PENALTY)
        expected[held] = logistic.sigmoid(w[[rows[i][0] for i in held]] + w[-1])
    assert np.allclose(used, expected)
    assert not np.allclose(used, own)


@pytest.mark.parametrize("schema", [DOCUMENTS, CLASHING])
def test_edges_are_scored_and_kept(spark, tmp_path, schema):
    rows = [(1000 + i, t, x, q) for i, t, x, q in corpus(300)]
    docs, labels = frames(spark, tmp_path, rows, schema, EDGES)
    labels = labels.unionByName(spark.createDataFrame([(None, 1, 1), (5, None, None), (99999, 0, 1)], labels.schema))
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(ids, key=str) == sorted([r[0] for r in EDGES] + [i for i, _, x, _ in rows if not x], key=str)
    good = quality.keep_good(docs, labels)
    assert good.columns == docs.columns
    ids = [r["doc_id"] for r in good.collect()]
    assert {5, 6, 7} <= set(ids) and ids.count(7) == 2
    assert {i for i in ids if i and i >= 1000} == {i for i, _, _, q in rows if q}
    scored = quality.score(docs, quality.learn(docs, labels))
    assert scored.count() == len(EDGES) + len(rows)
    assert scored.filter("p_quality IS NULL OR isnan(p_quality)").count() == 0


def test_without_labels_everything_stays(spark, tmp_path):
    docs, labels = frames(spark, tmp_path, list(corpus(20)))
    for none in (labels.limit(0), labels.filter("toxic = 1 AND quality = 1")):
        assert toxicity.keep_clean(docs, none).count() == 20
        assert quality.keep_good(docs, none).count() == 20


def test_labels_without_a_document_take_no_place_in_the_sample(spark, tmp_path):
    rows = list(corpus(200))
    docs, labels = frames(spark, tmp_path, rows)
    absent = spark.range(1000, 2800).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS quality", "CAST(id % 2 AS int) AS toxic")
    labels = labels.unionByName(absent)
    for flag in ("toxic", "quality"):
        found = toxicity.sample_of(docs, labels, flag, 40).groupBy("y").count().collect()
        assert {r["y"]: r["count"] for r in found} == {0: 40, 1: 40}


def test_no_rows(spark, tmp_path):
    docs, labels = frames(spark, tmp_path, list(corpus(20)))
    empty = spark.createDataFrame([], DOCUMENTS)
    for step in (toxicity.keep_clean, quality.keep_good):
        assert step(empty, labels).count() == 0


def test_site_rates_equal_the_formulas(spark):
    rng = random.Random(2)
    rows = [
        (h, f"{h}/{p}", min(1.0, max(0.0, rng.gauss(0.5 + 0.1 * hash_ + 0.05 * p, 0.2))))
        for hash_, h in enumerate(("a", "b", "c", None)) for p in range(3) for _ in range(rng.randint(1, 60))
    ]
    found, rate = quality.site_rates(spark.createDataFrame(rows, "host string, path string, p_document double"))
    p = np.array([r[2] for r in rows])
    assert np.isclose(rate, p.mean())

    def prior(groups, parents):
        n = np.array([len(g) for g in groups], float)
        within = sum(((g - g.mean()) ** 2).sum() for g in groups) / (n.sum() - len(groups))
        between = sum(k * (g.mean() - m) ** 2 for k, g, m in zip(n, groups, parents))
        variance = (between - (len(groups) - 1) * within) / (n.sum() - (n**2).sum() / n.sum())
        return np.clip(rate * (1 - rate) / variance - 1, 1, quality.MOST_PRIOR) if variance > 0 else quality.MOST_PRIOR

    hosts = {h: np.array([x for a, _, x in rows if a == h]) for h in {r[0] for r in rows}}
    paths = {(a, b): np.array([x for c, d, x in rows if (c, d) == (a, b)]) for a, b in {r[:2] for r in rows}}
    k = prior(list(hosts.values()), [rate] * len(hosts))
    host_rate = {h: (v.sum() + k * rate) / (len(v) + k) for h, v in hosts.items()}
    m = prior(list(paths.values()), [hosts[a].mean() for a, _ in paths])
    path_rate = {(a, b): (v.sum() + m * host_rate[a]) / (len(v) + m) for (a, b), v in paths.items()}
    for r in found.collect():
        assert np.isclose(r["host_rate"], host_rate[r["host"]])
        assert np.isclose(r["path_rate"], path_rate[r["host"], r["path"]])


def test_sparse_sites_shrink_more():
    few = quality.prior_size(1000, 10, 100_000, 30, 150, 0.5)
    like = quality.prior_size(1000, 10, 100_000, 1, 150, 0.5)
    assert 1 <= few < like == quality.MOST_PRIOR
    assert quality.prior_size(0, 0, 0, 0, 0, 0.5) == quality.MOST_PRIOR


def test_registered_classifiers_agree_with_the_labels(spark):
    """On the benchmark tables, whose labels are all in the sample of the fit: accuracy in training."""
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    toxic = QUERIES["op2_toxicity_chain"](spark, sf_dir).join(labels, "doc_id")
    wrong = toxic.filter("rejected <> (toxic = 1)").count()
    assert wrong <= 0.02 * toxic.count()
    good = QUERIES["op3_quality_sites"](spark, sf_dir).join(labels, "doc_id")
    assert good.filter("kept <> (quality = 1)").count() <= 0.02 * good.count()
    assert QUERIES["op3_quality_sites"](spark, sf_dir).count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_held_out_accuracy(spark, monkeypatch):
    """Fitted to at most 1,000 labelled documents of either flag, told on all others."""
    sf_dir = "/root/testdata/sf0.1"  # held out: labels beyond the sample
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    for learn, score, flag, says in (
        (toxicity.learn, toxicity.score, "toxic", "rejected"), (quality.learn, quality.score, "quality", "kept"),
    ):
        sample = toxicity.sample_of(docs, labels, flag, 1000).select("doc_id")
        held = score(docs, learn(docs, labels, most=1000)).join(labels, "doc_id").join(sample, "doc_id", "left_anti")
        right, all_ = held.selectExpr(f"count_if({says} = ({flag} = 1))", "count(*)").first()
        assert all_ > 2000 and right / all_ >= 0.97
