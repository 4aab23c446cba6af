"""The classifier chain against dense Newton steps, and what its order is worth."""

import numpy as np

from cityflow.llm import toxicity


def newton(x, y, penalty):
    """Weights and intercept at the optimum of the mean loss and half the penalty times the squared weights."""
    x = np.column_stack((x, np.ones(len(x))))
    ridge = np.append(np.full(x.shape[1] - 1, penalty), 0)
    w = np.zeros(x.shape[1])
    for _ in range(200):
        p = 1 / (1 + np.exp(-x @ w))
        slope = x.T @ (p - y) / len(y) + ridge * w
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) / len(y) + np.diag(ridge + 1e-12), slope)
        w -= step / max(1.0, np.abs(step).max())
        if np.abs(slope).max() < 1e-12:
            break
    return w


def by_hand(x, targets, new):
    """Probabilities of ``new`` rows: models of all rows, fed in training by predictions out of fold."""

    def odds(p):
        p = np.clip(p, 1e-6, 1 - 1e-6)
        return np.log(p / (1 - p))

    def predict(rows, w):
        return 1 / (1 + np.exp(-(rows @ w[:-1] + w[-1])))

    fold = np.arange(len(x)) % toxicity.FOLDS
    seen, told = np.empty((len(x), 0)), np.empty((len(new), 0))
    for y in targets.T.astype(float):
        train, test = np.column_stack((x, odds(seen))), np.column_stack((new, odds(told)))
        held = np.empty(len(x))
        for k in range(toxicity.FOLDS):
            held[fold == k] = predict(train[fold == k], newton(train[fold != k], y[fold != k], toxicity.PENALTY))
        told = np.column_stack((told, predict(test, newton(train, y, toxicity.PENALTY))))
        seen = np.column_stack((seen, held))
    return told


def sparse(x):
    return [np.flatnonzero(row).tolist() for row in x]


def planted(n, rng, width=150, telling=50):
    """A category told by many rare words, and one that is it together with one word."""
    x = (rng.random((n, width)) < 0.014).astype(float)
    x[:, 0] = rng.random(n) < 0.5
    first = x[:, 1 : telling + 1].any(axis=1)
    return x, np.column_stack((first, first & (x[:, 0] > 0))).astype(int)


def test_chain_equals_dense_matrices():
    rng = np.random.default_rng(1)
    x, y = planted(240, rng, 40, 12)
    new, _ = planted(60, rng, 40, 12)
    vocabulary = {f"w{i}": i for i in range(x.shape[1])}
    found = toxicity.fit_chain(vocabulary, sparse(x), y).probabilities(sparse(new))
    assert np.abs(found - by_hand(x, y, new)).max() < 0.02


def test_a_later_category_gains_by_an_earlier_one():
    rng = np.random.default_rng(2)
    loss = {"chain": [], "alone": []}
    for _ in range(6):
        x, y = planted(500, rng)
        new, wanted = planted(3000, rng)
        vocabulary = {f"w{i}": i for i in range(x.shape[1])}
        for name, targets in (("chain", y), ("alone", y[:, 1:])):
            p = np.clip(toxicity.fit_chain(vocabulary, sparse(x), targets).probabilities(sparse(new))[:, -1], 1e-6, 1 - 1e-6)
            loss[name].append(-np.log(np.where(wanted[:, 1] == 1, p, 1 - p)).mean())
    assert np.mean(loss["chain"]) < np.mean(loss["alone"])


def test_words_are_read_as_the_chain_knows_them():
    chain = toxicity.Chain({"bad": 0, "^badl": 1, "word": 2}, [])
    assert chain.known(["Bad badly WORD.", "", None, "bad bad"]) == [[0, 1, 2], [], [], [0]]
