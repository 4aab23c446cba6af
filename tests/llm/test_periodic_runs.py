"""Periodic runs against a search over all periods."""

import hashlib
import random
import zlib

import pytest

from cityflow.llm import periodic_runs as p
from cityflow.llm.queries import QUERIES
from helpers import CLASHING, DOCUMENTS, EDGES, LONG, clashing, stored


def smallest_period(words):
    """By the longest border."""
    border = [0] * len(words)
    k = 0
    for i in range(1, len(words)):
        while k and words[i] != words[k]:
            k = border[k - 1]
        k += words[i] == words[k]
        border[i] = k
    return len(words) - border[-1]


def expected(words, least=12):
    """Every stretch that cannot be extended with its period, kept if the period is its smallest one."""
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = q
        while i < n:
            first = i
            while i < n and words[i] == words[i - q]:
                i += 1
            start, length = first - q, i - first + q
            if length >= max(least, 2 * q) and smallest_period(words[start : start + length]) == q:
                found.append((start, length, q))
            i += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("least", [2, 7, 12])
def test_random_words(least):
    rng = random.Random(least)
    for _ in range(400):
        n = rng.randint(0, 70)
        words = [b"%d" % rng.randrange(rng.choice((1, 2, 3))) for _ in range(n)]
        if rng.random() < 0.6 and n:
            a = rng.randrange(n)
            q = rng.randint(1, max(1, (n - a) // 2))
            words = words[:a] + [words[a + i % q] for i in range(n - a)]
        if rng.random() < 0.4:
            words = words + words[: rng.randint(0, n)] + words
        assert p.runs_of(words, least) == expected(words, least)


def test_long_repetitions():
    block = [b"a"] * 40 + [b"b"]
    for words in (block * 9 + [b"c"] + block * 4, [b"x%d" % (i % 313) for i in range(1500)], [b"a"] * 3000):
        assert p.runs_of(words) == expected(words)
    words = LONG.encode().split()
    assert p.runs_of(words) == [(0, len(words), 2 * 977 * 13)]
    assert len(p.collapsed(words, p.runs_of(words))) == 2 * 977 * 13


def test_a_run_is_collapsed_to_its_first_period():
    words = [b"%d" % (i % 5) for i in range(17)]
    runs = p.runs_of([b"x", *words, b"y"])
    assert runs == [(1, 17, 5)]
    assert p.collapsed([b"x", *words, b"y"], runs) == [b"x", *words[:5], b"y"]
    assert p.runs_of(words[:11]) == []


def by_hand(doc_id, text, tail=False):
    words = (text or "").encode().split()
    if tail:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            q = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % q] for i, w in enumerate(words)]
    runs = p.runs_of(words) if len(words) > 400 else expected(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return runs, b" ".join(w for i, w in enumerate(words) if i not in gone)


def test_rows_of_edges(spark, tmp_path):
    rows = [*EDGES, (40, "la " * 20, "en", "a", 1), (41, "a b\x1cc " * 14 + "\v\f x", "en", "a", 1), (41, "la " * 20, "en", "a", 1)]
    wanted = sorted(((r[0], by_hand(*r[:2])) for r in rows), key=str)
    for docs in (stored(spark, tmp_path, rows), spark.createDataFrame(clashing(rows), CLASHING)):
        found = p.find_runs(docs).collect()
        assert sorted(((r["doc_id"], ([tuple(x) for x in r["runs"]], r["text"].encode())) for r in found), key=str) == wanted
    renamed = spark.createDataFrame([(1, "a b", 2, "x")], "doc_id int, text string, runs int, top string")
    assert p.summary(p.find_runs(renamed)).first()["n_runs"] == 0
    assert p.find_runs(spark.createDataFrame([], DOCUMENTS)).collect() == []


def test_of_equal_runs_the_first_is_the_longest(spark):
    text = "a b " * 7 + "x " + "c d " * 7 + "y " + "e " * 12
    row = p.summary(p.find_runs(spark.createDataFrame([(1, text)], "doc_id bigint, text string"))).first()
    assert (row["n_runs"], row["start"], row["length"], row["period"], row["exponent_milli"]) == (3, 0, 14, 2, 7000)


def test_registered_query_equals_the_search(spark, sf_dir):
    docs = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    found = QUERIES["op11_periodic_runs"](spark, sf_dir).collect()
    assert len(found) == len(docs) and any(r["n_runs"] for r in found)
    for r in found:
        runs, text = by_hand(r["doc_id"], docs[r["doc_id"]], tail=True)
        top = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
        milli = 1000 * top[1] // top[2] if runs else None
        assert (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"]) == (len(runs), *top, milli)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(text).hexdigest()
