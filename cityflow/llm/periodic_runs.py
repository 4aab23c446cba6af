"""Detection of periodic runs of words, and their collapse to one period.

A run is a stretch of words with smallest period q, at least ``LEAST`` words and at least two periods
long, that no neighbouring word extends. Words q apart are equal along a diagonal of the text's
self-comparison, the one with lag q. An online dynamic programme goes over the words once: a word's
earlier occurrences are the lags that match there; a lag that matched at the word before as well adds to
its diagonal's length, one that did not starts a diagonal, and a diagonal that ends with sufficient
length emits its run at once. Only diagonals that are alive are held.

What counts as an occurrence of a word keeps this sparse. A run of at least ``LEAST`` words matches
along ``LEAST / 2`` words in a row or more, so a word is taken together with the ``LEAST / 2 - 1`` before
it; and as a run matches along q words in a row, lags from g to 2g are told by the last g words. Words are
numbered, and the last 2g of them are numbered by pairs of numbers of g, exactly. A text in which no stretch of
six words comes twice has no run and ends there. Inside a run that is known already, the occurrences one period
apart are stepped over in one go: lags between them are multiples of its period and end with it. So a text of one
repeated word costs a step per word and level, not one per pair of words. Runs of one phrase that come
again elsewhere in the text are compared word by word, within the lags of a level.

Defined cases: a null or empty text has no words, hence no runs, and collapses to an empty text; words are cut
at ASCII white space (space, tab, line feed, vertical tab, form feed, carriage return) alone; texts of any length
are taken whole, and one text is held by one task; repeated rows are returned each; a null ``doc_id`` is
returned as null; no rows give no rows; further columns are ignored.
"""

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

LEAST = 12

Words = list[bytes]


def numbered(words: Words) -> np.ndarray:
    """Equal words as equal numbers from 0."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Numbers of pairs of numbers, equal for equal pairs alone."""
    return np.unique(left * (int(right.max()) + 1) + right, return_inverse=True)[1].astype(np.int64)


def stretches(numbers: np.ndarray, length: int) -> np.ndarray:
    """Numbers of the stretches of that length, by their first word."""
    power, size = numbers, 1
    result, covered = None, 0
    while True:
        if length & size:
            result = power if result is None else joined(result[: len(power) - covered], power[covered:])
            covered += size
        if covered == length:
            return result
        power, size = joined(power[:-size], power[size:]), 2 * size


def earlier(grams: np.ndarray) -> np.ndarray:
    """The place of the last equal number before each place, or -1."""
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    found = np.full(len(grams), -1, np.int64)
    found[order[1:][same]] = order[:-1][same]
    return found


def sweep(grams: np.ndarray, size: int, low: int, high: int, known: dict, least: int, found: dict) -> None:
    """One pass over the words for the lags from ``low`` to below ``high``; adds to ``found``.

    ``grams`` numbers the stretches of ``size`` words by their first word. ``known``: runs by (start,
    length) with their period, of smaller lags. ``found`` keeps the smallest period of a stretch: a
    multiple of it is no period of its own.
    """
    before = earlier(grams)
    back = before.tolist()
    entry: dict[int, int] = {}
    start_of = np.full(len(grams), -1, np.int64)
    for (start, length), period in known.items():
        # a stretch of two periods or more stands in one run with that period at most
        if 2 * period <= size and length >= size + period:
            entry[start] = period
            start_of[start : start + length - size + 1] = start
    inside = start_of.tolist()

    def emit(lag: int, first: int, last: int) -> None:
        matched = last - first + size
        if matched >= lag and matched + lag >= least:
            stretch = (first - lag, matched + lag)
            found[stretch] = min(lag, found.get(stretch, lag))

    alive: dict[int, int] = {}
    previous = -2
    repeated = np.flatnonzero(before >= 0).tolist()
    for i in repeated:
        if alive and i != previous + 1:
            for lag, first in alive.items():
                emit(lag, first, previous)
            alive = {}
        lags: dict[int, int] = {}
        start = inside[i]
        j = back[i if start < 0 else start + (i - start) % entry[start]]
        while j >= 0 and i - j < high:
            if i - j >= low:
                lags[i - j] = alive.pop(i - j, i)
            j = back[j]
        for lag, first in alive.items():
            emit(lag, first, previous)
        alive, previous = lags, i
    for lag, first in alive.items():
        emit(lag, first, previous)


def runs_of(words: Words, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    n, size = len(words), max((least + 1) // 2, 1)
    if n < max(least, 2):
        return []
    found: dict[tuple[int, int], int] = {}
    grams = stretches(numbered(words), size)
    low, high = 1, max(2 * size, least - size + 1)
    while low <= n // 2:
        if int(grams.max()) + 1 == len(grams):
            break  # no stretch of this length comes twice, nor a longer one
        sweep(grams, size, low, min(high, n // 2 + 1), dict(found), least, found)
        if len(grams) <= size:
            break
        grams = joined(grams[:-size], grams[size:])
        size, low, high = 2 * size, high, 4 * size
    return sorted(((start, length, period) for (start, length), period in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words: Words, runs: list[tuple[int, int, int]]) -> Words:
    """The words that no run holds beyond its first period."""
    if not runs:
        return words
    stays = np.ones(len(words), bool)
    for start, length, period in runs:
        stays[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(stays).tolist()]


def with_tail(doc_id: int | None, words: Words) -> Words:
    """The words of a tenth of the documents, told by their id, with a periodic tail from a word on; the
    others', and those without an id, as they are."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def find_runs(
    docs: DataFrame, least: int = LEAST, prepare: Callable[[int | None, Words], Words] = lambda _, words: words
) -> DataFrame:
    """doc_id, runs (start, length and period of each, by start, then period) and the collapsed text of
    every row of ``docs`` (doc_id, text). ``prepare`` may change a document's words first."""
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(run)), ("text", pa.string())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, texts = [], []
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                # bytes.split() cuts at the six ASCII blanks and at nothing else
                words = prepare(doc_id.as_py(), (text.as_py() or b"").split())
                runs = runs_of(words, least)
                found.append([{"start": s, "length": n, "period": p} for s, n, p in runs])
                texts.append(b" ".join(collapsed(words, runs)).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, schema.field(1).type), pa.array(texts, pa.string())], schema=schema
            )

    bare = docs.selectExpr("CAST(doc_id AS bigint) doc_id", "CAST(text AS binary) text")
    return bare.mapInArrow(rows, "doc_id bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, text string")


def summary(found: DataFrame) -> DataFrame:
    """One row per row of :func:`find_runs`: how many runs, the longest one (of equal ones the first, then
    the one with the smallest period), and hashes of the list of runs and of the collapsed text."""
    longest = "array_max(transform(runs, r -> struct(r.length AS length, -r.start AS start, -r.period AS period)))"
    listed = "transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n'))"
    return found.selectExpr("*", f"{longest} AS top").selectExpr(
        "doc_id", "CAST(size(runs) AS bigint) AS n_runs", "-top.start AS start", "top.length AS length",
        "-top.period AS period", "1000 * top.length DIV -top.period AS exponent_milli",
        f"sha2(array_join({listed}, ''), 256) AS runs_sha256", "sha2(text, 256) AS collapsed_sha256",
    )
