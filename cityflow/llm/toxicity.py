"""Toxicity by a classifier chain.

Categories are predicted one after the other. Each category has a linear model over the document's
features and the probabilities of the categories before it. In training those probabilities are
predictions out of fold, so a later model sees them as imperfect as they will be; in scoring they come
from the earlier models, fitted to the whole sample.

The labels hold one flag, so the chain's earlier categories are read off the labelled texts: `insult`
(toxic, with a term that is found in toxic texts only, by counts), `severe` (with three such terms or
more), then `toxic`, the flag itself, which decides.

Features are the distinct words of a text, and their proper beginnings of four to eight letters, which
stand for inflected and compound forms. Those that tell toxic from other texts best (likelihood ratio of their document
counts) are the vocabulary. Fitting uses a sample of labelled documents, at most ``SAMPLE`` of either
flag, in the order of a hash of the id; the vocabulary has at most ``FEATURES`` entries. Those are the
only bounds: every document is scored over its whole text.

Defined cases: a null or empty text has no features and scores as such; labels that are null or whose
document is missing are ignored, of several labels for an id the largest counts; without labels of
both flags nothing can be learned, all probabilities are 0 and every document is kept; repeated rows
are scored each; further columns are ignored.
"""

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityflow.llm.common import columns_of, per_batch, saved
from cityflow.llm.logistic import Sparse, fit, logit, sigmoid

SAMPLE = 4000
FEATURES = 2000
FOLDS = 4
PENALTY = 2e-4
LEAST_DOCUMENTS = 4
STRONG_TERMS = 3
CATEGORIES = ("insult", "severe", "toxic")
REJECT = 0.5
CACHED_WORDS = 500_000
_LETTERS = re.compile(r"[^\W\d_]+")
_BEGINNINGS = (4, 5, 6, 7, 8)


def features_of(chunk: str) -> list[str]:
    """Words in a piece of lower-case text without white space, and their beginnings."""
    found = []
    for word in _LETTERS.findall(chunk):
        found.append(word)
        found += ["^" + word[:k] for k in _BEGINNINGS if len(word) > k]
    return found


def features(text: str | None) -> set[str]:
    return {f for chunk in set((text or "").lower().split()) for f in features_of(chunk)}


@dataclass
class Chain:
    """A fitted chain: vocabulary, and per category its weights over features, earlier categories, intercept."""

    vocabulary: dict[str, int]
    weights: list[np.ndarray]

    def known(self, texts: Sequence[str | None]) -> list[list[int]]:
        """The vocabulary entries present in each text."""
        ids = self.__dict__.setdefault("_ids", {})

        def of(chunk: str) -> tuple[int, ...]:
            if len(ids) >= CACHED_WORDS:
                ids.clear()
            found = ids[chunk] = tuple(i for f in features_of(chunk) if (i := self.vocabulary.get(f)) is not None)
            return found

        rows = []
        for text in texts:
            present: set[int] = set()
            for chunk in set((text or "").lower().split()):
                entries = ids.get(chunk)
                if entries is None:
                    entries = of(chunk)
                if entries:
                    present.update(entries)
            rows.append(sorted(present))
        return rows

    def probabilities(self, rows: list[list[int]]) -> np.ndarray:
        """One column per category, in the chain's order."""
        if not self.weights:
            return np.zeros((len(rows), len(CATEGORIES)))
        earlier = np.empty((len(rows), 0))
        for w in self.weights:
            x = Sparse(rows, len(self.vocabulary), logit(earlier))
            earlier = np.column_stack((earlier, sigmoid(x.times(w[:-1]) + w[-1])))
        return earlier


def fit_chain(vocabulary: dict[str, int], rows: list[list[int]], targets: np.ndarray) -> Chain:
    """``targets``: one 0/1 column per category, in the chain's order."""
    n, width = len(rows), len(vocabulary)
    fold = np.arange(n) % FOLDS
    earlier = np.empty((n, 0))
    weights = []
    for y in targets.T.astype(float):
        weights.append(fit(Sparse(rows, width, logit(earlier)), y, PENALTY))
        held_out = np.empty(n)
        for k in range(FOLDS):
            seen, unseen = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
            w = fit(Sparse([rows[i] for i in seen], width, logit(earlier[seen])), y[seen], PENALTY)
            x = Sparse([rows[i] for i in unseen], width, logit(earlier[unseen]))
            held_out[unseen] = sigmoid(x.times(w[:-1]) + w[-1])
        earlier = np.column_stack((earlier, held_out))
    return Chain(vocabulary, weights)


def sample_of(docs: DataFrame, labels: DataFrame, flag: str, most: int) -> DataFrame:
    """doc_id, text and y of at most ``most`` labelled documents of either flag; exact copies once."""
    present = docs.selectExpr("CAST(doc_id AS bigint) AS doc_id").filter("doc_id IS NOT NULL").distinct()
    known = (
        labels.selectExpr("CAST(doc_id AS bigint) AS doc_id", f"CAST({flag} AS int) AS y")
        .filter("doc_id IS NOT NULL AND y IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
        .join(present, "doc_id", "left_semi")
    )
    order = F.xxhash64("doc_id")
    taken = known.filter("y = 1").orderBy(order, "doc_id").limit(most).unionByName(
        known.filter("y = 0").orderBy(order, "doc_id").limit(most)
    )
    # at most 2 * most rows of two numbers
    found = docs.selectExpr("CAST(doc_id AS bigint) AS doc_id", "text").join(F.broadcast(taken), "doc_id")
    return saved(found.groupBy(F.sha2(F.coalesce("text", F.lit("")), 256).alias("same")).agg(
        F.min("doc_id").alias("doc_id"), F.first("text").alias("text"), F.max("y").alias("y")
    ).drop("same"), "labelled-sample")


def vocabulary_of(sample: DataFrame) -> tuple[dict[str, int], set[str]]:
    """The features that tell the flags apart best, and those among them found in toxic texts only."""
    schema = pa.schema([("feature", pa.string()), ("toxic", pa.int64()), ("other", pa.int64())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())
        for batch in batches:
            for text, y in zip(*columns_of(batch, "text", "y")):
                counts[1 - y].update(features(text))
        names = list(counts[0] | counts[1])
        for at in range(0, len(names), 10_000):
            part = names[at : at + 10_000]
            yield pa.RecordBatch.from_pydict(
                {"feature": part, "toxic": [counts[0][f] for f in part], "other": [counts[1][f] for f in part]}, schema
            )

    size = {row["y"]: row["count"] for row in sample.groupBy("y").count().collect()}
    if len(size) < 2:
        return {}, set()
    counts = (
        sample.mapInArrow(counted, "feature string, toxic bigint, other bigint")
        .groupBy("feature")
        .agg(F.sum("toxic").alias("a"), F.sum("other").alias("b"))
        .filter(f"a + b >= {LEAST_DOCUMENTS}")
    )
    n1, n0 = size[1], size[0]

    def term(observed: str, expected: str) -> str:
        return f"IF({observed} > 0, {observed} * ln({observed} / ({expected})), 0)"

    share = f"((a + b) / {n1 + n0})"
    ratio = " + ".join(
        (
            term("a", f"{n1} * {share}"), term("b", f"{n0} * {share}"),
            term(f"({n1} - a)", f"{n1} * (1 - {share})"), term(f"({n0} - b)", f"{n0} * (1 - {share})"),
        )
    )
    best = counts.selectExpr("feature", "a", "b", f"{ratio} AS ratio").orderBy(F.desc("ratio"), "feature").limit(FEATURES).collect()
    only = {row["feature"] for row in best if row["b"] == 0 and row["a"] >= 0.01 * n1}
    return {row["feature"]: i for i, row in enumerate(best)}, only


def learn(docs: DataFrame, labels: DataFrame, flag: str = "toxic", most: int = SAMPLE) -> Chain:
    """Fit the chain to at most ``2 * most`` labelled documents; only their vocabulary entries leave the executors."""
    sample = sample_of(docs, labels, flag, most)
    vocabulary, only = vocabulary_of(sample)
    if not vocabulary:
        return Chain({}, [])
    reader = Chain(vocabulary, [])
    schema = pa.schema([("doc_id", pa.int64()), ("y", pa.int32()), ("ids", pa.list_(pa.int32()))])

    def columns(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column("doc_id"), "y": batch.column("y"), "ids": reader.known(columns_of(batch, "text")[0])}

    rows = sample.mapInArrow(per_batch(columns, schema), "doc_id bigint, y int, ids array<int>").collect()
    rows.sort(key=lambda row: row["doc_id"])
    y = np.array([row["y"] for row in rows])
    ids = [list(row["ids"]) for row in rows]
    # a word and its beginnings are one term
    word = {i for f, i in vocabulary.items() if f in only and not f.startswith("^")}
    start = {i for f, i in vocabulary.items() if f in only and f.startswith("^") and len(f) == _BEGINNINGS[0] + 1}
    terms = np.array([max(len(word.intersection(r)), len(start.intersection(r))) for r in ids])
    return fit_chain(vocabulary, ids, np.column_stack((y * (terms > 0), y * (terms >= STRONG_TERMS), y)))


def score(docs: DataFrame, chain: Chain, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns of ``keep`` (strings or bigints), one probability per category, and rejected."""
    names = [f"p_{c}" for c in CATEGORIES]
    frame = docs.selectExpr("CAST(doc_id AS bigint) doc_id", *keep, "text")
    out = frame.drop("text").withColumns({n: F.lit(0.0) for n in names}).withColumn("rejected", F.lit(False)).schema
    kinds = {"string": pa.string(), "bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}
    arrow = pa.schema([(f.name, kinds[f.dataType.simpleString()]) for f in out])

    def columns(batch: pa.RecordBatch) -> dict:
        p = chain.probabilities(chain.known(columns_of(batch, "text")[0]))
        return (
            {name: batch.column(name) for name in ("doc_id", *keep)}
            | {name: pa.array(p[:, i]) for i, name in enumerate(names)}
            | {"rejected": pa.array(p[:, -1] >= REJECT)}
        )

    return frame.mapInArrow(per_batch(columns, arrow), out)


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with its columns; one pass, nothing is shuffled."""
    chain = learn(docs, labels)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = chain.probabilities(chain.known(columns_of(batch, "text")[0]))
            yield batch.filter(pa.array(p[:, -1] < REJECT))

    return docs.mapInArrow(clean, docs.schema)
