"""Document quality by hierarchical empirical Bayes.

1. Evidence. A logistic model over features of style gives every document the probability of good
   quality. It is fitted to at most ``SAMPLE`` labelled documents of either kind.
2. Sites. The probabilities are summed per path (a host's section) and host. Between-group variance,
   by the method of moments, says how much hosts differ from the whole and paths from their host; its
   ratio to the within-group variance is the number of documents the prior is worth. A host's rate is
   shrunk towards the global one by that number, a path's towards its host's: sites with few documents
   stay near the prior, large ones near their own mean.
3. Combination. The classifier's odds, which stand for the global rate, are multiplied with the ratio
   of the path's odds to the global odds.

Only sums per group are shuffled, combined before the shuffle, so a host with most documents is one
partial row per task.

Defined cases: a null or empty text has the features of no words; a null host or path is a group of its
own; labels as for toxicity; without labels of both kinds the evidence is even, all probabilities are
0.5 and every document is kept; repeated rows are scored, and counted, each; further columns are ignored.
"""

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityflow.llm.common import columns_of, located, per_batch, saved
from cityflow.llm.logistic import Sparse, fit, sigmoid
from cityflow.llm.toxicity import sample_of

SAMPLE = 4000
PENALTY = 1e-4
KEEP = 0.5
MOST_PRIOR = 1e6
HOST, PATH = "source", "concat_ws('/', source, lang)"
_PLAIN_MARKS = re.compile(r"[^\w\s.,;:'\"()?-]")
_CAPITALS = re.compile(r"[A-ZÀ-ÖØ-Þ]{2}")


def style(text: str | None) -> list[float]:
    """Features of a text that do not depend on its words' meaning. Shares enter by their root, so
    that a short passage of junk in a long text still shows."""
    words = (text or "").split()
    n = len(words)
    if not n:
        return [0.0] * 12
    chars = sum(map(len, words))
    marked = sum(len(w) > 1 and not w[-2].isalnum() and not w[-1].isalnum() for w in words)
    bare = sum(not any(map(str.isalnum, w)) for w in set(words))
    shares = [
        sum(map(str.isupper, words)) / n,
        marked / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        words.count("|") / n,
        len(_PLAIN_MARKS.findall(text)) / chars,
        len(_CAPITALS.findall(text)) * 2 / chars,
        1 - len(set(words)) / n,
        bare / n,
        sum(map(str.isdigit, words)) / n,
    ]
    return [np.sqrt(s) for s in shares] + [shares[2], np.log1p(n) / 10, min(chars / n, 30) / 10]


@dataclass
class Style:
    """Centre and scale of the features, and the model's weights with the intercept last."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        if self.weights is None or not texts:
            return np.full(len(texts), 0.5)
        z = (np.array([style(t) for t in texts]) - self.centre) / self.scale
        return sigmoid(z @ self.weights[:-1] + self.weights[-1])


def learn(docs: DataFrame, labels: DataFrame, flag: str = "quality", most: int = SAMPLE) -> Style:
    """Fit the style model; the features of at most ``2 * most`` documents come to the driver."""
    schema = pa.schema([("doc_id", pa.int64()), ("y", pa.int32()), ("x", pa.list_(pa.float64()))])

    def columns(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column("doc_id"), "y": batch.column("y"), "x": [style(t) for t in columns_of(batch, "text")[0]]}

    sample = sample_of(docs, labels, flag, most)
    rows = sample.mapInArrow(per_batch(columns, schema), "doc_id bigint, y int, x array<double>").collect()
    rows.sort(key=lambda row: row["doc_id"])
    y = np.array([row["y"] for row in rows], float)
    if len(np.unique(y)) < 2:
        return Style(np.zeros(12), np.ones(12), None)
    x = np.array([row["x"] for row in rows])
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    return Style(centre, scale, fit(Sparse([[]] * len(x), 0, (x - centre) / scale), y, PENALTY, steps=300))


def prior_size(total: float, groups: float, squares: float, between: float, within: float, rate: float) -> float:
    """How many documents the parent's rate is worth, by the method of moments.

    Over the groups of a parent level: documents in all, number of groups, sum of squared group sizes,
    and the sums of squares between and within groups. Few or like groups make the prior strong.
    """
    spread = total - squares / total if total else 0.0
    if groups < 2 or spread <= 0 or total <= groups:
        return MOST_PRIOR
    variance = (between - (groups - 1) * within / (total - groups)) / spread
    if variance <= 0:
        return MOST_PRIOR
    return float(np.clip(rate * (1 - rate) / variance - 1, 1, MOST_PRIOR))


def site_rates(scored: DataFrame) -> tuple[DataFrame, float]:
    """host, path, host_rate, path_rate of every path, and the global rate, from (host, path, p_document)."""
    sums = [F.count("*").alias("n"), F.sum("p_document").alias("s"), F.sum(F.expr("p_document * p_document")).alias("q")]
    paths = saved(scored.groupBy("host", "path").agg(*sums), "quality-paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"), F.sum("q").alias("hq"))
    whole = hosts.agg(F.sum("hn"), F.sum("hs")).first()
    if not whole[0]:
        return paths.selectExpr("host", "path", "CAST(0.5 AS double) host_rate", "CAST(0.5 AS double) path_rate"), 0.5
    rate = float(np.clip(whole[1] / whole[0], 1e-6, 1 - 1e-6))

    def moments(frame: DataFrame, n: str, s: str, q: str, parent: str) -> tuple:
        return frame.selectExpr(
            f"CAST(sum({n}) AS double)", "CAST(count(*) AS double)", f"CAST(sum(CAST({n} AS double) * {n}) AS double)",
            f"sum({n} * power({s} / {n} - ({parent}), 2))", f"sum({q} - {s} * {s} / {n})",
        ).first()

    host_prior = prior_size(*moments(hosts, "hn", "hs", "hq", str(rate)), rate)
    both = paths.join(hosts, paths["host"].eqNullSafe(hosts["host"])).select(paths["*"], "hn", "hs")
    path_prior = prior_size(*moments(both, "n", "s", "q", "hs / hn"), rate)
    rates = both.withColumn("host_rate", F.expr(f"(hs + {host_prior}D * {rate}D) / (hn + {host_prior}D)")).selectExpr(
        "host", "path", "host_rate", f"(s + {path_prior}D * host_rate) / (n + {path_prior}D) AS path_rate"
    )
    return saved(rates, "quality-rates"), rate


def score(
    docs: DataFrame, model: Style, host: str = HOST, path: str = PATH, keep: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, the columns of ``keep``, host, path, p_document, host_rate, path_rate, p_quality, kept."""
    frame = docs.selectExpr(
        "CAST(doc_id AS bigint) doc_id", *keep, f"CAST({host} AS string) host", f"CAST({path} AS string) path", "text"
    )
    out = frame.drop("text").withColumn("p_document", F.lit(0.0)).schema
    kinds = {"string": pa.string(), "bigint": pa.int64(), "double": pa.float64()}
    arrow = pa.schema([(f.name, kinds[f.dataType.simpleString()]) for f in out])

    def columns(batch: pa.RecordBatch) -> dict:
        p = model.probabilities(columns_of(batch, "text")[0])
        return {f.name: batch.column(f.name) for f in arrow if f.name != "p_document"} | {"p_document": pa.array(p)}

    scored = saved(frame.mapInArrow(per_batch(columns, arrow), out), "quality-scores")
    rates, rate = site_rates(scored)
    odds = "{0} / (1 - {0})".format
    clipped = "least(greatest({}, 1e-6D), 1 - 1e-6D)".format
    joined = scored.alias("d").join(
        rates.alias("r"), F.expr("d.host <=> r.host AND d.path <=> r.path"), "left"
    ).selectExpr("d.*", "host_rate", "path_rate")
    return (
        joined.withColumn("odds", F.expr(f"{odds(clipped('p_document'))} * {odds(clipped('path_rate'))} / {rate / (1 - rate)}D"))
        .withColumn("p_quality", F.expr("odds / (1 + odds)"))
        .withColumn("kept", F.expr(f"p_quality >= {KEEP}D"))
        .drop("odds")
    )


def keep_good(docs: DataFrame, labels: DataFrame, host: str = HOST, path: str = PATH) -> DataFrame:
    """The rows of ``docs`` that are kept, with its columns."""
    rows = located(docs, host=host, path=path)
    plain = rows.selectExpr("doc.doc_id", "doc.text", "host", "path", "at.file", "at.row")
    scored = score(plain, learn(docs, labels), "host", "path", ("file", "row"))
    gone = scored.filter("NOT kept").select(F.struct("file", "row").alias("at"))
    return rows.join(gone, "at", "left_anti").select("doc.*")
