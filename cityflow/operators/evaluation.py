"""Classifier metrics, model comparison and risk tiers."""

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityflow import fixed_values as V
from cityflow.functions.kpi import risk_tier
from cityflow.functions.numeric import percent, rounded
from cityflow.functions.text import case, columns
from cityflow.operators.prefix import with_running_total

# Width of the score ranges: about a millionth, so even crowded scores spread over many of them.
_SCORE_RANGES = 2**20


def _f1(hit: str, called_and_positive: str) -> str:
    """0 when nothing is positive, neither by label nor by prediction."""
    return f"IF({called_and_positive} = 0, 0D, 2 * {hit} / NULLIF({called_and_positive}, 0))"


def f1_of(predicted: str, label: str, weight: str = "1L") -> str:
    """F1 of class 1 as an aggregate over rows, or over distinct rows that stand for ``weight`` rows."""

    def rows(condition: str) -> str:
        return f"coalesce(sum(IF({condition}, {weight}, 0)), 0)"

    both = f"({rows(f'{predicted} = 1')} + {rows(f'{label} = 1')})"
    return _f1(rows(f"{predicted} = 1 AND {label} = 1"), both)


def metrics(scored: DataFrame, probability: str, predicted: str, label: str) -> DataFrame:
    """One row: accuracy, F1 of class 1 and the exact area under the ROC curve.

    The area is the share of (positive, negative) pairs ranked rightly, ties counting half. Rows
    are first added up per score; the negatives below each score are then a running total. A null
    score ranks below every other one, and a null prediction is a wrong one.
    """
    p, y = predicted, label
    by_score = (
        scored.selectExpr(f"{probability} AS score", p, y)
        .groupBy("score")
        .agg(
            *columns(
                [
                    f"count_if({y} = 1) AS pos",
                    f"count_if({y} = 0) AS neg",
                    f"count_if({p} = {y}) AS right_calls",
                    f"count_if({p} = 1 AND {y} = 1) AS hit",
                    f"count_if({p} = 1) AS called",
                ]
            )
        )
    )
    ranked = with_running_total(by_score, "neg", "score", f"floor(score * {_SCORE_RANGES})", "neg_upto")
    pairs = "CAST(pos AS DECIMAL(38,0)) * (2 * neg_upto - neg)"
    totals = ranked.agg(
        *columns(
            [
                *[f"sum({c}) AS {c}" for c in ("right_calls", "hit", "called", "pos", "neg")],
                f"CAST(sum(CAST({pairs} AS DECIMAL(38,0))) AS DOUBLE) AS pairs",
            ]
        )
    )
    all_pairs = "2D * CAST(pos AS DOUBLE) * CAST(neg AS DOUBLE)"
    return totals.selectExpr(
        "right_calls / NULLIF(pos + neg, 0) AS accuracy",
        f"{_f1('hit', '(called + pos)')} AS f1_score",
        f"pairs / NULLIF({all_pairs}, 0D) AS roc_auc",
    )


def fold_f1(scored: DataFrame, fold: str, predicted: str, label: str) -> DataFrame:
    """Mean and population standard deviation of the per-fold F1."""
    per_fold = scored.groupBy(fold).agg(F.expr(f"{f1_of(predicted, label)} AS f1"))
    return per_fold.agg(*columns(["avg(f1) AS cv_f1_mean", "stddev_pop(f1) AS cv_f1_std"]))


def compare(models: DataFrame, digits: int = 3) -> DataFrame:
    """One row per model, metrics rounded, the one with the largest ROC area selected.

    Expects a row per model; the first name wins a tie.
    """
    best = "row_number() OVER (ORDER BY roc_auc DESC, model) = 1 AS selected"
    names = ("accuracy", "f1_score", "roc_auc", "cv_f1_mean", "cv_f1_std")
    return models.selectExpr("model", *[f"round({c}, {digits}) AS {c}" for c in names], best)


def risk_table(scored: DataFrame, probability: str, predicted: str) -> DataFrame:
    """The scored table: probability to 4 places, class, actual outcome and tier."""
    rows = scored.selectExpr(
        "accident_id",
        "location_name",
        f"{rounded(probability)} AS predicted_risk_prob",
        f"CAST({predicted} AS INT) AS predicted_class",
        f"CAST({V.TARGET} AS INT) AS actual_fatal_severe",
    )
    return rows.selectExpr("*", f"{risk_tier('predicted_risk_prob')} AS risk_tier")


def tier_distribution(risk: DataFrame, ranges: Mapping[str, str] = V.TIER_RANGES) -> DataFrame:
    """Rows per tier, share of all rows and the tier's probability range."""
    counts = risk.groupBy("risk_tier").agg(F.expr("count(*) AS count"))
    everything = counts.agg(F.expr("sum(count)")).scalar()
    return counts.withColumn("__all", everything).selectExpr(
        "risk_tier",
        "count",
        f"{percent('count', '__all')} AS percentage",
        f"{case('risk_tier', dict(ranges), None)} AS probability_threshold",
    )
