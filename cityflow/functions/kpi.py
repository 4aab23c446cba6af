"""KPI expressions. All are native, so they stay inside generated code."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityflow import fixed_values as V
from cityflow.functions.numeric import rounded
from cityflow.functions.text import case, literal, one_of


def band(x: str, edges: Sequence, labels: Sequence[str], closed: str = "right") -> str:
    """Name the interval a value falls in; null falls into the last one.

    ``closed="right"`` puts a value equal to an edge below it, ``"left"`` above it.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("one more label than edges is needed")
    below = "<=" if closed == "right" else "<"
    arms = " ".join(f"WHEN {x} {below} {literal(e)} THEN {literal(n)}" for e, n in zip(edges, labels))
    return f"CASE {arms} ELSE {literal(labels[-1])} END"


def lookup(x: str, mapping: Mapping, default) -> str:
    """Value of a literal map; the default for unknown keys and null."""
    return case(x, dict(mapping), default)


ordinal = lookup


def flag_in(x: str, values: Sequence) -> str:
    return f"CASE WHEN {one_of(x, values)} THEN 1 ELSE 0 END"


def position_in(x: str, *values) -> str:
    """1-based place of a value in a list, 0 if absent or null."""
    listed = f"array({', '.join(literal(v) for v in values)})"
    return f"CAST(coalesce(array_position({listed}, {x}), 0) AS INT)"


def congestion_index(
    volume: str,
    speed: str,
    max_volume: str,
    max_speed: str,
    weights: tuple[float, float] = V.CONGESTION_WEIGHTS,
    digits: int = 4,
) -> str:
    """Null when a maximum is 0."""
    by_volume, by_speed = (literal(float(w)) for w in weights)
    return rounded(
        f"{by_volume} * {volume} / NULLIF({max_volume}, 0)"
        f" + {by_speed} * (1.0D - CAST({speed} AS DOUBLE) / NULLIF({max_speed}, 0))",
        digits,
    )


def maxima_of(df: DataFrame, volume: str = "Vehicle_Count", speed: str = "Average_Speed") -> DataFrame:
    """One row: the largest volume and speed."""
    return df.agg(F.max(volume).alias("max_volume"), F.max(speed).alias("max_speed"))


def with_congestion_index(
    df: DataFrame,
    volume: str = "Vehicle_Count",
    speed: str = "Average_Speed",
    weights: tuple[float, float] = V.CONGESTION_WEIGHTS,
    maxima: DataFrame | tuple[float, float] | None = None,
    digits: int = 4,
) -> DataFrame:
    """Weighted share of the volume maximum and shortfall from the speed maximum.

    The maxima are constants, a one-row frame, or by default those of ``df`` itself. A frame is
    read as a scalar subquery: its one value enters the scan's own stage, with no join or collect.
    """
    if isinstance(maxima, tuple):
        top = [literal(m) for m in maxima]
        return df.selectExpr(
            "*", f"{congestion_index(volume, speed, *top, weights, digits)} AS congestion_index"
        )
    source = maxima_of(df, volume, speed) if maxima is None else maxima
    top = source.selectExpr("struct(max_volume, max_speed)").scalar()
    index = congestion_index(volume, speed, "__top.max_volume", "__top.max_speed", weights, digits)
    return df.withColumn("__top", top).selectExpr("* EXCEPT (__top)", f"{index} AS congestion_index")


def speed_category(x: str) -> str:
    return band(x, V.SPEED_EDGES, V.SPEED_LABELS, closed="left")


def volume_band(x: str) -> str:
    return band(x, V.VOLUME_EDGES, V.VOLUME_LABELS, closed="right")


def hazard_level(x: str) -> str:
    return band(x, V.HAZARD_EDGES, V.HAZARD_LABELS, closed="right")


def risk_tier(x: str) -> str:
    return band(x, V.TIER_EDGES, V.TIER_LABELS, closed="left")


def severity_score(x: str, mapping: Mapping = V.SEVERITY_SCORES, default: int = V.TOP_SEVERITY_SCORE) -> str:
    return ordinal(x, mapping, default)


def log_casualties(x: str) -> str:
    return f"log1p(coalesce({x}, 0) + 1)"


def risk_score(severity: str, log_cas: str, vehicles: str, digits: int = 4) -> str:
    return rounded(f"{severity} * {log_cas} * {vehicles}", digits)


def vehicle_class(
    x: str, mapping: Mapping = V.VEHICLE_CLASSES, default: str = V.OTHER_VEHICLE_CLASS
) -> str:
    return lookup(x, mapping, default)
