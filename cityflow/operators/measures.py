"""Aggregates of a view as SQL text, over the rows of a fact or over cells.

A cell is a mergeable partial aggregate: the rows of a fact that agree in all columns by which a view groups,
as counts, sums of whole numbers and extremes. Sums of sums are exact, so a view over the cells of any number
of batches equals the view over their rows, to the last digit.
"""

from pyspark.sql import DataFrame

from cityflow.functions import numeric
from cityflow.functions.text import columns
from cityflow.operators.star import MONTH, key_time

HOUR = f"hour({key_time('date_id')})"

ACCIDENT_KEYS = ("location_id", "weather_id", "road_condition", "hazardous_road", "accident_severity")
ACCIDENT_SUMS = (
    "casualties", "severity_score", "is_fatal_or_severe", "adverse_weather", "traffic_density_num", "is_peak_hour",
)
TRAFFIC_KEYS = ("location_id", "congestion_level")
TRAFFIC_SUMS = ("vehicle_count", "average_speed")
TRAFFIC_MEASURES = (*TRAFFIC_SUMS, "congestion_index")


class Rows:
    """Measures over a fact's rows."""

    n = "count(*)"

    def count(self, pk: str) -> str:
        return f"count({pk})"

    def total(self, x: str) -> str:
        return numeric.total(x)

    def hits(self, condition: str) -> str:
        return numeric.hits(condition)

    def avg_of(self, x: str, digits: int) -> str:
        return numeric.avg_of(x, digits)

    def avg_fixed(self, x: str, digits: int) -> str:
        return numeric.avg_fixed(x, digits)

    def sum_fixed(self, x: str, digits: int) -> str:
        return numeric.sum_fixed(x, digits)

    def top(self, x: str) -> str:
        return f"max({x})"

    def low(self, x: str) -> str:
        return f"min({x})"


class Cells(Rows):
    """The same over cells, see :func:`accident_cells` and :func:`traffic_cells`. Facts have no nulls in
    what is measured, so a cell's rows count for every measure of its fact."""

    def __init__(self, rows: str = "n_accidents"):
        self.n = f"sum({rows})"

    def count(self, pk: str) -> str:
        return f"coalesce(sum({'n_accidents' if pk == 'accident_pk' else 'n_readings'}), 0L)"

    def _rows(self, x: str) -> str:
        return "n_readings" if x in TRAFFIC_MEASURES else "n_accidents"

    def total(self, x: str) -> str:
        # what cells are keyed by is the same in all rows of one
        return f"sum({x} * {self._rows(x)})" if x in ACCIDENT_KEYS else f"sum(sum_{x})"

    def hits(self, condition: str) -> str:
        rows = "n_readings" if "congestion_level" in condition else "n_accidents"
        return f"sum(CASE WHEN {condition} THEN {rows} ELSE 0L END)"

    def avg_of(self, x: str, digits: int) -> str:
        return numeric.ratio(self.total(x), f"sum({self._rows(x)})", digits)

    def avg_fixed(self, x: str, digits: int) -> str:
        return numeric.ratio(f"sum(units_{x})", f"sum({self._rows(x)})", digits, 4)

    def sum_fixed(self, x: str, digits: int) -> str:
        return numeric.ratio(f"sum(units_{x})", "1L", digits, 4)

    def top(self, x: str) -> str:
        return f"max({x})" if x in ACCIDENT_KEYS else f"max(max_{x})"

    def low(self, x: str) -> str:
        return f"min(min_{x})"


ROWS = Rows()


def _cells(fact: DataFrame, keys: tuple[str, ...], measures: list[str]) -> DataFrame:
    month = MONTH if MONTH in fact.columns else f"CAST(trunc({key_time('date_id')}, 'month') AS DATE) AS {MONTH}"
    dated = fact.selectExpr(*[c for c in fact.columns if c != MONTH], month, f"{HOUR} AS hour")
    return dated.groupBy(MONTH, "hour", *keys).agg(*columns(measures))


def accident_cells(accidents: DataFrame) -> DataFrame:
    sums = [f"{numeric.total(c)} AS sum_{c}" for c in ACCIDENT_SUMS]
    fixed = [f"sum({numeric.units('risk_score')}) AS units_risk_score", "max(risk_score) AS max_risk_score"]
    return _cells(accidents, ACCIDENT_KEYS, ["count(*) AS n_accidents", *sums, *fixed])


def traffic_cells(traffic: DataFrame) -> DataFrame:
    sums = [f"{numeric.total(c)} AS sum_{c}" for c in TRAFFIC_SUMS]
    extremes = [
        "max(vehicle_count) AS max_vehicle_count", "min(average_speed) AS min_average_speed",
        f"sum({numeric.units('congestion_index')}) AS units_congestion_index", "max(congestion_index) AS max_congestion_index",
    ]
    return _cells(traffic, TRAFFIC_KEYS, ["count(*) AS n_readings", *sums, *extremes])
