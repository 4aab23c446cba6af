"""Time features."""

from collections.abc import Sequence

from pyspark.sql import DataFrame

from cityflow import fixed_values as V
from cityflow.functions.text import literal, one_of

HourRanges = Sequence[tuple[int, int]]


def parse_ts(text: str, fmt: str = V.TIMESTAMP_FORMAT) -> str:
    """Text to timestamp. A row that does not parse gives null instead of failing the job."""
    return f"try_to_timestamp({text}, {literal(fmt)})"


def is_weekend(ts: str, days: Sequence[int] = V.WEEKEND_DAYS) -> str:
    return f"CASE WHEN {one_of(f'dayofweek({ts})', days)} THEN 1 ELSE 0 END"


def _within(hour: str, ranges: HourRanges) -> str:
    return " OR ".join(f"{hour} BETWEEN {first} AND {last}" for first, last in ranges)


def is_peak(hour: str, ranges: HourRanges = V.PEAK_HOURS) -> str:
    return f"CASE WHEN {_within(hour, ranges)} THEN 1 ELSE 0 END"


def time_of_day(
    hour: str,
    periods: Sequence[tuple[str, HourRanges]] = V.DAY_PERIODS,
    default: str = V.OTHER_PERIOD,
) -> str:
    """Name of the day period; the first match wins and a null hour stays null."""
    arms = " ".join(f"WHEN {_within(hour, ranges)} THEN {literal(label)}" for label, ranges in periods)
    return f"CASE WHEN {hour} IS NULL THEN NULL {arms} ELSE {literal(default)} END"


def with_temporal(df: DataFrame, ts: str = "DateTime") -> DataFrame:
    """year, month, day, hour, quarter, day_of_week (Sunday = 1), is_weekend, is_peak_hour."""
    return df.selectExpr(
        "*",
        f"year({ts}) AS year",
        f"month({ts}) AS month",
        f"dayofmonth({ts}) AS day",
        f"hour({ts}) AS hour",
        f"quarter({ts}) AS quarter",
        f"dayofweek({ts}) AS day_of_week",
        f"{is_weekend(ts)} AS is_weekend",
        f"{is_peak(f'hour({ts})')} AS is_peak_hour",
    )


def calendar(ts: str) -> list[str]:
    """Calendar attributes of the date dimension; here the week starts on Monday = 1."""
    hour = f"hour({ts})"
    return [
        f"to_date({ts}) AS date_only",
        f"year({ts}) AS year",
        f"quarter({ts}) AS quarter",
        f"month({ts}) AS month",
        f"date_format({ts}, 'MMMM') AS month_name",
        f"month({ts}) AS month_sort",
        f"weekofyear({ts}) AS week",
        f"date_format({ts}, 'EEEE') AS day_name",
        f"weekday({ts}) + 1 AS day_of_week_num",
        f"{hour} AS hour",
        f"{time_of_day(hour)} AS time_of_day",
        f"{is_peak(hour)} AS is_peak_hour",
        f"CASE WHEN weekday({ts}) >= 5 THEN 1 ELSE 0 END AS is_weekend",
    ]


def with_calendar(df: DataFrame, ts: str) -> DataFrame:
    return df.selectExpr("*", *calendar(ts))
