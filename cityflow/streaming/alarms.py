"""Threshold alarms over metric sums per period, as batch or stream."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityflow import fixed_values as V
from cityflow.functions.text import literal


def alarm(
    df: DataFrame,
    ts: str,
    key: str,
    value: str,
    period: int = V.ALARM_PERIOD_SECONDS,
    threshold: float = V.ALARM_THRESHOLD,
) -> DataFrame:
    """Sum per key and period, and its state: ALARM from the threshold upwards, else OK."""
    sums = df.groupBy(F.window(ts, f"{period} seconds"), F.col(key).alias("alarm_name")).agg(
        F.sum(value).alias("total")
    )
    return sums.selectExpr(
        "alarm_name", "window.start AS period_start", "window.end AS period_end", "total",
        f"IF(total >= {threshold}, 'ALARM', 'OK') AS state",
    )


def alarm_stream(
    df: DataFrame,
    ts: str,
    key: str,
    value: str,
    delay: str = "10 minutes",
    period: int = V.ALARM_PERIOD_SECONDS,
    threshold: float = V.ALARM_THRESHOLD,
) -> DataFrame:
    """The same on an unbounded frame. A period is final once event time has passed it by ``delay``.

    State per open period and key is one partial sum, so a busy key costs no more than a quiet one.
    """
    return alarm(df.withWatermark(ts, delay), ts, key, value, period, threshold)


def _horizon(states: DataFrame, as_of: str | None) -> Column:
    """Second at which the last period starts: the one that holds ``as_of``, or any alarm's latest."""
    if as_of is None:
        return states.agg(F.expr("max(unix_seconds(period_start))")).scalar()
    return F.expr(f"unix_seconds(CAST({literal(as_of)} AS TIMESTAMP))")


def alarm_filled(
    states: DataFrame,
    periods_to_alarm: int = V.ALARM_PERIODS,
    period: int = V.ALARM_PERIOD_SECONDS,
    as_of: str | None = None,
) -> DataFrame:
    """States for every period from a key's first up to a common end, missing ones counting as OK.

    The end is ``as_of``, by default the latest period of any key: an alarm that falls silent does
    not stay as it was. A key is in ALARM in a period that ends ``periods_to_alarm`` breaching periods in a row. Days
    are spread out before the periods within them, so no row holds a long list; what is sorted per
    key is the calendar, not the data.
    """
    seconds = states.selectExpr("alarm_name", "unix_seconds(period_start) AS at", "total", "state")
    ends = seconds.groupBy("alarm_name").agg(F.min("at").alias("first")).withColumn("last", _horizon(states, as_of))
    ends = ends.filter("first <= last")
    day = max(86400 // period, 1) * period
    chunks = ends.selectExpr("alarm_name", "last", f"explode(sequence(first, last, {day}L)) AS from_at")
    spine = chunks.selectExpr(
        "alarm_name", f"explode(sequence(from_at, least(last, from_at + {day - period}L), {period}L)) AS at"
    )
    run = f"OVER (PARTITION BY alarm_name ORDER BY at ROWS BETWEEN {periods_to_alarm - 1} PRECEDING AND CURRENT ROW)"
    return (
        spine.join(seconds, ["alarm_name", "at"], "left")
        .selectExpr("*", f"sum(IF(state = 'ALARM', 1, 0)) {run} AS breaches")
        .selectExpr(
            "alarm_name", "timestamp_seconds(at) AS period_start", "total",
            f"IF(breaches = {periods_to_alarm}, 'ALARM', 'OK') AS state",
        )
    )


def alarm_status(
    states: DataFrame,
    prefix: str = "",
    periods_to_alarm: int = V.ALARM_PERIODS,
    period: int = V.ALARM_PERIOD_SECONDS,
    as_of: str | None = None,
) -> DataFrame:
    """State at the common end of each alarm whose name starts with ``prefix``.

    It equals the last state of :func:`alarm_filled` without spreading out the calendar: ALARM if all
    of the last ``periods_to_alarm`` periods breached, of which missing ones did not.
    """
    timed = states.selectExpr("alarm_name", "unix_seconds(period_start) AS at", "state").withColumn("last", _horizon(states, as_of))
    recent = f"at <= last AND at > last - {periods_to_alarm * period} AND state = 'ALARM'"
    return (
        timed.filter(f"startswith(alarm_name, {literal(prefix)}) AND at <= last")
        .groupBy("alarm_name")
        .agg(F.expr(f"IF(count_if({recent}) >= {periods_to_alarm}, 'ALARM', 'OK') AS state"))
    )
