"""Alarm transitions as a stream: a row whenever an alarm changes between OK and ALARM.

One stateful operator per alarm holds the sums of its open periods, and closes a period once the
watermark has passed it. A timer closes the period after the last one of an alarm that falls silent, so it
does not stay in ALARM for want of rows. Rows are summed per period within their partition before they
are sent to their alarm, so an alarm with a third of all rows receives a row per task and period.
"""

import json
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cityflow import fixed_values as V

CHANGES = "alarm_name string, changed_at timestamp, state string, total double"
_STATE = "next_at bigint, state string, run int, sums string"


def partial_sums(rows: DataFrame) -> DataFrame:
    """Sums per alarm and period of every batch of rows of a partition, with the latest time of each."""
    schema = pa.schema([("alarm_name", pa.string()), ("at", pa.int64()), ("total", pa.float64()), ("seen", pa.timestamp("us", "UTC"))])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch]).group_by(["alarm_name", "at"]).aggregate([("total", "sum"), ("seen", "max")])
            yield from table.select(["alarm_name", "at", "total_sum", "seen_max"]).rename_columns(schema.names).cast(schema).to_batches()

    return rows.mapInArrow(sums, "alarm_name string, at bigint, total double, seen timestamp")


def closing(period: int, threshold: float, periods_to_alarm: int) -> Callable:
    """The step of one alarm: its new sums, or its timer."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        (name,) = key
        next_at, last, run, sums = state.get if state.exists else (None, None, 0, "{}")
        opened = {int(at): total for at, total in json.loads(sums).items()}
        for frame in frames:
            for at, total in zip(frame["at"].tolist(), frame["total"].fillna(0).tolist()):
                if next_at is None or at >= next_at:  # else the period is closed: too late
                    opened[at] = opened.get(at, 0.0) + total
        if name is None:
            return  # a heartbeat: it moves the watermark and belongs to no alarm
        watermark = state.getCurrentWatermarkMs() // 1000
        changes = []

        def close(at: int, total: float | None) -> None:
            nonlocal next_at, last, run
            run = run + 1 if total is not None and total >= threshold else 0
            now = "ALARM" if run >= periods_to_alarm else "OK"
            if now != last:
                changes.append((name, pd.Timestamp(at, unit="s"), now, total))
            next_at, last = at + period, now

        for at in sorted(at for at in opened if at + period <= watermark):
            if next_at is not None and next_at < at:
                close(next_at, None)  # silent periods: the first one says it all
            close(at, opened.pop(at))
        upto = min(opened, default=watermark)
        if last == "ALARM" and next_at + period <= min(upto, watermark):
            close(next_at, None)
        timers = [min(opened) + period] if opened else []
        timers += [next_at + period] if last == "ALARM" else []
        state.update((next_at, last, run, json.dumps(opened)))
        if timers:
            state.setTimeoutTimestamp(max(min(timers) * 1000, state.getCurrentWatermarkMs() + 1))
        if changes:
            yield pd.DataFrame(changes, columns=["alarm_name", "changed_at", "state", "total"]).astype({"total": "float64"})

    return step


def alarm_changes(
    df: DataFrame,
    ts: str,
    key: str,
    value: str,
    delay: str = "10 minutes",
    period: int = V.ALARM_PERIOD_SECONDS,
    threshold: float = V.ALARM_THRESHOLD,
    periods_to_alarm: int = V.ALARM_PERIODS,
) -> DataFrame:
    """alarm_name, changed_at (start of the period), state and the period's total (null if it was silent) of
    every change of an unbounded frame, the first state of an alarm included.

    A period is final once event time has passed its end by ``delay``. Rows without a ``key`` are heartbeats: where
    all alarms may fall silent, a clock's rows keep time going. Per alarm the state holds its open periods only.
    """
    rows = df.selectExpr(
        f"CAST({key} AS STRING) AS alarm_name", f"CAST(floor(unix_seconds({ts}) / {period}) * {period} AS BIGINT) AS at",
        f"CAST({value} AS DOUBLE) AS total", f"{ts} AS seen",
    )
    return (
        partial_sums(rows)
        .withWatermark("seen", delay)
        .groupBy("alarm_name")
        .applyInPandasWithState(
            closing(period, threshold, periods_to_alarm), CHANGES, _STATE, "append", GroupStateTimeout.EventTimeTimeout
        )
    )
