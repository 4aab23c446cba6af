"""Each expression at its edges, with null and unknown values."""

import math

import pytest

from cityflow.functions import kpi, temporal
from cityflow.functions.numeric import avg_of, percent, ratio, rounded, units, wide_ratio
from cityflow.functions.text import columns, literal


def values(spark, text, kind, inputs):
    """The expression over a column ``x`` holding the inputs, in order."""
    frame = spark.createDataFrame(list(enumerate(inputs)), f"i int, x {kind}")
    return [row[0] for row in frame.orderBy("i").selectExpr(text).collect()]


@pytest.mark.parametrize(
    "hour,period,peak",
    [
        (0, "Off-Peak Night", 0), (5, "Off-Peak Night", 0), (6, "Off-Peak Day", 0), (7, "Morning Peak", 1),
        (10, "Morning Peak", 1), (11, "Midday", 0), (13, "Midday", 0), (14, "Off-Peak Day", 0),
        (16, "Off-Peak Day", 0), (17, "Evening Peak", 1), (20, "Evening Peak", 1), (21, "Off-Peak Night", 0),
        (23, "Off-Peak Night", 0), (None, None, 0),
    ],
)
def test_day_period_and_peak(spark, hour, period, peak):
    assert values(spark, temporal.time_of_day("x"), "int", [hour]) == [period]
    assert values(spark, temporal.is_peak("x"), "int", [hour]) == [peak]


def test_parse_timestamp_keeps_bad_rows_as_null(spark):
    texts = ["2024-01-01 00:00:00", "2024-02-30 00:00:00", "01/02/2024", "", None]
    got = values(spark, f"CAST({temporal.parse_ts('x')} AS STRING)", "string", texts)
    assert got == ["2024-01-01 00:00:00", None, None, None, None]


def test_two_weekday_numberings(spark):
    # 2024-01-06 is a Saturday, 2024-01-07 a Sunday, 2024-01-08 a Monday.
    frame = spark.sql("SELECT explode(sequence(timestamp'2024-01-06', timestamp'2024-01-08', interval 1 day)) AS DateTime")
    rows = temporal.with_temporal(frame).orderBy("DateTime").collect()
    assert [(r.day_of_week, r.is_weekend) for r in rows] == [(7, 1), (1, 1), (2, 0)]
    days = temporal.with_calendar(frame, "DateTime").orderBy("DateTime").collect()
    assert [(d.day_of_week_num, d.is_weekend, d.day_name) for d in days] == [
        (6, 1, "Saturday"), (7, 1, "Sunday"), (1, 0, "Monday"),
    ]
    assert days[0].month_name == "January" and days[0].week == 1


def test_speed_bands(spark):
    speeds = [19, 20, 39, 40, 59, 60, 79, 80, None]
    assert values(spark, kpi.speed_category("x"), "int", speeds) == [
        "Very Slow", "Slow", "Slow", "Moderate", "Moderate", "Fast", "Fast", "Very Fast", "Very Fast",
    ]


def test_volume_bands(spark):
    volumes = [100, 101, 200, 201, 300, 301, 400, 401, None]
    assert values(spark, kpi.volume_band("x"), "int", volumes) == [
        "Very Low", "Low", "Low", "Medium", "Medium", "High", "High", "Very High", "Very High",
    ]


def test_hazard_levels(spark):
    risks = [5.0, 5.0001, 15.0, 15.0001, 30.0, 30.0001, None]
    assert values(spark, kpi.hazard_level("x"), "double", risks) == [
        "Low Hazard", "Moderate Hazard", "Moderate Hazard", "High Hazard", "High Hazard",
        "Critical Hazard", "Critical Hazard",
    ]


def test_risk_tiers(spark):
    chances = [0.3499, 0.35, 0.4999, 0.5, 0.6999, 0.7]
    assert values(spark, kpi.risk_tier("x"), "double", chances) == [
        "Low Risk", "Moderate Risk", "Moderate Risk", "High Risk", "High Risk", "Critical Risk",
    ]


def test_severity_and_flags(spark):
    labels = ["Minor", "Moderate", "Severe", "Fatal", "unknown", None]
    assert values(spark, kpi.severity_score("x"), "string", labels) == [1, 2, 3, 4, 4, 4]
    assert values(spark, kpi.flag_in("x", ("Fatal", "Severe")), "string", labels) == [0, 0, 1, 1, 0, 0]
    assert values(spark, kpi.position_in("x", "Fatal", "Severe"), "string", labels) == [0, 0, 2, 1, 0, 0]


def test_vehicle_class(spark):
    kinds = ["Bicycle", "Motorcycle", "Car", "Bus", "Truck", "Tram", None]
    assert values(spark, kpi.vehicle_class("x"), "string", kinds) == [
        "Non-Motorised", "Two-Wheeler", "Light Motor", "Heavy Motor", "Heavy Motor", "Other", "Other",
    ]


def test_risk_score_published_extremes(spark):
    frame = spark.createDataFrame([(4, 9, 4), (1, 0, 1), (2, None, 3)], "s int, c int, v int")
    text = kpi.risk_score("s", kpi.log_casualties("c"), "v")
    got = [r[0] for r in frame.selectExpr(text).collect()]
    assert got == [38.3663, 0.6931, round(2 * math.log(2) * 3, 4)]


def test_congestion_index(spark):
    frame = spark.createDataFrame([(494, 20), (0, 79), (247, None)], "Vehicle_Count int, Average_Speed int")
    got = [r.congestion_index for r in kpi.with_congestion_index(frame).collect()]
    assert got == [round(0.6 + 0.4 * (1 - 20 / 79), 4), 0.0, None]
    fixed = kpi.with_congestion_index(frame, maxima=(1000, 100)).collect()
    assert fixed[0].congestion_index == round(0.6 * 494 / 1000 + 0.4 * 0.8, 4)


def test_congestion_index_of_zero_maximum_is_null(spark):
    frame = spark.createDataFrame([(0, 0)], "Vehicle_Count int, Average_Speed int")
    assert kpi.with_congestion_index(frame).first().congestion_index is None


@pytest.mark.parametrize(
    "num,den,digits,scale,wanted",
    [
        (897, 200, 2, 0, 4.49), (1, 8, 2, 0, 0.13), (-1, 8, 2, 0, -0.13), (5, 0, 1, 0, None),
        (123455, 1, 3, 4, 12.346), (123450, 1, 3, 4, 12.345), (None, 3, 1, 0, None), (2, 3, 4, 0, 0.6667),
    ],
)
def test_ratios_round_half_away_from_zero(spark, num, den, digits, scale, wanted):
    frame = spark.createDataFrame([(num, den)], "n bigint, d bigint")
    assert frame.selectExpr(ratio("n", "d", digits, scale)).first()[0] == wanted
    if num is None or num >= 0:
        assert frame.selectExpr(wide_ratio("n", "d", digits, scale)).first()[0] == wanted


def test_fast_rounding_equals_round(spark):
    """On ties, next to them, on large and negative values and on a grid of quotients."""
    near = [k / 20000 + e for k in range(-9, 10) for e in (0.0, 1e-17, -1e-17, 1e-12, -1e-12, 1e-9)]
    odd = [1.00005, 2.67545, 38.36635, 1e9 + 0.00005, -1e12, 1e300, float("nan"), float("inf"), None]
    grid = [0.6 * v / 480 + 0.4 * (1.0 - s / 80) for v in range(0, 481, 7) for s in range(0, 81, 3)]
    frame = spark.createDataFrame([(x,) for x in near + odd + grid], "x double")
    differing = frame.selectExpr("x", f"{rounded('x')} AS a", "round(x, 4) AS b").filter("NOT (a <=> b)")
    assert differing.collect() == []


def test_averages_skip_nulls(spark):
    frame = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    row = frame.agg(*columns([f"{avg_of('x', 1)} AS a", f"{percent('sum(x)', 'count(*)')} AS p"])).first()
    assert row.a == 1.5 and row.p == 100.0


def test_units_are_exact(spark):
    assert values(spark, units("x"), "double", [38.3663, 0.6931, 0.1, None]) == [383663, 6931, 1000, None]


def test_literals(spark):
    for value in ("it's", "a\\b", 3, 0.5, True, None):
        assert spark.range(1).selectExpr(literal(value)).first()[0] == value


def test_band_needs_matching_labels():
    with pytest.raises(ValueError):
        kpi.band("x", (1, 2), ("a", "b"))
