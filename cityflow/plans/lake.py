"""Ad-hoc queries over the feature tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityflow.functions.numeric import avg_fixed, avg_of, hits, percent, ratio, total, units
from cityflow.functions.text import columns


def distribution(df: DataFrame, column: str, digits: int = 1) -> DataFrame:
    """Rows per value and share of all rows.

    The total is a scalar subquery over the counts, so no window gathers every value in one task.
    """
    counts = df.groupBy(column).agg(F.expr("count(*) AS Count"))
    everything = counts.agg(F.expr("sum(Count)")).scalar()
    return counts.withColumn("__all", everything).selectExpr(
        "* EXCEPT (__all)", f"{percent('Count', '__all', digits)} AS Pct_of_Total"
    )


def hourly_risk(accidents: DataFrame) -> DataFrame:
    measures = [
        "count(*) AS Accidents",
        f"{avg_fixed('risk_score', 3)} AS Avg_Risk_Score",
        f"{total('is_fatal_or_severe')} AS Fatal_Severe",
        "max(risk_score) AS Max_Risk_Score",
    ]
    return accidents.groupBy("hour").agg(*columns(measures))


def traffic_by_location(readings: DataFrame) -> DataFrame:
    measures = [
        "count(*) AS Total_Readings",
        f"{avg_of('Vehicle_Count', 1)} AS Avg_Vehicles",
        "max(Vehicle_Count) AS Peak_Vehicles",
        f"{avg_of('Average_Speed', 1)} AS Avg_Speed_kmh",
        f"{avg_fixed('congestion_index', 4)} AS Avg_Congestion_Index",
        "max(congestion_index) AS Max_Congestion_Index",
    ]
    return readings.groupBy("Location").agg(*columns(measures))


def weather_road(accidents: DataFrame) -> DataFrame:
    measures = [
        "count(*) AS Accidents",
        f"{avg_fixed('risk_score', 3)} AS Avg_Risk",
        f"{total('is_fatal_or_severe')} AS Fatal_Severe_Count",
        f"{percent(total('is_fatal_or_severe'), 'count(*)')} AS Fatal_Severe_Pct",
    ]
    cells = accidents.groupBy("Weather_Condition", "Road_Condition").agg(*columns(measures))
    return cells.withColumnsRenamed(
        {"Weather_Condition": "weather_condition", "Road_Condition": "road_condition"}
    )


def headline(accidents: DataFrame, readings: DataFrame) -> DataFrame:
    """One row of city totals. Both tables are stacked and aggregated once."""
    left = accidents.selectExpr(
        "1 AS accident", "Casualties", "risk_score", "is_fatal_or_severe", "adverse_weather"
    )
    right = readings.selectExpr("1 AS reading", "congestion_index", "Congestion_Level")
    n, n_readings = "count(accident)", "count(reading)"
    measures = [
        f"{n} AS total_accidents",
        f"{total('Casualties')} AS total_casualties",
        f"{percent(total('is_fatal_or_severe'), n)} AS fatal_severe_pct",
        f"{avg_fixed('risk_score', 2)} AS avg_risk_score",
        "min(risk_score) AS min_risk_score",
        "max(risk_score) AS max_risk_score",
        f"{percent(total('adverse_weather'), n)} AS adverse_weather_pct",
        f"{n_readings} AS total_readings",
        f"{avg_fixed('congestion_index', 3)} AS avg_congestion_index",
        "min(congestion_index) AS min_congestion_index",
        "max(congestion_index) AS max_congestion_index",
        percent(hits("Congestion_Level = 'High'"), n_readings) + " AS high_congestion_pct",
    ]
    return left.unionByName(right, allowMissingColumns=True).agg(*columns(measures))


def peak_hour(accidents: DataFrame) -> DataFrame:
    """The hour with the highest average risk and its lift over the mean, in percent.

    Hours are compared by their rounded averages; the earliest wins a tie.
    """
    per_hour = accidents.groupBy("hour").agg(
        *columns(
            [
                f"{avg_fixed('risk_score', 3)} AS avg_risk",
                f"CAST(sum({units('risk_score')}) AS DECIMAL(20,0)) AS s",
                "CAST(count(risk_score) AS DECIMAL(20,0)) AS n",
            ]
        )
    )
    city = per_hour.agg(
        *columns(
            [
                "max(struct(avg_risk, -hour AS h, s, n)) AS top",
                "CAST(sum(s) AS DECIMAL(20,0)) AS s",
                "CAST(sum(n) AS DECIMAL(20,0)) AS n",
            ]
        )
    )
    lift = "100 * ((top.s / top.n) / NULLIF(s / n, 0) - 1)"
    return city.selectExpr(
        "-top.h AS hour",
        "top.avg_risk AS avg_risk_score",
        f"{ratio('s', 'n', 3, 4)} AS mean_risk_score",
        f"CAST(round({lift}, 1) AS DOUBLE) AS lift_pct",
    )
