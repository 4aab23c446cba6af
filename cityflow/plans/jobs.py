"""The pipeline's jobs, from raw files to the scored table.

Each job replaces its output, so a rerun after a failure gives the same result. Feature tables can
be partitioned, by year and month for example, so that later reads skip what they do not need.
"""

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityflow import fixed_values as V
from cityflow.functions import kpi
from cityflow.operators import evaluation, measures, model_data, star, training
from cityflow.plans import loads
from cityflow.plans.features import accident_features, sensor_features
from cityflow.plans.warehouse import FACTS, SCHEMAS, open_tables, report, store
from cityflow.schemas import DIM_DATE, RAW_ACCIDENT, RAW_SENSOR
from cityflow.session import delete, scratch_path
from cityflow.sources.files import append_new, observed, read_csv, stored, write_append, write_replace


def sensor_job(spark: SparkSession, raw: str, out: str, partition_by: Sequence[str] = ()) -> int:
    """Sensor CSV to the sensor feature table; returns the rows written."""
    rows = read_csv(spark, raw, RAW_SENSOR)
    counted, rows_written = observed(sensor_features(rows, kpi.maxima_of(rows)), "sensor rows")
    write_replace(counted, out, partition_by)
    return rows_written.get["row_count"]


def accident_job(spark: SparkSession, raw: str, out: str, partition_by: Sequence[str] = ()) -> int:
    """Accident CSV to the accident feature table; returns the rows written."""
    counted, rows_written = observed(accident_features(read_csv(spark, raw, RAW_ACCIDENT)), "accident rows")
    write_replace(counted, out, partition_by)
    return rows_written.get["row_count"]


def _check_report(spark: SparkSession, warehouse: str, check: bool) -> None:
    """Replace the report on the stored tables' constraints, or take away one that is out of date."""
    if check:
        tables = open_tables(spark, warehouse)
        checked = {name: tables[name] for name in SCHEMAS if name != "ml_accident_risk"}
        write_replace(report(checked).coalesce(1), f"{warehouse}/quality_report")
    else:
        delete(spark, f"{warehouse}/quality_report")


class _Loading:
    """One run: the loads that it sees, and those that it has written so far."""

    def __init__(self, spark: SparkSession, warehouse: str, whole: bool, numbered: bool):
        self.spark, self.warehouse, self.numbered = spark, warehouse, numbered
        self.seen = [] if whole else loads.visible(spark, warehouse)
        self.whole = whole
        self.made: list[loads.Load] = []
        self.replaced: list[loads.Load] = []

    def begin(self, source: str, rows: DataFrame, batch: str | None) -> tuple[loads.Load, dict, dict]:
        """A new load of a batch, and the tables of the other loads and of the one that it replaces."""
        load = loads.new_load(source, batch or loads.batch_of(rows), self.whole)
        before = [seen for seen in self.seen if (seen.source, seen.batch_id) == (source, load.batch_id)]
        self.seen = [seen for seen in self.seen if seen not in before]
        self.replaced += before
        others, own = (open_tables(self.spark, self.warehouse, seen) for seen in (self.seen, before))
        return load, others, own

    def write(self, load: loads.Load, tables: dict[str, DataFrame]) -> None:
        for name, rows in tables.items():
            dated = star.with_month(rows) if name in FACTS else rows
            by = [star.MONTH] if star.MONTH in dated.columns else []
            write_replace(dated, loads.folder(self.warehouse, name, load), by)

    def keyed(self, rows: DataFrame, source: str, unique: list[str], pk: str) -> DataFrame:
        """Rows with a key that no other row of the table has: behind the largest one of the other loads,
        by the rows' places in their files, which costs no shuffle, or counted through."""
        rows = rows.drop(pk)
        last = max((seen.last_key for seen in self.seen if seen.source == source), default=0)
        if self.numbered:
            counted = star.with_row_keys(rows, unique, "__place")
            return counted.selectExpr("* EXCEPT (__place)", f"__place + {last}L AS {pk}")
        return rows.selectExpr("*", f"monotonically_increasing_id() + {last + 1}L AS {pk}")

    def finish(self, load: loads.Load, source: str, marked: DataFrame, constraints: list[str], pk: str, facts) -> None:
        """Write facts, rejects, the cells that views merge, and what was counted on the way; the rows are
        checked once, and no other load's rows are read."""
        counts = {c: f"count_if(array_contains(failed, '{c}'))" for c in constraints}
        counts |= {"rows stored": "count_if(size(failed) = 0)", "rows rejected": "count_if(size(failed) > 0)"}
        counted, seen = observed(marked, f"load {load.load_id}", counts | {"last_key": f"coalesce(max({pk}), 0L)"})
        rows = stored(counted, scratch_path(self.spark, f"checked-{source}"))
        found = seen.get
        cells = {"traffic": measures.traffic_cells, "accident": measures.accident_cells}[source]
        stored_facts = facts(rows)
        self.write(
            load,
            {f"fact_{source}": stored_facts, f"reject_{source}": star.rejects_of(rows), f"cells_{source}": cells(stored_facts)},
        )
        audit = [(load.batch_id, f"fact_{source}", measure, found[measure]) for measure in counts]
        audit.append((load.batch_id, f"fact_{source}", "rows read", found["row_count"]))
        schema = "batch_id string, table_name string, measure string, row_count bigint"
        self.write(load, {"load_audit": self.spark.createDataFrame(audit, schema).coalesce(1)})
        done = replace(load, last_key=max(found["last_key"], 0))
        self.made.append(done)
        self.seen.append(done)

    def commit(self) -> None:
        loads.commit(self.spark, self.warehouse, self.made)
        if self.whole:
            loads.clean(self.spark, self.warehouse)
        for load in self.replaced:
            for table in loads.VERSIONED:
                delete(self.spark, loads.folder(self.warehouse, table, load))


def _new_dates(rows: DataFrame, others: DataFrame, own: DataFrame) -> DataFrame:
    """The times that no other load has, those of an earlier load of the batch included."""
    names = DIM_DATE.fieldNames()
    times = star.dim_date(rows).select(names).unionByName(own.select(names))
    return append_new(times, others.select(names), "date_id")


def _new_weather(crashes: DataFrame, others: DataFrame, own: DataFrame) -> DataFrame:
    """The conditions that no other load has, numbered behind all; an earlier load's keep their keys."""
    known = others.unionByName(own)
    last = known.agg(F.expr("coalesce(max(weather_id), 0L)")).first()[0]
    fresh = star.dim_weather(crashes).join(known.select("weather_condition"), "weather_condition", "left_anti")
    numbered = star.with_key(fresh.drop("weather_id"), "weather_condition", "weather_id")
    return numbered.selectExpr(f"weather_id + {last}L AS weather_id", "weather_condition", "is_adverse").unionByName(own)


def _load(
    spark: SparkSession, sensor: str, accident: str, warehouse: str, zones: Mapping[str, str], numbered: bool,
    whole: bool, batch: str | None, check: bool,
) -> dict[str, DataFrame]:
    run = _Loading(spark, warehouse, whole or not loads.visible(spark, warehouse), numbered)
    if run.whole:
        store({"dim_location": star.dim_location(spark, zones), "dim_vehicle": star.dim_vehicle(spark)}, warehouse)
    readings, crashes = spark.read.parquet(sensor), spark.read.parquet(accident)

    load, others, own = run.begin("traffic", readings, batch)
    location, vehicle = others["dim_location"], others["dim_vehicle"]
    run.write(load, {"dim_date": _new_dates(readings, others["dim_date"], own["dim_date"])})
    keyed = run.keyed(readings, "traffic", ["Sensor_ID", "Date_Time", "Location"], "traffic_pk")
    names = star.constraints(star.TRAFFIC_NAMES, star.TRAFFIC_REQUIRED)
    run.finish(load, "traffic", star.checked_traffic(keyed, location), names, "traffic_pk", star.traffic_of)

    load, others, own = run.begin("accident", crashes, batch)
    run.write(
        load,
        {
            "dim_date": _new_dates(crashes, others["dim_date"], own["dim_date"]),
            "dim_weather": _new_weather(crashes, others["dim_weather"], own["dim_weather"]),
        },
    )
    weather = open_tables(spark, warehouse, [*run.seen, load])["dim_weather"]
    ids = crashes.selectExpr("Accident_ID").filter("Accident_ID IS NOT NULL")
    repeated = stored(star.repeated_values(ids, "Accident_ID"), scratch_path(spark, "repeated-accidents"))
    # the batch is the small side of the search through all stored ids
    known = others["fact_accident"].selectExpr("accident_id AS Accident_ID").join(ids, "Accident_ID", "left_semi").distinct()
    known = stored(known, scratch_path(spark, "known-accidents"))
    keyed = run.keyed(crashes, "accident", ["Accident_ID"], "accident_pk")
    marked = star.checked_accidents(keyed, location, vehicle, weather, repeated, known)
    names = star.constraints(star.ACCIDENT_NAMES, star.ACCIDENT_REQUIRED, "Accident_ID")
    run.finish(load, "accident", marked, names, "accident_pk", star.accidents_of)

    run.commit()
    _check_report(spark, warehouse, check)
    return open_tables(spark, warehouse)


def load_job(
    spark: SparkSession,
    sensor: str,
    accident: str,
    warehouse: str,
    zones: Mapping[str, str] = V.ZONE_TYPES,
    numbered: bool = False,
    batch: str | None = None,
    check: bool = True,
) -> dict[str, DataFrame]:
    """Feature tables to the stored star schema, the rejects, what was counted on the way and a report on all
    constraints. Replaces what the warehouse holds; see :func:`append_job` for how batches are told apart.

    Dimensions are stored first and facts refer to the stored ones. Each fact table's rows are checked
    once, and split into facts and rejects from there; the constraints that they break are counted in the
    same pass (``warehouse.open_audit``). Facts are stored by month. Every row has a key of its own;
    ``numbered`` counts them 1.. without gaps. ``check``: whether uniqueness and references are verified over the
    stored tables as well, which reads their key columns.
    """
    return _load(spark, sensor, accident, warehouse, zones, numbered, True, batch, check)


def append_job(
    spark: SparkSession,
    sensor: str,
    accident: str,
    warehouse: str,
    zones: Mapping[str, str] = V.ZONE_TYPES,
    numbered: bool = False,
    batch: str | None = None,
    check: bool = True,
) -> dict[str, DataFrame]:
    """Further feature tables into a stored star schema, each as a batch of its source.

    A batch that was loaded before takes its own place again, in facts, rejects, dates and counts alike,
    so a repeat adds nothing, and all of it becomes visible at once: a run that fails on the way leaves the
    warehouse as it was. A batch is known by its contents, or by ``batch``, which may be loaded again with
    other rows. All rows of a batch are kept, equal ones too. New weather conditions and times come
    behind the stored ones, whose keys stay. An accident whose id another batch has stored goes to the
    rejects. One load runs at a time. ``zones`` matters to a warehouse that is still empty.
    """
    return _load(spark, sensor, accident, warehouse, zones, numbered, False, batch, check)


def severity_job(
    spark: SparkSession,
    warehouse: str,
    model_path: str,
    runs_path: str,
    chosen: training.Chosen = training.candidates,
) -> DataFrame:
    """Train and compare the models, keep the best and score every accident with it.

    The kept model has its encoder in it, so it scores rows that come later, see :func:`score_job`. Replaces
    the scored table and the published outputs in the warehouse (comparison, importances, tiers, class
    balance), appends to the table of runs, and returns the comparison.
    """
    rows = _model_rows(open_tables(spark, warehouse))
    encoder = model_data.fit_encoder(rows)
    encoded = training.materialise(training.with_parts(encoder.transform(rows), "accident_id"), "encoded")
    train, test = encoded.filter("NOT is_test"), encoded.filter("is_test")
    trained = training.cross_validate(lambda: training.train_all(train, test, chosen), train, chosen=chosen)
    best = training.best_of(trained)
    training.save(training.with_encoder(encoder, best.model), model_path)
    write_replace(training.score(best.model, encoded), f"{warehouse}/ml_accident_risk")
    training.log_run(spark, best, train.count(), runs_path)
    scored = open_tables(spark, warehouse)["ml_accident_risk"]
    outputs = {
        "ml_model_comparison": evaluation.compare(training.model_rows(spark, trained)),
        "ml_feature_importance": training.importances(best.model, spark),
        "ml_risk_tiers": evaluation.tier_distribution(scored),
        "ml_class_balance": model_data.class_balance(encoded),
    }
    for name, rows in outputs.items():
        write_replace(rows.coalesce(1), f"{warehouse}/{name}")
    return spark.read.parquet(f"{warehouse}/ml_model_comparison")


def _model_rows(tables: Mapping[str, DataFrame], accidents: DataFrame | None = None) -> DataFrame:
    facts = tables["fact_accident"] if accidents is None else accidents
    rows = model_data.features(facts, tables["dim_location"], tables["dim_vehicle"], tables["dim_weather"])
    return rows.selectExpr("*", "location_name AS zone")


def score_job(spark: SparkSession, warehouse: str, model_path: str, again: bool = False) -> int:
    """Score the accidents that were loaded after training with the stored model; returns their number.

    Accidents without a score are appended to the scored table, so a repeat adds nothing; ``again`` scores all
    and replaces it. Codes are those of the training rows: a category that is new, wherever it sorts, counts as
    unknown and shifts no other.
    """
    tables = open_tables(spark, warehouse)
    accidents, scored = tables["fact_accident"], tables["ml_accident_risk"]
    if not again:
        accidents = accidents.join(scored.select("accident_id"), "accident_id", "left_anti")
    rows = training.score(training.load(model_path), _model_rows(tables, accidents))
    rows, counted = observed(stored(rows, scratch_path(spark, "scored")), "scored rows")
    (write_replace if again else write_append)(rows, f"{warehouse}/ml_accident_risk")
    found = open_tables(spark, warehouse)["ml_accident_risk"]
    write_replace(evaluation.tier_distribution(found).coalesce(1), f"{warehouse}/ml_risk_tiers")
    return counted.get["row_count"]
