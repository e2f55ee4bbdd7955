"""Driver queries of whole runs: all five entities landed, every model, archive,
tests; the append modes, compaction and the catalog.

Stand-ins (see :mod:`medallion.flow_queries`): country <- ``nation``, parameter
<- ``part``, location and sensor <- ``supplier``, measurement <- ``events``.
Every tenth sensor lands twice with one extraction time, so the key tests have
something to report; the second batch revises every third row of a dimension
and brings the other half of the events.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.flow_queries import _READINGS_SQL, PARAMETERS, _config, _day, _page, _readings, _revised
from medallion.plans.models import LAYERS
from medallion.plans.runner import Runner
from medallion.queries import COUNTRIES_SQL, LOCATIONS_SQL, PARAMETERS_SQL, REGION_KEYS, countries, locations, parameters, table
from medallion.sinks.catalog import database, withdraw
from medallion.sources.landing import land

_LOCATION = {
    "id": "id", "name": "name", "locality": "locality", "country.id": "country_id", "owner.name": "owner_name", "provider.name": "provider_name",
    "coordinates.latitude": "coordinates_latitude", "coordinates.longitude": "coordinates_longitude",
}
_SENSOR = {"id": "id", "name": "name", "parameter.id": "parameter_id", "summary.min": "summary_min", "location_id": "location_id"}


def _part(events: DataFrame, k: int) -> DataFrame:
    """The k-th of two batches; a reading's versions are dealt over both."""
    return events.where(F.expr(f"event_id div {PARAMETERS}") % 2 == k)


def _sensors(supplier: DataFrame) -> DataFrame:
    return supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("parameter_id"),
                           F.col("s_acctbal").alias("summary_min"), (F.col("s_suppkey") + 1).alias("location_id"))


def _run_all(spark: SparkSession, d: str) -> tuple[Runner, DataFrame]:
    """Two whole runs; the runner and the tests of the second."""
    runner = Runner(spark, _config(spark))
    root = runner.cfg.landing_root
    sensors = _sensors(table(spark, d, "supplier"))
    twice = sensors.where(F.col("id") % 10 == 0).withColumn("name", F.concat("name", F.lit(" again")))
    dims = {
        "country": (countries(table(spark, d, "nation")), {c: c for c in ("id", "code", "name")}),
        "parameter": (parameters(table(spark, d, "part")), {c: c for c in ("id", "name", "units", "display_name", "description")}),
        "location": (locations(table(spark, d, "supplier")), _LOCATION),
    }
    tests = None
    for k in range(2):
        for entity, (df, columns) in dims.items():
            land(_page(df if k == 0 else df.where(_revised()), entity, columns, _day(k + 1)), root, entity)
        land(_page(sensors.union(twice) if k == 0 else sensors.where(_revised()), "sensor", _SENSOR, _day(k + 1)), root, "sensor")
        land(_readings(_part(table(spark, d, "events"), k)), root, "measurement")
        tests = runner.run_pipeline(test=k == 1)
    return runner, tests


def q_run_test_report(spark, d):
    """Failures of every declared test after two whole runs."""
    return _run_all(spark, d)[1].select("test", F.col("failures").cast("long").alias("failures"))


def q_run_stored_duplicates(spark, d):
    """The duplicate report that a run's tests store."""
    runner, _ = _run_all(spark, d)
    return spark.read.parquet(f"{runner.cfg.dq}/duplicates").select("id", "table_name", F.col("count").alias("n"))


def _appended(spark: SparkSession, d: str, models: list[str]) -> Runner:
    """Two loads in the append modes: silver and gold hold what each load brought."""
    cfg = _config(spark)
    cfg.measurement_mode = cfg.aggregate_mode = "append"
    runner = Runner(spark, cfg)
    for k in range(2):
        land(_readings(_part(table(spark, d, "events"), k)), cfg.landing_root, "measurement")
        runner.run_models(["bronze_measurement", "silver_measurement", *models])
        runner.archive()
    return runner


def q_append_modes_daily(spark, d):
    out = _appended(spark, d, ["gold_measurement_daily_aggregate"]).read("gold", "measurement_daily_aggregate")
    return out.select("sensor_id", "parameter_id", "date", F.round("daily_average", 6).alias("daily_average"), "number_of_measurements")


def q_compacted_append(spark, d):
    """Appended measurements after their files and logs were packed, and a run
    that has nothing to take in."""
    models = ["gold_measurement"]
    runner = _appended(spark, d, models)
    runner.compact()
    runner.run_models(["bronze_measurement", "silver_measurement", *models])
    return runner.read("gold", "measurement").select("sensor_id", "parameter_id", "period_datetime_from_utc", "value")


def q_catalog_views(spark, d):
    """Tables read by name from the catalog after a load that swapped their version."""
    cfg = _config(spark)
    cfg.catalog = f"run_{uuid.uuid4().hex}_"
    runner = Runner(spark, cfg)
    own, loc = countries(table(spark, d, "nation")), locations(table(spark, d, "supplier"))
    for k, (nations, places) in enumerate(((own, loc), (own.where(_revised()).withColumn("name", F.lower("name")), loc.where(_revised()).withColumn("owner_name", F.lit("revised"))))):
        land(_page(nations, "country", {c: c for c in ("id", "code", "name")}, _day(k + 1)), cfg.landing_root, "country")
        land(_page(places, "location", _LOCATION, _day(k + 1)), cfg.landing_root, "location")
        runner.run_models(["bronze_country", "silver_country", "bronze_location", "silver_location", "gold_location"])
        runner.archive()
    silver, gold = (database(cfg.catalog, layer) for layer in ("silver", "gold"))
    out = spark.sql(f"""SELECT g.id, g.owner_name, g.locality_id, c.name AS country_name FROM {gold}.location g
        JOIN {silver}.location s ON s.id = g.id LEFT JOIN {silver}.country c ON c.id = s.country_id""")
    withdraw(spark, LAYERS, cfg.catalog)  # the frame is resolved: it reads the tables' files
    return out


RUN_QUERIES = {name[2:]: fn for name, fn in globals().copy().items() if name.startswith("q_")}

_TIED = "s_suppkey % 10 = 0 AND s_suppkey % 3 <> 0"  # sensors that still have two newest versions
_PLACE = "regexp_replace(coalesce(locality, name), '^\\p{Zs}+|\\p{Zs}+$', '', 'g')"
_RUN = f"""WITH {_READINGS_SQL},
country AS ({COUNTRIES_SQL}), parameter AS ({PARAMETERS_SQL}), location AS ({LOCATIONS_SQL}),
sensor AS (SELECT s_suppkey AS id, s_nationkey AS parameter_id, s_suppkey + 1 AS location_id FROM supplier
  UNION ALL SELECT s_suppkey, s_nationkey, s_suppkey + 1 FROM supplier WHERE {_TIED}),
measurement AS (SELECT sensor_id, parameter_id, h, value FROM latest),
hourly AS (SELECT DISTINCT sensor_id, parameter_id, h FROM latest),
daily AS (SELECT DISTINCT sensor_id, parameter_id, CAST(h AS DATE) AS date FROM latest),
gold_country AS (SELECT * FROM country WHERE id IN ({', '.join(str(k) for k in REGION_KEYS)})),
gold_parameter AS (SELECT * FROM parameter WHERE id IN (SELECT parameter_id FROM measurement)),
locality AS (SELECT min(l.id) AS id, l.country_id FROM location l LEFT JOIN country c ON l.country_id = c.id GROUP BY {_PLACE.replace('locality,', 'l.locality,').replace('name)', 'l.name)')}, l.country_id, c.code),
tied AS (SELECT sensor_id, parameter_id, h, count(*) AS n FROM measurement GROUP BY ALL HAVING count(*) > 1)"""


def _orphans(test: str, child: str, column: str, parent: str) -> str:
    return f"SELECT 'relationships_{test}' AS test, (SELECT count(*) FROM {child} WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT id FROM {parent})) AS failures"


def _report() -> str:
    """All declared tests, as SQL: dimensions have one row an id but for the
    tied sensors, no id is null."""
    out = []
    for layer in LAYERS:
        for t in ("country", "location", "parameter", "sensor", *(["locality"] if layer == "gold" else [])):
            failures = f"(SELECT count(*) FROM supplier WHERE {_TIED})" if t == "sensor" else "0"
            out += [f"SELECT 'unique_{layer}_{t}_id' AS test, {failures} AS failures", f"SELECT 'not_null_{layer}_{t}_id', 0"]
        gold = "gold_" if layer == "gold" else ""
        out += [_orphans(f"{layer}_measurement_sensor_id__sensor_id", "measurement", "sensor_id", "sensor"),
                _orphans(f"{layer}_measurement_parameter_id__parameter_id", "measurement", "parameter_id", f"{gold}parameter"),
                _orphans(f"{layer}_sensor_location_id__location_id", "sensor", "location_id", "location")]
        if not gold:
            out += [_orphans(f"{layer}_location_country_id__country_id", "location", "country_id", "country"),
                    _orphans(f"{layer}_sensor_parameter_id__parameter_id", "sensor", "parameter_id", "parameter")]
    out += ["SELECT 'relationships_gold_location_locality_id__locality_id', 0",
            _orphans("gold_locality_country_id__country_id", "locality", "country_id", "gold_country")]
    for t in ("hourly", "daily"):
        out += [_orphans(f"gold_measurement_{t}_aggregate_sensor_id__sensor_id", t, "sensor_id", "sensor"),
                _orphans(f"gold_measurement_{t}_aggregate_parameter_id__parameter_id", t, "parameter_id", "gold_parameter")]
    out += [f"SELECT 'duplicates', 3 * ((SELECT count(*) FROM supplier WHERE {_TIED}) + (SELECT count(*) FROM tied))",
            "SELECT 'undated_measurement', 0"]
    return f"{_RUN} SELECT test, CAST(failures AS BIGINT) AS failures FROM (" + " UNION ALL ".join(out) + ")"


_TEXT = "strftime({}, '%Y-%m-%dT%H:%M:%SZ')"
_APPENDED = f"""WITH r AS (
  SELECT DISTINCT value, user_id AS sensor_id, event_id % {PARAMETERS} AS parameter_id, date_trunc('hour', ts) AS h, ts, (event_id // {PARAMETERS}) % 2 AS k FROM events),
brought AS (  -- a load's newest versions, those that the table has newer ones of left out
  SELECT DISTINCT k, sensor_id, parameter_id, h, value FROM r
  WHERE ts = (SELECT max(ts) FROM r o WHERE o.sensor_id = r.sensor_id AND o.parameter_id = r.parameter_id AND o.h = r.h AND o.k <= r.k))"""
RUN_SQL = {
    "run_test_report": _report(),
    "run_stored_duplicates": f"""{_RUN}, layers AS (SELECT unnest(['bronze', 'silver', 'gold']) AS layer)
SELECT CAST(s_suppkey AS VARCHAR) AS id, concat(layer, '_sensor') AS table_name, 2 AS n FROM supplier, layers WHERE {_TIED}
UNION ALL SELECT concat(sensor_id, '|', parameter_id, '|', {_TEXT.format('h')}, '|', {_TEXT.format('h + INTERVAL 1 HOUR')}), concat(layer, '_measurement'), n FROM tied, layers""",
    "append_modes_daily": f"""{_APPENDED}
SELECT sensor_id, parameter_id, CAST(h AS DATE) AS date, round(avg(value), 6) AS daily_average, count(*) AS number_of_measurements
FROM brought GROUP BY k, sensor_id, parameter_id, CAST(h AS DATE)""",
    "compacted_append": f"{_APPENDED} SELECT sensor_id, parameter_id, {_TEXT.format('h')} AS period_datetime_from_utc, value FROM brought",
    "catalog_views": f"""WITH l AS ({LOCATIONS_SQL}), c AS ({COUNTRIES_SQL}), p AS (SELECT *, {_PLACE} AS place FROM l)
SELECT p.id, CASE WHEN p.id % 3 = 0 THEN 'revised' ELSE owner_name END AS owner_name, min(p.id) OVER (PARTITION BY place, country_id) AS locality_id,
  CASE WHEN c.id % 3 = 0 THEN lower(c.name) ELSE c.name END AS country_name FROM p LEFT JOIN c ON c.id = p.country_id""",
}
