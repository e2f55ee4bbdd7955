"""Driver queries that run the flow itself: land pages, scan, load, archive.

Each lands the rows of given tables as batches of pages under the shared
checkpoint folder, runs the real sources, sinks, runner and stream over
them, and returns a table that resulted.

* measurement <- ``events``: a reading per sensor (user), parameter
  (event_id mod 1000) and hour; an event is a version of it, extracted at
  the event's time.  The batches split the events by id, so that older
  versions arrive after newer ones.
* country <- ``nation``, parameter <- ``part``, location and sensor <-
  ``supplier``; the second batch revises every third one.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.functions.exprs import col_of, instant
from medallion.operators.selection import read_mark, write_mark
from medallion.plans.runner import PipelineConfig, Runner
from medallion.queries import LOCATIONS_SQL, PARAMETERS_SQL, REGION_KEYS, countries, locations, parameters, table
from medallion.schemas import EXTRACTION_TS, landing_schema
from medallion.session import staging_path
from medallion.sources.api_pages import read_api_pages
from medallion.sources.drift import align_to_schema, scan_drifting
from medallion.sources.landing import land, new_dir, scan_landing
from medallion.streaming.incremental import run_available_now, start_bronze_stream, start_page_stream

PARAMETERS = 1000  # parameter ids that the events' readings are of
PAGE = 8192  # records of a JSON page at most


def _day(k: int) -> Column:
    return F.lit(f"2024-02-0{k}T06:00:00Z").cast("timestamp")


def _revised() -> Column:
    return F.col("id") % 3 == 0


def _config(spark: SparkSession) -> PipelineConfig:
    base = staging_path(spark, "flow")
    return PipelineConfig(landing_root=f"{base}/raw", warehouse_root=f"{base}/wh", country_ids=REGION_KEYS)


def _page(df: DataFrame, entity: str, columns: dict[str, str | Column], extracted: Column) -> DataFrame:
    """Landed rows of ``entity``: given columns by their dotted names."""
    cols = [(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()]
    return align_to_schema(df.select(*cols, extracted.alias(EXTRACTION_TS)), landing_schema(entity))


def _readings(events: DataFrame) -> DataFrame:
    hour = F.date_trunc("HOUR", F.col("ts").cast("timestamp"))
    text = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return _page(events, "measurement", {
        "value": "value", "period.interval": F.lit("01:00:00"), "period.datetime_from.utc": text(hour),
        "period.datetime_to.utc": text(hour + F.expr("INTERVAL 1 HOUR")),
        "parameter.id": F.col("event_id") % PARAMETERS, "sensor_id": "user_id",
    }, F.col("ts").cast("timestamp"))


_READINGS_SQL = f"""readings AS (
  SELECT DISTINCT value, user_id AS sensor_id, event_id % {PARAMETERS} AS parameter_id, date_trunc('hour', ts) AS h, ts FROM events),
latest AS (
  SELECT * FROM readings r WHERE ts = (SELECT max(ts) FROM readings o
    WHERE o.sensor_id = r.sensor_id AND o.parameter_id = r.parameter_id AND o.h = r.h))"""


def _run_readings(spark: SparkSession, d: str, models: list[str], batches: int = 3, before: Callable[[Runner], None] | None = None) -> Runner:
    """Land the readings in batches and run the models after each."""
    runner = Runner(spark, _config(spark))
    if before:
        before(runner)
    events = table(spark, d, "events")
    for k in range(batches):
        part = events.where(F.col("event_id") % batches == batches - 1 - k)
        land(_readings(part), runner.cfg.landing_root, "measurement")
        for name in models:
            runner.run_model(name)
        runner.archive()
    return runner


def q_pipeline_bronze_measurement(spark, d):
    out = _run_readings(spark, d, ["bronze_measurement"]).read("bronze", "measurement")
    return out.select("sensor_id", "parameter_id", "period_datetime_from_utc", "value", "measurement_date")


def q_pipeline_gold_measurement(spark, d):
    out = _run_readings(spark, d, ["bronze_measurement", "silver_measurement", "gold_measurement"], 2).read("gold", "measurement")
    return out.select("sensor_id", "parameter_id", "period_datetime_from_utc", "value")


def q_pipeline_daily_incremental(spark, d):
    models = ["bronze_measurement", "silver_measurement", "gold_measurement_daily_aggregate"]
    out = _run_readings(spark, d, models, 2).read("gold", "measurement_daily_aggregate")
    return out.groupBy("date").agg(F.count("*").alias("n_groups"), F.round(F.sum("daily_average"), 4).alias("averages"), F.sum("number_of_measurements").alias("readings"))


def q_pipeline_hourly_incremental(spark, d):
    models = ["bronze_measurement", "silver_measurement", "gold_measurement_hourly_aggregate"]
    out = _run_readings(spark, d, models, 2).read("gold", "measurement_hourly_aggregate")
    return out.select("sensor_id", "parameter_id", "date", "hour", F.round("hourly_average", 6).alias("hourly_average"), "number_of_measurements")


def _merged(spark: SparkSession, d: str, alias: str) -> DataFrame:
    """An aggregate kept by merging the states of three loads, of which the
    later ones bring older and newer versions of readings."""
    models = ["bronze_measurement", "silver_measurement", f"gold_{alias}"]
    runner = Runner(spark, _config(spark))
    events = table(spark, d, "events")
    for k in range(3):
        # a reading's versions are dealt over the loads by the event's kind
        part = events.where(F.pmod(F.crc32("event_type") + F.col("event_id"), F.lit(3)) == k)
        land(_readings(part), runner.cfg.landing_root, "measurement")
        for name in models:
            runner.run_model(name)
        runner.archive()
    return runner.read("gold", alias)


def q_aggregate_state_daily(spark, d):
    out = _merged(spark, d, "measurement_daily_aggregate")
    return out.select("sensor_id", "parameter_id", "date", "day_of_week", F.round("daily_average", 6).alias("daily_average"),
                      "daily_minimum", "daily_maximum", "number_of_measurements")


def q_aggregate_state_hourly(spark, d):
    out = _merged(spark, d, "measurement_hourly_aggregate")
    return out.select("sensor_id", "parameter_id", "date", "hour", F.round("hourly_average", 6).alias("hourly_average"),
                      "hourly_minimum", "hourly_maximum", "number_of_measurements")


def _moved_localities(spark: SparkSession, d: str) -> Runner:
    """Locations and countries, then every third location moves to another
    place and every fifth country has another code: only what that touches is
    made anew."""
    runner = Runner(spark, _config(spark))
    loc, own = locations(table(spark, d, "supplier")), countries(table(spark, d, "nation"))
    dotted = {"id": "id", "name": "name", "locality": "locality", "country.id": "country_id", "owner.name": "owner_name", "provider.name": "provider_name",
              "coordinates.latitude": "coordinates_latitude", "coordinates.longitude": "coordinates_longitude"}
    moved = loc.where(_revised()).withColumn("locality", F.concat(F.lit(" moved "), F.col("id") % 4))
    recoded = own.where(F.col("id") % 5 == 0).withColumn("code", F.concat(F.lit("X"), F.col("id")))
    for k, (places, nations) in enumerate(((loc, own), (moved, own.limit(0)), (moved.limit(0), recoded))):
        land(_page(places, "location", dotted, _day(k + 1)), runner.cfg.landing_root, "location")
        land(_page(nations, "country", {c: c for c in ("id", "code", "name")}, _day(k + 1)), runner.cfg.landing_root, "country")
        for name in ("bronze_country", "silver_country", "bronze_location", "silver_location", "gold_location", "gold_locality"):
            runner.run_model(name)
        runner.archive()
    return runner


def q_locality_touched_groups(spark, d):
    out = _moved_localities(spark, d).read("gold", "locality")
    return out.select("id", "country_id", "name", "display_name", F.round("coordinates_latitude", 6).alias("coordinates_latitude"),
                      F.round("coordinates_longitude", 6).alias("coordinates_longitude"))


def q_location_touched_groups(spark, d):
    return _moved_localities(spark, d).read("gold", "location").select("id", "name", "owner_name", "locality_id")


def q_pipeline_gold_parameter(spark, d):
    """Parameters whose first reading comes after they were loaded."""
    def before(runner: Runner) -> None:
        land(_page(parameters(table(spark, d, "part")), "parameter", {c: c for c in ("id", "name", "units", "display_name", "description")}, _day(1)),
             runner.cfg.landing_root, "parameter")
        runner.run_model("bronze_parameter")
        runner.run_model("silver_parameter")

    models = ["bronze_measurement", "silver_measurement", "gold_parameter"]
    out = _run_readings(spark, d, models, 2, before).read("gold", "parameter")
    return out.select("id", "name", "units", "description", "display_name")


def q_stream_bronze_upsert(spark, d):
    cfg = _config(spark)
    cfg.extra["stream_checkpoint_root"] = f"{cfg.warehouse_root}/streams"
    events = table(spark, d, "events")
    for k in range(2):
        land(_readings(events.where(F.col("event_id") % 2 == 1 - k)), cfg.landing_root, "measurement")
        q = start_bronze_stream(spark, cfg, "measurement")
        q.awaitTermination()
    out = Runner(spark, cfg).read("bronze", "measurement")
    return out.select("sensor_id", "parameter_id", "period_datetime_from_utc", "value")


def q_stream_layers(spark, d):
    """Bronze, silver and the daily aggregate as streams, chained twice."""
    cfg = _config(spark)
    cfg.extra["stream_checkpoint_root"], cfg.entities = f"{cfg.warehouse_root}/streams", ("measurement",)
    events = table(spark, d, "events")
    for k in range(2):
        land(_readings(events.where(F.col("event_id") % 2 == 1 - k)), cfg.landing_root, "measurement")
        run_available_now(spark, cfg, test=False, models=["silver_measurement", "gold_measurement_daily_aggregate"])
    out = Runner(spark, cfg).read("gold", "measurement_daily_aggregate")
    return out.select("sensor_id", "parameter_id", "date", F.round("daily_average", 6).alias("daily_average"), "number_of_measurements")


def _json_pages(events: DataFrame, path: str) -> None:
    """Pages of a sensor's records, from ``PAGE`` rows that follow each other in
    a part of the table, so no page has more, whatever a sensor's share."""
    record = F.struct("value", F.struct(F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("utc")).alias("datetime_from")).alias("period"),
                      F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("name")).alias("parameter"))
    paged = events.withColumn("page", F.expr(f"monotonically_increasing_id() div {PAGE}"))
    paged.groupBy(F.col("user_id").alias("parent_id"), "page").agg(F.collect_list(record).alias("results")).drop("page").write.mode("append").json(path)


def q_stream_json_pages(spark, d):
    """JSON pages landed by a stream, in two parts, some of them cut off; with
    what was landed, the number of bad pages of each part."""
    cfg = _config(spark)
    cfg.pages_root = f"{cfg.landing_root}-pages"
    cfg.extra["stream_checkpoint_root"] = f"{cfg.warehouse_root}/streams"
    events = table(spark, d, "events")
    path = f"{cfg.pages_root}/measurement"
    for k in range(2):
        _json_pages(events.where(F.col("event_id") % 2 == k), path)
        # every thousandth event has a page of its own that ends early
        events.where((F.col("event_id") % 2 == k) & (F.col("event_id") % 1000 == k)).select(F.concat(F.lit('{"results": [{"value": '), F.col("event_id")).alias("value")) \
            .write.mode("append").text(path)
        start_page_stream(spark, cfg, "measurement", multi_line=False).awaitTermination()
    landed = scan_landing(spark, cfg.landing_root, "measurement", scope="new")
    bad = spark.read.option("recursiveFileLookup", "true").parquet(f"{cfg.dq}/bad_pages")
    return landed.select("sensor_id", "value", col_of("parameter.id").alias("parameter_id"), F.lit(None).cast("string").alias("bad_page")) \
        .unionByName(bad.select(F.lit(None).cast("long").alias("sensor_id"), F.lit(None).cast("double").alias("value"), F.lit(None).cast("long").alias("parameter_id"), F.col("page").alias("bad_page")))


def q_landing_drift_scan(spark, d):
    """Files that hold ``value`` as a whole number, as a double, or not."""
    path = f"{new_dir(_config(spark).landing_root, 'reading')}"
    ev = table(spark, d, "events").select(F.col("event_id").alias("id"), "value", F.array(F.struct(F.col("user_id").cast("int").alias("id"))).alias("sensors"))
    shapes = (["id", F.col("value").cast("bigint").alias("value")], ["id", "value", "sensors"], ["id", F.lit("x").alias("label")])
    for k, cols in enumerate(shapes):
        ev.where(F.col("id") % 3 == k).select(*cols).write.parquet(f"{path}/b{k}")
    schema = T.StructType.fromDDL("id long, value double, label string, sensors array<struct<id: long, name: string>>")
    out = scan_drifting(spark, path, schema)
    return out.select("id", "value", "label", F.col("sensors")[0]["id"].alias("sensor_id"))


def q_archive_then_full_refresh(spark, d):
    runner = Runner(spark, _config(spark))
    own = countries(table(spark, d, "nation"))
    for df, at in ((own, _day(2)), (own.withColumn("name", F.lower("name")).where(_revised()), _day(1)), (own.withColumn("name", F.concat("name", F.lit("!"))).where(F.col("id") % 5 == 0), _day(3))):
        land(_page(df, "country", {c: c for c in ("id", "code", "name")}, at), runner.cfg.landing_root, "country")
        runner.run_model("bronze_country")
        runner.archive()
    runner.run_model("bronze_country", full_refresh=True)
    runner.run_model("silver_country")
    runner.run_model("gold_country")
    return runner.read("silver", "country").join(runner.read("gold", "country").select("id", F.lit(True).alias("kept")), "id", "left") \
        .select("id", "code", "name", F.coalesce("kept", F.lit(False)).alias("kept"))


def _two_batches(spark: SparkSession, pages: DataFrame, entity: str, revise: Callable[[DataFrame], DataFrame], models: list[str]) -> Runner:
    runner = Runner(spark, _config(spark))
    for df in (pages, revise(pages).where(_revised()).withColumn(EXTRACTION_TS, _day(2))):
        land(df, runner.cfg.landing_root, entity)
        for name in models:
            runner.run_model(name)
        runner.archive()
    return runner


def q_pipeline_silver_parameter(spark, d):
    pages = _page(parameters(table(spark, d, "part")), "parameter", {c: c for c in ("id", "name", "units", "display_name", "description")}, _day(1))
    runner = _two_batches(spark, pages, "parameter", lambda p: p.withColumn("units", F.lit("revised")), ["bronze_parameter", "silver_parameter"])
    return runner.read("silver", "parameter").select("id", "name", "units", "display_name", "description")


def q_pipeline_gold_location(spark, d):
    loc = locations(table(spark, d, "supplier"))
    pages = _page(loc, "location", {
        "id": "id", "name": "name", "locality": "locality", "country.id": "country_id", "owner.name": "owner_name", "provider.name": "provider_name",
        "coordinates.latitude": "coordinates_latitude", "coordinates.longitude": "coordinates_longitude",
    }, _day(1))
    runner = _two_batches(spark, pages, "location", lambda p: p.withColumn("owner.name", F.lit("revised")), ["bronze_location", "silver_location", "gold_location"])
    return runner.read("gold", "location").select("id", "name", "owner_name", "coordinates_latitude", "locality_id")


def q_pipeline_gold_sensor(spark, d):
    s = table(spark, d, "supplier")
    pages = _page(s, "sensor", {
        "id": "s_suppkey", "name": "s_name", "parameter.id": F.col("s_nationkey"), "summary.min": "s_acctbal", "location_id": F.col("s_suppkey") + 1,
    }, _day(1))
    runner = _two_batches(spark, pages, "sensor", lambda p: p.withColumn("summary.min", col_of("summary.min") - 1), ["bronze_sensor", "silver_sensor", "gold_sensor"])
    return runner.read("gold", "sensor").select("id", "name", "parameter_id", "summary_min", "location_id")


def q_page_flatten(spark, d):
    """JSON pages of a sensor's records, read as landed rows."""
    path = f"{staging_path(spark, 'pages')}/measurement"
    _json_pages(table(spark, d, "events"), path)
    out = read_api_pages(spark, path, "measurement", multi_line=False)
    return out.select("sensor_id", "value", *[col_of(c).alias(c.replace(".", "_")) for c in ("period.datetime_from.utc", "parameter.id", "parameter.name")])


def q_extraction_mark(spark, d):
    """What was extracted after the newest of the marks that were written."""
    path, events = staging_path(spark, "mark"), table(spark, d, "events")
    for row in events.agg(F.unix_micros(F.min("ts").cast("timestamp")).alias("a"), F.expr("cast(percentile_disc(0.5) within group (order by unix_micros(cast(ts as timestamp))) as bigint)").alias("b")).collect():
        for micros in (row.b, row.a):  # the older one last
            write_mark(spark, path, dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=micros))
    return events.where(instant("ts") > read_mark(spark, path)).select("event_id", "ts")


FLOW_QUERIES = {name[2:]: fn for name, fn in globals().copy().items() if name.startswith("q_")}

_FROM = "strftime(h, '%Y-%m-%dT%H:%M:%SZ')"
_REGION = ", ".join(str(k) for k in REGION_KEYS)
_MOVED = f"""c AS (
  SELECT CAST(n_nationkey AS BIGINT) AS id, CASE WHEN n_nationkey % 5 = 0 THEN concat('X', n_nationkey) WHEN n_regionkey = 4 THEN NULL ELSE concat('N', n_nationkey) END AS code FROM nation),
k AS (
  SELECT id, name, owner_name, country_id, coordinates_latitude, coordinates_longitude,
    regexp_replace(CASE WHEN id % 3 = 0 THEN concat(' moved ', id % 4) ELSE coalesce(locality, name) END, '^\\p{{Zs}}+|\\p{{Zs}}+$', '', 'g') AS place FROM ({LOCATIONS_SQL}))"""
FLOW_SQL = {
    "aggregate_state_daily": f"""WITH {_READINGS_SQL}, s AS (SELECT DISTINCT sensor_id, parameter_id, h, value FROM latest)
SELECT sensor_id, parameter_id, CAST(h AS DATE) AS date, CAST(isodow(h) AS BIGINT) AS day_of_week, round(avg(value), 6) AS daily_average,
  min(value) AS daily_minimum, max(value) AS daily_maximum, count(*) AS number_of_measurements
FROM s GROUP BY sensor_id, parameter_id, CAST(h AS DATE), isodow(h)""",
    "aggregate_state_hourly": f"""WITH {_READINGS_SQL}, s AS (SELECT DISTINCT sensor_id, parameter_id, h, value FROM latest)
SELECT sensor_id, parameter_id, CAST(h AS DATE) AS date, CAST(hour(h) AS BIGINT) AS hour, round(avg(value), 6) AS hourly_average,
  min(value) AS hourly_minimum, max(value) AS hourly_maximum, count(*) AS number_of_measurements
FROM s GROUP BY sensor_id, parameter_id, h""",
    "locality_touched_groups": f"""WITH {_MOVED}
SELECT min(k.id) AS id, country_id, place AS name, concat(place, ', ', c.code) AS display_name, round(avg(coordinates_latitude), 6) AS coordinates_latitude,
  round(avg(coordinates_longitude), 6) AS coordinates_longitude
FROM k LEFT JOIN c ON k.country_id = c.id GROUP BY place, country_id, c.code""",
    "location_touched_groups": f"""WITH {_MOVED}
SELECT id, name, owner_name, min(id) OVER (PARTITION BY place, country_id) AS locality_id FROM k""",
    "pipeline_bronze_measurement": f"WITH {_READINGS_SQL} SELECT sensor_id, parameter_id, {_FROM} AS period_datetime_from_utc, value, CAST(h AS DATE) AS measurement_date FROM latest",
    "pipeline_gold_measurement": f"WITH {_READINGS_SQL} SELECT DISTINCT sensor_id, parameter_id, {_FROM} AS period_datetime_from_utc, value FROM latest",
    "stream_bronze_upsert": f"WITH {_READINGS_SQL} SELECT sensor_id, parameter_id, {_FROM} AS period_datetime_from_utc, value FROM latest",
    "stream_layers": f"""WITH {_READINGS_SQL}, s AS (SELECT DISTINCT sensor_id, parameter_id, h, value FROM latest)
SELECT sensor_id, parameter_id, CAST(h AS DATE) AS date, round(avg(value), 6) AS daily_average, count(*) AS number_of_measurements
FROM s GROUP BY sensor_id, parameter_id, CAST(h AS DATE)""",
    "stream_json_pages": """SELECT user_id AS sensor_id, value, event_id AS parameter_id, NULL AS bad_page FROM events
UNION ALL SELECT NULL, NULL, NULL, concat('{"results": [{"value": ', event_id) FROM events WHERE event_id % 1000 IN (0, 1) AND event_id % 1000 = event_id % 2""",
    "pipeline_daily_incremental": f"""WITH {_READINGS_SQL}, s AS (SELECT DISTINCT sensor_id, parameter_id, h, value FROM latest),
g AS (SELECT CAST(h AS DATE) AS date, avg(value) AS a, count(*) AS n FROM s GROUP BY date, sensor_id, parameter_id)
SELECT date, count(*) AS n_groups, round(sum(a), 4) AS averages, CAST(sum(n) AS BIGINT) AS readings FROM g GROUP BY date""",
    "pipeline_hourly_incremental": f"""WITH {_READINGS_SQL}, s AS (SELECT DISTINCT sensor_id, parameter_id, h, value FROM latest)
SELECT sensor_id, parameter_id, CAST(h AS DATE) AS date, CAST(hour(h) AS BIGINT) AS hour, round(avg(value), 6) AS hourly_average, count(*) AS number_of_measurements
FROM s GROUP BY sensor_id, parameter_id, h""",
    "pipeline_gold_parameter": f"""WITH p AS ({PARAMETERS_SQL}) SELECT id, name, units, description, coalesce(description, display_name, name) AS display_name FROM p
WHERE id IN (SELECT event_id % {PARAMETERS} FROM events)""",
    "landing_drift_scan": """SELECT event_id AS id, CASE event_id % 3 WHEN 0 THEN CAST(trunc(value) AS DOUBLE) WHEN 1 THEN value END AS value,
  CASE WHEN event_id % 3 = 2 THEN 'x' END AS label, CASE WHEN event_id % 3 = 1 THEN user_id END AS sensor_id FROM events""",
    "archive_then_full_refresh": f"""SELECT CAST(n_nationkey AS BIGINT) AS id, CASE WHEN n_regionkey = 4 THEN NULL ELSE concat('N', n_nationkey) END AS code,
  CASE WHEN n_nationkey % 5 = 0 THEN concat(n_name, '!') ELSE n_name END AS name, n_nationkey IN ({_REGION}) AS kept FROM nation""",
    "pipeline_silver_parameter": f"WITH p AS ({PARAMETERS_SQL}) SELECT id, name, CASE WHEN id % 3 = 0 THEN 'revised' ELSE units END AS units, display_name, description FROM p",
    "pipeline_gold_location": f"""WITH l AS ({LOCATIONS_SQL}), k AS (
  SELECT *, regexp_replace(coalesce(locality, name), '^\\p{{Zs}}+|\\p{{Zs}}+$', '', 'g') AS place FROM l)
SELECT id, name, CASE WHEN id % 3 = 0 THEN 'revised' ELSE owner_name END AS owner_name, coordinates_latitude,
  min(id) OVER (PARTITION BY place, country_id) AS locality_id FROM k""",
    "pipeline_gold_sensor": """SELECT s_suppkey AS id, s_name AS name, CAST(s_nationkey AS BIGINT) AS parameter_id,
  CASE WHEN s_suppkey % 3 = 0 THEN s_acctbal - 1 ELSE s_acctbal END AS summary_min, s_suppkey + 1 AS location_id FROM supplier""",
    "page_flatten": """SELECT user_id AS sensor_id, value, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS period_datetime_from_utc, event_id AS parameter_id,
  event_type AS parameter_name FROM events""",
    "extraction_mark": "SELECT event_id, ts FROM events WHERE ts > (SELECT quantile_disc(ts, 0.5) FROM events)",
}
