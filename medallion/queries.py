"""Driver queries: every operator of the library run over the given tables.

The driver tables stand in for the sensor network:

* measurement <- ``events`` (sensor_id=user_id, parameter_id=event_type,
  period start=ts, value)
* location <- ``supplier`` (country_id=s_nationkey), country <- ``nation``,
  parameter <- ``part`` (measured through ``lineitem.l_partkey``)
* versioned records <- ``orders`` (key o_custkey, version o_orderdate) and
  ``lineitem`` (key l_orderkey+l_linenumber, version l_shipdate)

Each query reads whole tables; slices by time stand for successive load
batches (the feature under test), never for sampling.  Averages are
rounded to 6 places and hour / day-of-week are bigint so the DuckDB oracle
hashes equal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.functions.exprs import instant, iso_text, text_date
from medallion.operators.aggregates import daily_aggregate, hourly_aggregate
from medallion.operators.dedup import latest_wins
from medallion.operators.joins import semi_join
from medallion.operators.merge import append_frame, empty_like, recompute_touched, upsert_frame
from medallion.operators.quality import KeySpec, duplicate_report, key_failures, key_suspects, not_null, relationships, unique
from medallion.operators.selection import period_between
from medallion.operators.watermark import fresh_ids, high_watermark, newer_than
from medallion.plans.models import (
    build_bronze,
    build_gold_country,
    build_gold_locality,
    build_gold_location,
    build_gold_parameter,
    build_silver,
)
from medallion.schemas import landing_schema
from medallion.sources.drift import align_to_schema, union_aligned
from medallion.sources.flatten import dotted_to_snake, flatten_structs

NBSP = "\u00a0"
# Fixed values for the driver tables: the 11 nation keys standing in for the
# region list, and the batch cut points.
REGION_KEYS = (0, 2, 3, 5, 7, 11, 13, 17, 19, 23, 24)
EVENTS_CUT = "2024-01-20 12:00:00"
EVENTS_OVERLAP_FROM = "2024-01-10 00:00:00"
EVENTS_LOADED_BEFORE = "2024-01-15 00:00:00"
ORDERS_TARGET_BEFORE = "1999-01-01 00:00:00"
ORDERS_BATCH_FROM = "1998-01-01 00:00:00"
LINEITEM_CUT = "1999-06-01 00:00:00"
LINEITEM_OVERLAP_FROM = "1998-06-01 00:00:00"
FRESH_EVENTS_MARK = "2024-01-29T00:00:00Z"
FRESH_ORDERS_MARK = "2001-01-01T00:00:00Z"
PERIOD_FROM = "2024-01-10T00:00:00Z"
PERIOD_TO = "2024-01-12T00:00:00Z"


def ts_ntz(text: str) -> Column:
    return F.expr(f"TIMESTAMP_NTZ '{text}'")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _round(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in cols})


# ------------------------------------------------------------------ adapters
def measurements(events: DataFrame) -> DataFrame:
    """Silver-measurement shape from ``events``: one reading per event."""
    return events.select(
        F.col("value"),
        F.lit("01:00:00").alias("period_interval"),
        F.col("ts").alias("period_datetime_from_utc"),
        (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("period_datetime_to_utc"),
        F.col("event_type").alias("parameter_id"),
        F.col("user_id").alias("sensor_id"),
    )


MEASUREMENTS_SQL = """SELECT value, '01:00:00' AS period_interval, ts AS period_datetime_from_utc,
       ts + INTERVAL 1 HOUR AS period_datetime_to_utc, event_type AS parameter_id, user_id AS sensor_id
FROM events"""


def locations(supplier: DataFrame) -> DataFrame:
    """Silver-location shape from ``supplier``: a derived locality that is
    sometimes null and sometimes padded with spaces / no-break spaces."""
    k = F.col("s_suppkey")
    zone = F.concat(F.lit("Zone "), (k % 3).cast("string"))
    locality = (F.when(k % 7 == 0, F.lit(None).cast("string"))
                .when(k % 7 == 1, F.concat(F.lit(NBSP + " "), zone, F.lit(" " + NBSP)))
                .otherwise(zone))
    name = F.when(k % 7 == 0, F.concat(F.lit(" "), F.col("s_name"), F.lit(NBSP))).otherwise(F.col("s_name"))
    first = F.expr("timestampadd(HOUR, s_suppkey, TIMESTAMP_NTZ '2024-01-01 00:00:00')")
    return supplier.select(
        k.alias("id"),
        name.alias("name"),
        locality.alias("locality"),
        F.lit(None).cast("array<struct<id:bigint,name:string>>").alias("instruments"),
        F.col("s_nationkey").alias("country_id"),
        F.col("s_name").alias("owner_name"),
        F.lit("provider").alias("provider_name"),
        F.col("s_acctbal").alias("coordinates_latitude"),
        (-F.col("s_acctbal")).alias("coordinates_longitude"),
        first.alias("datetime_first_utc"),
        F.expr("timestampadd(DAY, 30, timestampadd(HOUR, s_suppkey, TIMESTAMP_NTZ '2024-01-01 00:00:00'))")
        .alias("datetime_last_utc"),
    )


LOCATIONS_SQL = """SELECT s_suppkey AS id,
       CASE WHEN s_suppkey % 7 = 0 THEN concat(' ', s_name, chr(160)) ELSE s_name END AS name,
       CASE WHEN s_suppkey % 7 = 0 THEN NULL
            WHEN s_suppkey % 7 = 1 THEN concat(chr(160), ' ', 'Zone ', CAST(s_suppkey % 3 AS VARCHAR), ' ', chr(160))
            ELSE concat('Zone ', CAST(s_suppkey % 3 AS VARCHAR)) END AS locality,
       s_nationkey AS country_id, s_name AS owner_name, 'provider' AS provider_name,
       s_acctbal AS coordinates_latitude, -s_acctbal AS coordinates_longitude,
       TIMESTAMP '2024-01-01 00:00:00' + s_suppkey * INTERVAL 1 HOUR AS datetime_first_utc,
       TIMESTAMP '2024-01-01 00:00:00' + s_suppkey * INTERVAL 1 HOUR + INTERVAL 30 DAY AS datetime_last_utc
FROM supplier"""


def countries(nation: DataFrame) -> DataFrame:
    """Silver-country shape from ``nation``; region 4 has no code."""
    code = F.when(F.col("n_regionkey") == 4, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")))
    return nation.select(F.col("n_nationkey").alias("id"), code.alias("code"), F.col("n_name").alias("name"))


COUNTRIES_SQL = """SELECT n_nationkey AS id,
       CASE WHEN n_regionkey = 4 THEN NULL ELSE concat('N', CAST(n_nationkey AS VARCHAR)) END AS code,
       n_name AS name
FROM nation"""


def parameters(part: DataFrame) -> DataFrame:
    """Silver-parameter shape from ``part`` with nullable description / display name."""
    return part.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("units"),
        F.when(F.col("p_size") % 3 == 0, F.lit(None).cast("string")).otherwise(F.col("p_type")).alias("display_name"),
        F.when(F.col("p_size") < 25, F.lit(None).cast("string"))
        .otherwise(F.concat(F.col("p_name"), F.lit(" / "), F.col("p_type"))).alias("description"),
    )


PARAMETERS_SQL = """SELECT p_partkey AS id, p_name AS name, p_brand AS units,
       CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_type END AS display_name,
       CASE WHEN p_size < 25 THEN NULL ELSE concat(p_name, ' / ', p_type) END AS description
FROM part"""


# ------------------------------------------------------------------- queries
def q_hourly_aggregate(spark, d):
    return _round(hourly_aggregate(measurements(table(spark, d, "events"))), "hourly_average")


def q_daily_aggregate(spark, d):
    return _round(daily_aggregate(measurements(table(spark, d, "events"))), "daily_average")


def q_latest_single_key(spark, d):
    return latest_wins(table(spark, d, "orders"), ["o_custkey"], "o_orderdate")


def q_latest_composite_key(spark, d):
    return latest_wins(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate")


def q_latest_composite_key_window(spark, d):
    return latest_wins(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate",
                       strategy="window")


def q_locality_rollup(spark, d):
    loc = locations(table(spark, d, "supplier"))
    out = build_gold_locality(loc, countries(table(spark, d, "nation")))
    return _round(out, "coordinates_latitude", "coordinates_longitude")


def q_locality_window_key(spark, d):
    return build_gold_location(locations(table(spark, d, "supplier"))).drop("instruments")


def q_region_filter(spark, d):
    return build_gold_country(countries(table(spark, d, "nation")), country_ids=REGION_KEYS)


def q_has_data_semi(spark, d):
    return semi_join(table(spark, d, "orders"), table(spark, d, "lineitem"), ["o_orderkey"], ["l_orderkey"])


def q_gold_parameter(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_partkey").alias("parameter_id"))
    return build_gold_parameter(parameters(table(spark, d, "part")), li)


def q_distinct_measurement(spark, d):
    m = measurements(table(spark, d, "events"))
    first = m.where(F.col("period_datetime_from_utc") < ts_ntz(EVENTS_CUT))
    again = m.where(F.col("period_datetime_from_utc") >= ts_ntz(EVENTS_OVERLAP_FROM))
    return build_silver(first.unionByName(again), "measurement").drop("measurement_date")


def q_flatten_rename(spark, d):
    ev = table(spark, d, "events")
    nested = ev.select(
        F.col("event_id").alias("id"),
        F.struct(F.struct(F.col("ts").alias("utc")).alias("datetime_from"),
                 F.lit("1h").alias("label")).alias("period"),
        F.struct(F.col("event_type").alias("name"), F.col("user_id").alias("id")).alias("parameter"),
        F.from_json("props", "k bigint").alias("props"),
    )
    return dotted_to_snake(flatten_structs(nested))


def q_watermark_filter(spark, d):
    ev = table(spark, d, "events")
    loaded = ev.where(F.col("ts") < ts_ntz(EVENTS_LOADED_BEFORE))
    return newer_than(ev, "ts", high_watermark(loaded, "ts"))


def q_watermark_empty_target(spark, d):
    ev = table(spark, d, "events")
    return newer_than(ev, "ts", high_watermark(empty_like(ev), "ts"))


def q_upsert_single(spark, d):
    o = table(spark, d, "orders")
    target = o.where(F.col("o_orderdate") < ts_ntz(ORDERS_TARGET_BEFORE))
    batch = (o.where(F.col("o_orderdate") >= ts_ntz(ORDERS_BATCH_FROM))
             .withColumn("o_totalprice", F.col("o_totalprice") + F.lit(1.0)))
    return upsert_frame(target, batch, ["o_orderkey"])


def q_upsert_composite(spark, d):
    li = table(spark, d, "lineitem")
    target = li.where(F.col("l_shipdate") < ts_ntz(LINEITEM_CUT))
    batch = (li.where(F.col("l_shipdate") >= ts_ntz(LINEITEM_OVERLAP_FROM))
             .withColumn("l_quantity", F.col("l_quantity") + F.lit(1.0)))
    return upsert_frame(target, batch, ["l_orderkey", "l_linenumber"])


def q_append_batches(spark, d):
    ev = table(spark, d, "events")
    first = ev.where(F.col("ts") < ts_ntz(EVENTS_CUT))
    second = ev.where(F.col("ts") >= ts_ntz(EVENTS_CUT))
    return append_frame(first, second)


def q_empty_batch(spark, d):
    o = table(spark, d, "orders")
    return upsert_frame(o, empty_like(o), ["o_orderkey"])


def _two_batches(spark, d):
    m = measurements(table(spark, d, "events"))
    first = m.where(F.col("period_datetime_from_utc") < ts_ntz(EVENTS_CUT))
    second = m.where(F.col("period_datetime_from_utc") >= ts_ntz(EVENTS_CUT))
    return m, first, second


def q_incremental_daily_recompute(spark, d):
    m, first, second = _two_batches(spark, d)
    target = daily_aggregate(first)
    touched = second.select(text_date("period_datetime_from_utc").alias("date")).distinct()
    out = recompute_touched(target, m, touched, "date", daily_aggregate,
                            source_column=text_date("period_datetime_from_utc"))
    return _round(out, "daily_average")


def q_incremental_daily_append(spark, d):
    _, first, second = _two_batches(spark, d)
    return _round(append_frame(daily_aggregate(first), daily_aggregate(second)), "daily_average")


def _last_seen(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Entity rows with ``datetime_last.utc`` as ISO text (as landed from the API)."""
    return (df.groupBy(key).agg(F.max(ts).alias("__last"))
            .select(F.col(key).alias("id"), F.struct(iso_text(F.col("__last")).alias("utc")).alias("datetime_last")))


def q_fresh_ids(spark, d):
    return fresh_ids(_last_seen(table(spark, d, "events"), "user_id", "ts"), FRESH_EVENTS_MARK)


def q_parent_child_selection(spark, d):
    orders = table(spark, d, "orders")
    fresh = fresh_ids(_last_seen(orders, "o_custkey", "o_orderdate"), FRESH_ORDERS_MARK)
    their_orders = semi_join(orders, fresh, ["o_custkey"], ["id"], dedup=False)
    return semi_join(table(spark, d, "lineitem"), their_orders, ["l_orderkey"], ["o_orderkey"], dedup=False)


def q_dq_unique(spark, d):
    return unique(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_dq_not_null(spark, d):
    return not_null(locations(table(spark, d, "supplier")), "locality").select("id", "name", "locality", "country_id")


def q_dq_relationships(spark, d):
    gold_country = build_gold_country(countries(table(spark, d, "nation")), country_ids=REGION_KEYS)
    return relationships(locations(table(spark, d, "supplier")), "country_id", gold_country, "id")


def _key_specs(spark, d):
    return [
        KeySpec("orders_by_customer", table(spark, d, "orders"), ("o_custkey",)),
        KeySpec("lineitem", table(spark, d, "lineitem"), ("l_orderkey", "l_linenumber")),
        KeySpec("customer", table(spark, d, "customer"), ("c_custkey",)),
        KeySpec("nation_by_region", table(spark, d, "nation"), ("n_regionkey",)),
        KeySpec("part_by_brand", table(spark, d, "part"), ("p_brand",)),
        KeySpec("events_by_user_type", table(spark, d, "events"), ("user_id", "event_type")),
    ]


def q_duplicate_report(spark, d):
    return duplicate_report(_key_specs(spark, d))


def q_dq_key_tests(spark, d):
    """Unique and not-null failures of several tables from one scan of each; a
    location's locality is a key with nulls here."""
    specs = [*_key_specs(spark, d), KeySpec("location_by_locality", locations(table(spark, d, "supplier")), ("locality", "country_id"))]
    return key_failures(key_suspects(specs)).select("table_name", "unique", "not_null")


def q_schema_drift_union(spark, d):
    li = table(spark, d, "lineitem")
    older = li.where(F.col("l_shipdate") < ts_ntz(LINEITEM_CUT)).select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("bigint").alias("qty"))
    newer = li.where(F.col("l_shipdate") >= ts_ntz(LINEITEM_CUT)).select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("qty"), "l_tax")
    target = "l_orderkey bigint, l_linenumber int, qty double, l_tax double"
    from pyspark.sql.types import _parse_datatype_string

    return union_aligned([older, newer], _parse_datatype_string(target))


def landed_measurements(lineitem: DataFrame) -> DataFrame:
    """Landed measurement pages (dotted column names) from ``lineitem``: a line
    is a reading of sensor ``l_orderkey`` for parameter ``l_linenumber``; a
    line shipped again is a re-extraction of the same reading
    (``extraction_timestamp`` = ``l_shipdate``)."""
    raw = lineitem.select(
        F.col("l_quantity").alias("value"),
        F.lit("raw").alias("period.label"),
        F.lit("01:00:00").alias("period.interval"),
        F.lit("2024-01-01T00:00:00Z").alias("period.datetime_from.utc"),
        F.lit("2024-01-01T01:00:00Z").alias("period.datetime_to.utc"),
        F.col("l_linenumber").cast("bigint").alias("parameter.id"),
        F.col("l_returnflag").alias("parameter.name"),
        F.col("l_orderkey").alias("sensor_id"),
        F.col("l_shipdate").cast("timestamp").alias("extraction_timestamp"),
    )
    return align_to_schema(raw, landing_schema("measurement"))


def q_bronze_measurement_latest(spark, d):
    bronze = build_bronze(landed_measurements(table(spark, d, "lineitem")), "measurement")
    return bronze.select("sensor_id", "parameter_id", "parameter_name", "period_datetime_from_utc", "value",
                         "measurement_date")


def q_period_range(spark, d):
    return period_between(table(spark, d, "events"), "ts", instant(F.lit(PERIOD_FROM)), instant(F.lit(PERIOD_TO)))


def q_filtered_watermark(spark, d):
    o = table(spark, d, "orders")
    loaded = o.where(F.col("o_orderdate") < ts_ntz(ORDERS_BATCH_FROM))
    return newer_than(o.where(F.col("o_orderstatus").isin("F", "P")), "o_orderdate",
                      high_watermark(loaded, "o_orderdate"))


def q_hourly_aggregate_iso_text(spark, d):
    """The period start as landed: ISO text with a +02:00 offset.  Date and
    hour are the text's wall clock (the offset is ignored)."""
    m = measurements(table(spark, d, "events")).withColumn(
        "period_datetime_from_utc", F.date_format("period_datetime_from_utc", "yyyy-MM-dd'T'HH:mm:ss'+02:00'"))
    return _round(hourly_aggregate(m), "hourly_average")


def q_dq_relationships_null_fk(spark, d):
    """Null foreign keys are not failures of a relationship test."""
    loc = locations(table(spark, d, "supplier")).withColumn(
        "country_id", F.when(F.col("id") % 5 == 0, F.lit(None).cast("int")).otherwise(F.col("country_id")))
    gold_country = build_gold_country(countries(table(spark, d, "nation")), country_ids=REGION_KEYS)
    return relationships(loc, "country_id", gold_country, "id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "hourly_aggregate": q_hourly_aggregate,
    "daily_aggregate": q_daily_aggregate,
    "latest_single_key": q_latest_single_key,
    "latest_composite_key": q_latest_composite_key,
    "latest_composite_key_window": q_latest_composite_key_window,
    "locality_rollup": q_locality_rollup,
    "locality_window_key": q_locality_window_key,
    "region_filter": q_region_filter,
    "has_data_semi": q_has_data_semi,
    "gold_parameter": q_gold_parameter,
    "distinct_measurement": q_distinct_measurement,
    "flatten_rename": q_flatten_rename,
    "watermark_filter": q_watermark_filter,
    "watermark_empty_target": q_watermark_empty_target,
    "upsert_single": q_upsert_single,
    "upsert_composite": q_upsert_composite,
    "append_batches": q_append_batches,
    "empty_batch": q_empty_batch,
    "incremental_daily_recompute": q_incremental_daily_recompute,
    "incremental_daily_append": q_incremental_daily_append,
    "fresh_ids": q_fresh_ids,
    "parent_child_selection": q_parent_child_selection,
    "dq_unique": q_dq_unique,
    "dq_not_null": q_dq_not_null,
    "dq_key_tests": q_dq_key_tests,
    "dq_relationships": q_dq_relationships,
    "duplicate_report": q_duplicate_report,
    "schema_drift_union": q_schema_drift_union,
    "bronze_measurement_latest": q_bronze_measurement_latest,
    "period_range": q_period_range,
    "filtered_watermark": q_filtered_watermark,
    "hourly_aggregate_iso_text": q_hourly_aggregate_iso_text,
    "dq_relationships_null_fk": q_dq_relationships_null_fk,
}

_REGION = ", ".join(str(k) for k in REGION_KEYS)
_ORDERS_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
_LINEITEM_COLS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, "
                  "l_tax, l_returnflag, l_linestatus, l_shipdate")

_HOURLY_SQL = """SELECT sensor_id, CAST(period_datetime_from_utc AS DATE) AS date, period_interval, parameter_id,
       CAST(hour(period_datetime_from_utc) AS BIGINT) AS hour,
       CAST(isodow(CAST(period_datetime_from_utc AS DATE)) AS BIGINT) AS day_of_week,
       round(avg(value), 6) AS hourly_average, min(value) AS hourly_minimum, max(value) AS hourly_maximum,
       count(*) AS number_of_measurements
FROM m
GROUP BY sensor_id, CAST(period_datetime_from_utc AS DATE), hour(period_datetime_from_utc), period_interval, parameter_id"""


def _daily_sql(src: str) -> str:
    return f"""SELECT sensor_id, CAST(period_datetime_from_utc AS DATE) AS date, period_interval, parameter_id,
       CAST(isodow(CAST(period_datetime_from_utc AS DATE)) AS BIGINT) AS day_of_week,
       round(avg(value), 6) AS daily_average, min(value) AS daily_minimum, max(value) AS daily_maximum,
       count(*) AS number_of_measurements
FROM {src}
GROUP BY sensor_id, CAST(period_datetime_from_utc AS DATE), period_interval, parameter_id"""


def _last_seen_sql(tbl: str, key: str, ts: str) -> str:
    return f"SELECT {key} AS id, max({ts}) AS last_ts FROM {tbl} GROUP BY {key}"


ORACLE_SQL: dict[str, str] = {
    "hourly_aggregate": f"WITH m AS ({MEASUREMENTS_SQL})\n{_HOURLY_SQL}",
    "daily_aggregate": f"WITH m AS ({MEASUREMENTS_SQL})\n{_daily_sql('m')}",
    "latest_single_key": f"""SELECT {_ORDERS_COLS} FROM orders
WHERE (o_custkey, o_orderdate) IN (SELECT o_custkey, max(o_orderdate) FROM orders GROUP BY o_custkey)""",
    "latest_composite_key": f"""SELECT {_LINEITEM_COLS} FROM lineitem
WHERE (l_orderkey, l_linenumber, l_shipdate) IN
      (SELECT l_orderkey, l_linenumber, max(l_shipdate) FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
    "latest_composite_key_window": f"""SELECT {_LINEITEM_COLS} FROM lineitem
WHERE (l_orderkey, l_linenumber, l_shipdate) IN
      (SELECT l_orderkey, l_linenumber, max(l_shipdate) FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
    "locality_rollup": f"""WITH l AS ({LOCATIONS_SQL}), c AS ({COUNTRIES_SQL})
SELECT l.country_id, min(l.id) AS id, trim(coalesce(l.locality, l.name)) AS name,
       concat(trim(coalesce(l.locality, l.name)), ', ', c.code) AS display_name,
       round(avg(l.coordinates_latitude), 6) AS coordinates_latitude,
       round(avg(l.coordinates_longitude), 6) AS coordinates_longitude,
       min(l.datetime_first_utc) AS datetime_first_utc, max(l.datetime_last_utc) AS datetime_last_utc
FROM l LEFT JOIN c ON l.country_id = c.id
GROUP BY trim(coalesce(l.locality, l.name)), l.country_id, c.code""",
    "locality_window_key": f"""WITH l AS ({LOCATIONS_SQL})
SELECT id, name, owner_name, provider_name, coordinates_latitude, coordinates_longitude,
       datetime_first_utc, datetime_last_utc,
       min(id) OVER (PARTITION BY trim(coalesce(locality, name)), country_id) AS locality_id
FROM l""",
    "region_filter": f"WITH c AS ({COUNTRIES_SQL}) SELECT id, code, name FROM c WHERE id IN ({_REGION})",
    "has_data_semi": f"SELECT {_ORDERS_COLS} FROM orders WHERE o_orderkey IN (SELECT DISTINCT l_orderkey FROM lineitem)",
    "gold_parameter": f"""WITH p AS ({PARAMETERS_SQL})
SELECT id, name, units, description, coalesce(description, display_name, name) AS display_name
FROM p WHERE id IN (SELECT DISTINCT l_partkey FROM lineitem)""",
    "distinct_measurement": f"""WITH m AS ({MEASUREMENTS_SQL})
SELECT DISTINCT value, period_interval, period_datetime_from_utc, period_datetime_to_utc, parameter_id, sensor_id
FROM (SELECT * FROM m WHERE period_datetime_from_utc < TIMESTAMP '{EVENTS_CUT}'
      UNION ALL
      SELECT * FROM m WHERE period_datetime_from_utc >= TIMESTAMP '{EVENTS_OVERLAP_FROM}')""",
    "flatten_rename": """SELECT event_id AS id, ts AS period_datetime_from_utc, '1h' AS period_label,
       event_type AS parameter_name, user_id AS parameter_id, CAST(props ->> 'k' AS BIGINT) AS props_k
FROM events""",
    "watermark_filter": f"""SELECT * FROM events
WHERE ts > (SELECT coalesce(max(ts), TIMESTAMP '1900-01-01') FROM events WHERE ts < TIMESTAMP '{EVENTS_LOADED_BEFORE}')""",
    "watermark_empty_target": """SELECT * FROM events
WHERE ts > (SELECT coalesce(max(ts), TIMESTAMP '1900-01-01') FROM events WHERE 1 = 0)""",
    "upsert_single": f"""WITH t AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{ORDERS_TARGET_BEFORE}'),
b AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1.0 AS o_totalprice, o_orderdate, o_orderpriority
      FROM orders WHERE o_orderdate >= TIMESTAMP '{ORDERS_BATCH_FROM}')
SELECT {_ORDERS_COLS} FROM t WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.o_orderkey = t.o_orderkey)
UNION ALL
SELECT {_ORDERS_COLS} FROM b""",
    "upsert_composite": f"""WITH t AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '{LINEITEM_CUT}'),
b AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity + 1.0 AS l_quantity, l_extendedprice,
             l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
      FROM lineitem WHERE l_shipdate >= TIMESTAMP '{LINEITEM_OVERLAP_FROM}')
SELECT {_LINEITEM_COLS} FROM t
WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.l_orderkey = t.l_orderkey AND b.l_linenumber = t.l_linenumber)
UNION ALL
SELECT {_LINEITEM_COLS} FROM b""",
    "append_batches": f"""SELECT * FROM events WHERE ts < TIMESTAMP '{EVENTS_CUT}'
UNION ALL
SELECT * FROM events WHERE ts >= TIMESTAMP '{EVENTS_CUT}'""",
    "empty_batch": f"""SELECT {_ORDERS_COLS} FROM orders t
WHERE NOT EXISTS (SELECT 1 FROM (SELECT * FROM orders WHERE 1 = 0) b WHERE b.o_orderkey = t.o_orderkey)
UNION ALL
SELECT {_ORDERS_COLS} FROM orders WHERE 1 = 0""",
    "incremental_daily_recompute": f"WITH m AS ({MEASUREMENTS_SQL})\n{_daily_sql('m')}",
    "incremental_daily_append": f"""WITH m AS ({MEASUREMENTS_SQL}),
m1 AS (SELECT * FROM m WHERE period_datetime_from_utc < TIMESTAMP '{EVENTS_CUT}'),
m2 AS (SELECT * FROM m WHERE period_datetime_from_utc >= TIMESTAMP '{EVENTS_CUT}')
{_daily_sql('m1')}
UNION ALL
{_daily_sql('m2')}""",
    "fresh_ids": f"""SELECT id FROM ({_last_seen_sql('events', 'user_id', 'ts')})
WHERE last_ts > TIMESTAMP '{FRESH_EVENTS_MARK[:-1].replace('T', ' ')}'""",
    "parent_child_selection": f"""SELECT {_LINEITEM_COLS} FROM lineitem
WHERE l_orderkey IN (
  SELECT o_orderkey FROM orders WHERE o_custkey IN (
    SELECT id FROM ({_last_seen_sql('orders', 'o_custkey', 'o_orderdate')})
    WHERE last_ts > TIMESTAMP '{FRESH_ORDERS_MARK[:-1].replace('T', ' ')}'))""",
    "dq_unique": """SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "dq_key_tests": f"""WITH g AS (
  SELECT 'orders_by_customer' AS table_name, count(*) AS n, o_custkey IS NULL AS no_key FROM orders GROUP BY o_custkey
  UNION ALL SELECT 'lineitem', count(*), l_orderkey IS NULL OR l_linenumber IS NULL FROM lineitem GROUP BY l_orderkey, l_linenumber
  UNION ALL SELECT 'customer', count(*), c_custkey IS NULL FROM customer GROUP BY c_custkey
  UNION ALL SELECT 'nation_by_region', count(*), n_regionkey IS NULL FROM nation GROUP BY n_regionkey
  UNION ALL SELECT 'part_by_brand', count(*), p_brand IS NULL FROM part GROUP BY p_brand
  UNION ALL SELECT 'events_by_user_type', count(*), user_id IS NULL OR event_type IS NULL FROM events GROUP BY user_id, event_type
  UNION ALL SELECT 'location_by_locality', count(*), locality IS NULL OR country_id IS NULL FROM ({LOCATIONS_SQL}) GROUP BY locality, country_id)
SELECT table_name, CAST(count(*) FILTER (NOT no_key AND n > 1) AS BIGINT) AS "unique", CAST(coalesce(sum(n) FILTER (no_key), 0) AS BIGINT) AS not_null
FROM g GROUP BY table_name HAVING count(*) FILTER (no_key OR n > 1) > 0""",
    "dq_not_null": f"WITH l AS ({LOCATIONS_SQL}) SELECT id, name, locality, country_id FROM l WHERE locality IS NULL",
    "dq_relationships": f"""WITH l AS ({LOCATIONS_SQL}), c AS ({COUNTRIES_SQL}),
g AS (SELECT id FROM c WHERE id IN ({_REGION}))
SELECT l.country_id AS from_field FROM l
WHERE l.country_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM g WHERE g.id = l.country_id)""",
    "duplicate_report": """SELECT CAST(o_custkey AS VARCHAR) AS id, 'orders_by_customer' AS table_name, count(*) AS count
FROM orders GROUP BY o_custkey HAVING count(*) > 1
UNION
SELECT concat(l_orderkey, '|', l_linenumber), 'lineitem', count(*) FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION
SELECT CAST(c_custkey AS VARCHAR), 'customer', count(*) FROM customer GROUP BY c_custkey HAVING count(*) > 1
UNION
SELECT CAST(n_regionkey AS VARCHAR), 'nation_by_region', count(*) FROM nation GROUP BY n_regionkey HAVING count(*) > 1
UNION
SELECT p_brand, 'part_by_brand', count(*) FROM part GROUP BY p_brand HAVING count(*) > 1
UNION
SELECT concat(user_id, '|', event_type), 'events_by_user_type', count(*) FROM events
GROUP BY user_id, event_type HAVING count(*) > 1""",
    "schema_drift_union": f"""SELECT l_orderkey, l_linenumber, CAST(CAST(l_quantity AS BIGINT) AS DOUBLE) AS qty,
       CAST(NULL AS DOUBLE) AS l_tax
FROM lineitem WHERE l_shipdate < TIMESTAMP '{LINEITEM_CUT}'
UNION ALL
SELECT l_orderkey, l_linenumber, l_quantity AS qty, l_tax FROM lineitem WHERE l_shipdate >= TIMESTAMP '{LINEITEM_CUT}'""",
    "bronze_measurement_latest": """SELECT l_orderkey AS sensor_id, CAST(l_linenumber AS BIGINT) AS parameter_id,
       l_returnflag AS parameter_name, '2024-01-01T00:00:00Z' AS period_datetime_from_utc, l_quantity AS value,
       DATE '2024-01-01' AS measurement_date
FROM lineitem
WHERE (l_orderkey, l_linenumber, l_shipdate) IN
      (SELECT l_orderkey, l_linenumber, max(l_shipdate) FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
    "period_range": f"""SELECT * FROM events
WHERE ts BETWEEN TIMESTAMP '{PERIOD_FROM[:-1].replace('T', ' ')}' AND TIMESTAMP '{PERIOD_TO[:-1].replace('T', ' ')}'""",
    "filtered_watermark": f"""SELECT * FROM orders
WHERE o_orderstatus IN ('F', 'P')
  AND o_orderdate > (SELECT coalesce(max(o_orderdate), TIMESTAMP '1900-01-01') FROM orders
                     WHERE o_orderdate < TIMESTAMP '{ORDERS_BATCH_FROM}')""",
    "hourly_aggregate_iso_text": """WITH m AS (
  SELECT value, '01:00:00' AS period_interval, strftime(ts, '%Y-%m-%dT%H:%M:%S+02:00') AS period_datetime_from_utc,
         event_type AS parameter_id, user_id AS sensor_id
  FROM events)
SELECT sensor_id, CAST(period_datetime_from_utc AS DATE) AS date, period_interval, parameter_id,
       CAST(hour(CAST(period_datetime_from_utc AS TIMESTAMP)) AS BIGINT) AS hour,
       CAST(isodow(CAST(period_datetime_from_utc AS DATE)) AS BIGINT) AS day_of_week,
       round(avg(value), 6) AS hourly_average, min(value) AS hourly_minimum, max(value) AS hourly_maximum,
       count(*) AS number_of_measurements
FROM m
GROUP BY sensor_id, CAST(period_datetime_from_utc AS DATE), hour(CAST(period_datetime_from_utc AS TIMESTAMP)),
         period_interval, parameter_id""",
    "dq_relationships_null_fk": f"""WITH l AS (
  SELECT s_suppkey AS id, CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE s_nationkey END AS country_id FROM supplier),
g AS (SELECT n_nationkey AS id FROM nation WHERE n_nationkey IN ({_REGION}))
SELECT l.country_id AS from_field FROM l
WHERE l.country_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM g WHERE g.id = l.country_id)""",
}
