"""The bronze / silver / gold models as pure DataFrame builders.

Every builder takes DataFrames (and a load timestamp) and returns a lazy
DataFrame; nothing here runs a job.  :mod:`medallion.plans.runner`
decides what to read and how to write.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.functions.exprs import col_of, display_name, text_date, utc_lit
from medallion.operators.aggregates import (
    daily_aggregate,
    hourly_aggregate,
    locality_rollup,
    with_locality_key,
)
from medallion.operators.dedup import distinct_rows, latest_wins, not_null, resolve_repeated
from medallion.operators.joins import semi_join
from medallion.operators.watermark import newer_than
from medallion.schemas import ENTITY_KEYS, EXTRACTION_TS, LOAD_TS, landed_columns
from medallion.sources.flatten import snake_name

# Ids of the countries the gold layer keeps (the region list).
DEFAULT_COUNTRY_IDS = (132, 110, 103, 80, 75, 65, 131, 62, 74, 97, 104)

# Partition column added to measurement tables (date part of the period start).
MEASUREMENT_DATE = "measurement_date"

# The columns of the silver and gold tables.
SILVER_COLUMNS: dict[str, list[str]] = {
    "country": ["id", "code", "name"],
    "parameter": ["id", "name", "units", "display_name", "description"],
    "location": ["id", "name", "locality", "instruments", "country_id", "owner_name", "provider_name",
                 "coordinates_latitude", "coordinates_longitude", "datetime_first_utc", "datetime_last_utc"],
    "sensor": ["id", "name", "parameter_id", "datetime_first_utc", "datetime_last_utc",
               "latest_datetime_utc", "latest_value", "summary_min", "summary_q02", "summary_q25",
               "summary_median", "summary_q75", "summary_q98", "summary_max", "summary_avg", "summary_sd",
               "location_id"],
    "measurement": ["value", "period_interval", "period_datetime_from_utc", "period_datetime_to_utc",
                    "parameter_id", "sensor_id"],
}

GOLD_LOCATION_COLUMNS = ["id", "name", "instruments", "owner_name", "provider_name", "coordinates_latitude",
                         "coordinates_longitude", "datetime_first_utc", "datetime_last_utc"]


def _stamp(df: DataFrame, load_ts) -> DataFrame:
    if load_ts is None:
        return df
    ts = load_ts if isinstance(load_ts, Column) else utc_lit(load_ts)
    return df.withColumn(LOAD_TS, ts)


def with_measurement_date(df: DataFrame) -> DataFrame:
    return df.withColumn(MEASUREMENT_DATE, text_date("period_datetime_from_utc"))


# ---------------------------------------------------------------- bronze
def bronze_rename(raw: DataFrame, entity: str) -> DataFrame:
    """Flatten-rename: ``"a.b.c"`` -> ``a_b_c`` for the entity's landed columns.

    Renaming happens before any filter, so later predicates use the new names.
    """
    cols = [col_of(c).alias(snake_name(c)) for c in landed_columns(entity)]
    return raw.select(*cols, col_of(EXTRACTION_TS))


def build_bronze(raw: DataFrame, entity: str, *, load_ts=None, mark: Column | None = None,
                 strategy: str = "aggregate", versioned: bool = False, repeated: DataFrame | None = None) -> DataFrame:
    """Latest version of every key of the landed rows of ``entity``.

    ``mark``: keep only rows extracted after it (high-water mark).  Ties on
    the newest extraction time are all kept; sensors are also de-duplicated
    on their full row.  ``versioned``: the rows of the bronze tables, which
    keep the extraction time, so that later loads can tell which version is
    newer, and hold equal rows once, so that a page loaded again adds nothing.
    ``repeated``, with ``versioned``: the keys that several landed rows have, if
    they are few.
    """
    df = bronze_rename(raw, entity)
    if mark is not None:
        df = newer_than(df, EXTRACTION_TS, mark)
    keys = ENTITY_KEYS[entity]
    if versioned:
        df = resolve_repeated(df.where(not_null(keys, EXTRACTION_TS)), keys, repeated,
                              lambda d: distinct_rows(latest_wins(d, keys, EXTRACTION_TS, strategy=strategy)))
    else:
        df = latest_wins(df, keys, EXTRACTION_TS, strategy=strategy).drop(EXTRACTION_TS)
        if entity == "sensor":
            df = distinct_rows(df)
    df = _stamp(df, load_ts)
    if entity == "measurement":
        df = with_measurement_date(df)
    return df


# ---------------------------------------------------------------- silver
def build_silver(bronze: DataFrame, entity: str, *, load_ts=None, repeated: DataFrame | None = None) -> DataFrame:
    """Column pruning of a bronze table; measurements are also made distinct.
    ``repeated``: the keys that several of them have, if they are few."""
    df = bronze.select(*SILVER_COLUMNS[entity])
    if entity == "measurement":
        df = resolve_repeated(df, ENTITY_KEYS[entity], repeated, distinct_rows)
    df = _stamp(df, load_ts)
    if entity == "measurement":
        df = with_measurement_date(df)
    return df


# ------------------------------------------------------------------ gold
def build_gold_country(silver_country: DataFrame, *, country_ids: Sequence[int] = DEFAULT_COUNTRY_IDS,
                       load_ts=None) -> DataFrame:
    df = silver_country.where(F.col("id").isin(list(country_ids))).select("id", "code", "name")
    return _stamp(df, load_ts)


def build_gold_parameter(silver_parameter: DataFrame, silver_measurement: DataFrame, *,
                         load_ts=None) -> DataFrame:
    """Parameters that have at least one measurement, with a display name
    falling back description -> display_name -> name."""
    df = semi_join(silver_parameter, silver_measurement.select("parameter_id"), ["id"], ["parameter_id"])
    df = df.select("id", "name", "units", "description",
                   display_name("description", "display_name", "name").alias("display_name"))
    return _stamp(df, load_ts)


def build_gold_location(silver_location: DataFrame, *, load_ts=None) -> DataFrame:
    keyed = with_locality_key(silver_location)
    return _stamp(keyed.select(*GOLD_LOCATION_COLUMNS, "locality_id"), load_ts)


def build_gold_locality(silver_location: DataFrame, silver_country: DataFrame, *, load_ts=None) -> DataFrame:
    return _stamp(locality_rollup(silver_location, silver_country), load_ts)


def build_gold_sensor(silver_sensor: DataFrame, *, load_ts=None) -> DataFrame:
    return _stamp(silver_sensor.select(*SILVER_COLUMNS["sensor"]), load_ts)


def build_gold_measurement(silver_measurement: DataFrame, *, load_ts=None, repeated: DataFrame | None = None) -> DataFrame:
    df = resolve_repeated(silver_measurement.select(*SILVER_COLUMNS["measurement"]), ENTITY_KEYS["measurement"], repeated, distinct_rows)
    return with_measurement_date(_stamp(df, load_ts))


def build_hourly(silver_measurement: DataFrame, *, load_ts=None) -> DataFrame:
    return _stamp(hourly_aggregate(silver_measurement), load_ts)


def build_daily(silver_measurement: DataFrame, *, load_ts=None) -> DataFrame:
    return _stamp(daily_aggregate(silver_measurement), load_ts)


# -------------------------------------------------------------- registry
@dataclass(frozen=True)
class Model:
    """One table of the pipeline: where it lives, its grain, how it loads."""

    name: str
    layer: str
    alias: str
    keys: tuple[str, ...] = ()
    partition_by: str | None = None
    inputs: tuple[str, ...] = ()
    entity: str | None = None


MEASUREMENT_KEY = tuple(ENTITY_KEYS["measurement"])

MODELS: list[Model] = [
    *[Model(f"bronze_{e}", "bronze", e, tuple(ENTITY_KEYS[e]),
            MEASUREMENT_DATE if e == "measurement" else None, (), e)
      for e in ("country", "parameter", "location", "sensor", "measurement")],
    *[Model(f"silver_{e}", "silver", e, ("id",), None, (f"bronze_{e}",), e)
      for e in ("country", "parameter", "location", "sensor")],
    Model("silver_measurement", "silver", "measurement", MEASUREMENT_KEY, MEASUREMENT_DATE,
          ("bronze_measurement",), "measurement"),
    Model("gold_country", "gold", "country", ("id",), None, ("silver_country",)),
    Model("gold_parameter", "gold", "parameter", ("id",), None,
          ("silver_parameter", "silver_measurement")),
    Model("gold_location", "gold", "location", ("id",), None, ("silver_location",)),
    Model("gold_locality", "gold", "locality", ("id",), None, ("silver_location", "silver_country")),
    Model("gold_sensor", "gold", "sensor", ("id",), None, ("silver_sensor",)),
    Model("gold_measurement", "gold", "measurement", MEASUREMENT_KEY, MEASUREMENT_DATE,
          ("silver_measurement",)),
    Model("gold_measurement_hourly_aggregate", "gold", "measurement_hourly_aggregate", (), "date",
          ("silver_measurement",)),
    Model("gold_measurement_daily_aggregate", "gold", "measurement_daily_aggregate", (), "date",
          ("silver_measurement",)),
]

MODELS_BY_NAME = {m.name: m for m in MODELS}
LAYERS = ("bronze", "silver", "gold")
