"""Measurement aggregates, locality roll-up and the locality key.

All aggregations are plain ``groupBy().agg()`` with algebraic functions
(avg/min/max/count), so Spark pre-aggregates map-side (partial hash
aggregate) and only one partial row per group and map task crosses the
shuffle: a hot sensor does not pile up in one reducer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.functions.exprs import (
    concat_skip_null,
    hour_of,
    iso_dow,
    locality_name,
    text_date,
    wall_clock,
)


def _measurement_cte(m: DataFrame, *, with_hour: bool) -> DataFrame:
    cols = [
        F.col("sensor_id"),
        text_date("period_datetime_from_utc").alias("measurement_date"),
        F.col("period_interval"),
        F.col("parameter_id"),
        F.col("value"),
    ]
    if with_hour:
        cols.append(hour_of(wall_clock("period_datetime_from_utc")).alias("hour"))
    return m.select(*cols)


def hourly_aggregate(measurements: DataFrame) -> DataFrame:
    """avg/min/max/count of ``value`` per sensor, date, hour, interval, parameter.

    Date and hour are the wall-clock parts of ``period_datetime_from_utc``
    (ISO text or timestamp); ``day_of_week`` is ISO (Monday = 1).
    """
    m = _measurement_cte(measurements, with_hour=True)
    g = m.groupBy("sensor_id", "measurement_date", "hour", "period_interval", "parameter_id").agg(
        F.avg("value").alias("hourly_average"),
        F.min("value").alias("hourly_minimum"),
        F.max("value").alias("hourly_maximum"),
        F.count(F.lit(1)).alias("number_of_measurements"),
    )
    return g.select(
        "sensor_id",
        F.col("measurement_date").alias("date"),
        "period_interval",
        "parameter_id",
        "hour",
        iso_dow(F.col("measurement_date")).alias("day_of_week"),
        "hourly_average",
        "hourly_minimum",
        "hourly_maximum",
        "number_of_measurements",
    )


def daily_aggregate(measurements: DataFrame) -> DataFrame:
    """avg/min/max/count of ``value`` per sensor, date, interval, parameter."""
    m = _measurement_cte(measurements, with_hour=False)
    g = m.groupBy("sensor_id", "measurement_date", "period_interval", "parameter_id").agg(
        F.avg("value").alias("daily_average"),
        F.min("value").alias("daily_minimum"),
        F.max("value").alias("daily_maximum"),
        F.count(F.lit(1)).alias("number_of_measurements"),
    )
    return g.select(
        "sensor_id",
        F.col("measurement_date").alias("date"),
        "period_interval",
        "parameter_id",
        iso_dow(F.col("measurement_date")).alias("day_of_week"),
        "daily_average",
        "daily_minimum",
        "daily_maximum",
        "number_of_measurements",
    )


# ------------------------------------------------------- mergeable state
def partials(measurements: DataFrame, *, hourly: bool) -> DataFrame:
    """The mergeable state of the aggregates: sum, count, least and greatest
    value of each group.  States of disjoint rows merge to the state of all."""
    m = _measurement_cte(measurements, with_hour=hourly).withColumnRenamed("measurement_date", "date")
    return m.groupBy(*state_groups(hourly)).agg(
        F.sum("value").alias("total"), F.count("value").alias("n_values"),
        F.min("value").alias("minimum"), F.max("value").alias("maximum"), F.count(F.lit(1)).alias("n"))


def reading_states(measurements: DataFrame, *, hourly: bool) -> DataFrame:
    """The state of each reading by itself, for :func:`merged_partials`."""
    m = _measurement_cte(measurements, with_hour=hourly).withColumnRenamed("measurement_date", "date")
    return m.select(
        *state_groups(hourly), F.col("value").alias("total"), F.col("value").isNotNull().cast("long").alias("n_values"),
        F.col("value").alias("minimum"), F.col("value").alias("maximum"), F.lit(1).cast("long").alias("n"))


def state_groups(hourly: bool) -> list[str]:
    return ["sensor_id", "date", "period_interval", "parameter_id"] + (["hour"] if hourly else [])


def state_cell(hourly: bool) -> list[str]:
    """The part of a group that follows from a reading's key: a revised
    reading stays in its cell."""
    return [c for c in state_groups(hourly) if c != "period_interval"]


def merged_partials(states: DataFrame, *, hourly: bool) -> DataFrame:
    return states.groupBy(*state_groups(hourly)).agg(
        F.sum("total").alias("total"), F.sum("n_values").alias("n_values"),
        F.min("minimum").alias("minimum"), F.max("maximum").alias("maximum"), F.sum("n").alias("n"))


def finished(state: DataFrame, *, hourly: bool) -> DataFrame:
    """The hourly or daily aggregate that a state stands for."""
    name = "hourly" if hourly else "daily"
    return state.select(
        "sensor_id", "date", "period_interval", "parameter_id", *(["hour"] if hourly else []),
        iso_dow(F.col("date")).alias("day_of_week"),
        F.when(F.col("n_values") > 0, F.col("total") / F.col("n_values")).alias(f"{name}_average"),
        F.col("minimum").alias(f"{name}_minimum"), F.col("maximum").alias(f"{name}_maximum"),
        F.col("n").alias("number_of_measurements"))


def locality_rollup(locations: DataFrame, countries: DataFrame) -> DataFrame:
    """One row per (trimmed locality-or-name, country): the locality table.

    ``id`` is the smallest location id of the group; ``display_name`` is
    ``"<name>, <country code>"`` and keeps the ``", "`` when the country is
    unknown.
    """
    codes = countries.select(F.col("id").alias("__c_id"), F.col("code").alias("__c_code"))
    joined = locations.join(codes, locations["country_id"] == F.col("__c_id"), "left")
    g = joined.groupBy(
        locality_name().alias("name"), F.col("country_id"), F.col("__c_code").alias("code")
    ).agg(
        F.min("id").alias("id"),
        F.avg("coordinates_latitude").alias("coordinates_latitude"),
        F.avg("coordinates_longitude").alias("coordinates_longitude"),
        F.min("datetime_first_utc").alias("datetime_first_utc"),
        F.max("datetime_last_utc").alias("datetime_last_utc"),
    )
    return g.select(
        "country_id",
        "id",
        "name",
        concat_skip_null(F.col("name"), ", ", F.col("code")).alias("display_name"),
        "coordinates_latitude",
        "coordinates_longitude",
        "datetime_first_utc",
        "datetime_last_utc",
    )


def locality_groups(locations: DataFrame) -> DataFrame:
    """The distinct (place, country) groups of the locations."""
    return locations.select(locality_name().alias("place"), F.col("country_id").alias("country")).distinct()


def of_groups(locations: DataFrame, groups: DataFrame) -> DataFrame:
    """The locations of the groups; null places and countries are groups too."""
    cond = locality_name().eqNullSafe(F.col("place")) & F.col("country_id").eqNullSafe(F.col("country"))
    return locations.join(groups, cond, "left_semi")


def with_locality_key(locations: DataFrame, *, out: str = "locality_id") -> DataFrame:
    """Add ``min(id) over (partition by trimmed locality-or-name, country_id)``.

    Written as aggregate + join instead of a window so that no locality's
    rows are buffered in one task: the min is pre-aggregated map-side and
    the join back is null-safe (a window puts null keys in one group too).
    """
    keyed = locations.withColumn("__loc_name", locality_name())
    mins = keyed.groupBy(F.col("__loc_name").alias("__g_name"),
                         F.col("country_id").alias("__g_country")).agg(F.min("id").alias(out))
    cond = (keyed["__loc_name"].eqNullSafe(F.col("__g_name"))
            & keyed["country_id"].eqNullSafe(F.col("__g_country")))
    joined = keyed.join(mins, cond, "left")
    return joined.select(*[keyed[c] for c in locations.columns], F.col(out))
