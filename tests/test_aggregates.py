import datetime as dt

from medallion.operators.aggregates import daily_aggregate, hourly_aggregate, locality_rollup, with_locality_key
from tests.conftest import rows

NBSP = " "
M_SCHEMA = "sensor_id long, parameter_id long, period_interval string, period_datetime_from_utc string, value double"


def test_hourly_and_daily_from_iso_text(spark):
    m = spark.createDataFrame([
        (1, 2, "01:00:00", "2025-12-30T23:05:00+02:00", 1.0),
        (1, 2, "01:00:00", "2025-12-30T23:55:00+02:00", 3.0),
        (1, 2, "01:00:00", "2025-12-30T01:00:00Z", 5.0),
        (1, 2, "01:00:00", "2025-12-28T10:00:00Z", 7.0),
    ], M_SCHEMA)
    h = hourly_aggregate(m)
    assert h.columns == ["sensor_id", "date", "period_interval", "parameter_id", "hour", "day_of_week",
                         "hourly_average", "hourly_minimum", "hourly_maximum", "number_of_measurements"]
    got = rows(h, "date", "hour", "day_of_week", "hourly_average", "number_of_measurements")
    assert got == [(dt.date(2025, 12, 28), 10, 7, 7.0, 1), (dt.date(2025, 12, 30), 1, 2, 5.0, 1),
                   (dt.date(2025, 12, 30), 23, 2, 2.0, 2)]
    d = daily_aggregate(m)
    got = rows(d, "date", "day_of_week", "daily_average", "daily_minimum", "daily_maximum", "number_of_measurements")
    assert got == [(dt.date(2025, 12, 28), 7, 7.0, 7.0, 7.0, 1), (dt.date(2025, 12, 30), 2, 3.0, 1.0, 5.0, 3)]


LOC = ("id long, name string, locality string, country_id long, coordinates_latitude double, "
       "coordinates_longitude double, datetime_first_utc string, datetime_last_utc string")


def test_locality_rollup_null_locality_unmatched_country(spark):
    loc = spark.createDataFrame([
        (5, "A", "Town", 1, 1.0, 2.0, "2024-01-02", "2024-02-01"),
        (3, "B", NBSP + "Town ", 1, 3.0, 4.0, "2024-01-01", "2024-03-01"),
        (7, " X ", None, 1, 5.0, 6.0, "2024-01-05", "2024-01-06"),
        (9, "Y", "Village", 99, 0.0, 0.0, None, None),
    ], LOC)
    c = spark.createDataFrame([(1, "RS")], "id long, code string")
    got = rows(locality_rollup(loc, c), "id", "name", "display_name", "coordinates_latitude",
               "datetime_first_utc", "datetime_last_utc")
    assert got == [(3, "Town", "Town, RS", 2.0, "2024-01-01", "2024-03-01"),
                   (7, "X", "X, RS", 5.0, "2024-01-05", "2024-01-06"),
                   (9, "Village", "Village, ", 0.0, None, None)]


def test_locality_key_is_null_safe_group_min(spark):
    loc = spark.createDataFrame([
        (5, "A", "Town", 1, 0.0, 0.0, None, None),
        (3, "B", "Town ", 1, 0.0, 0.0, None, None),
        (4, "C", "Town", 2, 0.0, 0.0, None, None),
        (8, None, None, None, 0.0, 0.0, None, None),
        (6, None, None, None, 0.0, 0.0, None, None),
    ], LOC)
    got = rows(with_locality_key(loc), "id", "locality_id")
    assert got == [(3, 3), (4, 4), (5, 3), (6, 6), (8, 6)]
