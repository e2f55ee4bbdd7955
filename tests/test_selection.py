import datetime as dt

from pyspark.sql import functions as F

from medallion.operators.selection import fresh_chain, period_between, read_mark, select_children, write_mark
from tests.conftest import rows


def test_control_table_default_then_stored(spark, tmp_path):
    path = str(tmp_path / "control")
    first = spark.range(1).select(read_mark(spark, path, default_days=7).alias("m")).first().m
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert abs((now - dt.timedelta(days=7) - first).total_seconds()) < 120
    write_mark(spark, path, dt.datetime(2025, 12, 30, 6, 0))
    got = spark.range(1).select(read_mark(spark, path).alias("m")).first().m
    assert got == dt.datetime(2025, 12, 30, 6, 0)


def test_period_between_inclusive(spark):
    df = spark.createDataFrame([("2025-12-29T00:00:00Z",), ("2025-12-29T12:00:00Z",), ("2025-12-30T00:00:00Z",),
                                ("2025-12-30T00:00:01Z",)], "f string")
    lo = F.to_timestamp(F.lit("2025-12-29T00:00:00Z"))
    hi = F.to_timestamp(F.lit("2025-12-30T00:00:00Z"))
    assert period_between(df, "f", lo, hi).count() == 3


def test_parent_child_chain(spark):
    locs = spark.createDataFrame([(1, ("2025-12-30T00:00:00Z",)), (2, ("2025-12-01T00:00:00Z",)), (3, None)],
                                 "id long, datetime_last struct<utc:string>")
    sensors = spark.createDataFrame([(10, 1, ("2025-12-30T00:00:00Z",)), (11, 1, ("2025-11-01T00:00:00Z",)),
                                     (20, 2, ("2025-12-30T00:00:00Z",))],
                                    "id long, location_id long, datetime_last struct<utc:string>")
    fresh_locs, fresh_sensors = fresh_chain(locs, sensors, "2025-12-15T00:00:00Z")
    assert rows(fresh_locs) == [(1,)]
    assert rows(fresh_sensors) == [(10,)]
    assert rows(select_children(sensors, "location_id", fresh_locs), "id") == [(10,), (11,)]
