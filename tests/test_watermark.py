import datetime as dt

from pyspark.sql import functions as F

from medallion.operators.merge import empty_like
from medallion.operators.watermark import fresh_ids, high_watermark, incremental_filter, newer_than
from tests.conftest import rows


def test_empty_target_gives_1900(spark):
    t = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "load_timestamp timestamp")
    mark = spark.range(1).select(high_watermark(empty_like(t)).alias("m")).first().m
    assert mark == dt.datetime(1900, 1, 1)
    assert spark.range(1).select(high_watermark(None).alias("m")).first().m == dt.datetime(1900, 1, 1)


def test_newer_than_mark(spark):
    target = spark.createDataFrame([(dt.datetime(2024, 1, 2),), (dt.datetime(2024, 1, 3),)],
                                   "load_timestamp timestamp")
    batch = spark.createDataFrame([(1, dt.datetime(2024, 1, 3)), (2, dt.datetime(2024, 1, 4)), (3, None)],
                                  "id long, load_timestamp timestamp")
    assert rows(incremental_filter(batch, target), "id") == [(2,)]
    assert rows(newer_than(batch, "load_timestamp", high_watermark(None)), "id") == [(1,), (2,)]


def test_fresh_ids_struct_and_dotted_forms(spark):
    nested = spark.createDataFrame(
        [(1, ("2025-01-02T00:00:00Z",)), (2, ("2024-12-31T23:00:00-02:00",)), (3, None), (4, ("2024-12-31T00:00:00Z",))],
        "id long, datetime_last struct<utc:string>")
    mark = "2025-01-01T00:00:00Z"
    assert rows(fresh_ids(nested, mark)) == [(1,), (2,)]
    flat = nested.select("id", F.col("datetime_last.utc").alias("datetime_last.utc"))
    assert rows(fresh_ids(flat, mark)) == [(1,), (2,)]
