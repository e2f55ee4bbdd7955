import pytest

from medallion.operators.dedup import distinct_rows, latest_wins
from tests.conftest import rows


@pytest.mark.parametrize("strategy", ["aggregate", "window"])
def test_latest_keeps_ties_and_drops_nulls(spark, strategy):
    df = spark.createDataFrame(
        [(1, "a", 20), (1, "b", 20), (1, "c", 10), (2, "d", 5), (None, "e", 30), (3, "f", None)],
        "id long, v string, ts long")
    got = latest_wins(df, ["id"], "ts", strategy=strategy)
    assert got.columns == ["id", "v", "ts"]
    assert rows(got) == [(1, "a", 20), (1, "b", 20), (2, "d", 5)]


@pytest.mark.parametrize("strategy", ["aggregate", "window"])
def test_latest_composite_key(spark, strategy):
    df = spark.createDataFrame(
        [(1, "p", "t0", 1, 1.0), (1, "p", "t0", 2, 2.0), (1, "q", "t0", 1, 3.0), (1, "p", "t1", 1, 4.0)],
        "sensor_id long, parameter_id string, period string, ets long, value double")
    got = latest_wins(df, ["sensor_id", "parameter_id", "period"], "ets", strategy=strategy)
    assert rows(got, "value") == [(2.0,), (3.0,), (4.0,)]


def test_distinct_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a")], "k long, v string")
    assert rows(distinct_rows(df)) == [(1, "a"), (2, "a")]
    assert rows(distinct_rows(df, ["v"])) == [("a",)]
