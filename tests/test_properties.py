"""Property tests: operators against brute force on random small inputs."""

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from medallion.functions import text_date
from medallion.operators.aggregates import daily_aggregate
from medallion.operators.dedup import latest_wins
from medallion.operators.merge import append_frame, recompute_touched, upsert_frame
from tests.conftest import null_last, rows

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

versions = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)),
                              st.one_of(st.none(), st.integers(0, 3)),
                              st.integers(0, 1000)), min_size=0, max_size=30)


def brute_latest(data):
    best = defaultdict(lambda: None)
    for k, ts, _ in data:
        if k is not None and ts is not None and (best[k] is None or ts > best[k]):
            best[k] = ts
    return sorted(((k, ts, v) for k, ts, v in data if k is not None and ts is not None and ts == best[k]),
                  key=null_last)


@SETTINGS
@given(data=versions)
def test_latest_wins_equals_brute_force(spark, data):
    df = spark.createDataFrame(data, "k int, ts int, v int")
    want = brute_latest(data)
    assert rows(latest_wins(df, ["k"], "ts")) == want
    assert rows(latest_wins(df, ["k"], "ts", strategy="window")) == want


@SETTINGS
@given(target=st.lists(st.tuples(st.integers(0, 6), st.integers(0, 99)), max_size=15),
       batch=st.lists(st.tuples(st.integers(0, 6), st.integers(100, 199)), max_size=10))
def test_upsert_equals_delete_then_insert(spark, target, batch):
    t = spark.createDataFrame(target, "id int, v int")
    b = spark.createDataFrame(batch, "id int, v int")
    batch_keys = {k for k, _ in batch}
    want = sorted([r for r in target if r[0] not in batch_keys] + batch)
    assert rows(upsert_frame(t, b, ["id"])) == want


readings = st.lists(st.tuples(st.integers(1, 3), st.integers(1, 2), st.integers(0, 71),
                              st.floats(-50, 50, allow_nan=False, width=32)), min_size=1, max_size=40)


@SETTINGS
@given(data=readings, cut=st.integers(1, 39))
def test_recompute_over_any_split_equals_full_rebuild(spark, data, cut):
    rows_ = [(s, p, "1h", f"2025-12-{28 + h // 24:02d}T{h % 24:02d}:00:00Z", float(v)) for s, p, h, v in data]
    schema = "sensor_id int, parameter_id int, period_interval string, period_datetime_from_utc string, value double"
    allm = spark.createDataFrame(rows_, schema)
    first = spark.createDataFrame(rows_[:cut], schema)
    second = spark.createDataFrame(rows_[cut:], schema)
    target = daily_aggregate(first) if rows_[:cut] else None
    touched = second.select(text_date("period_datetime_from_utc").alias("date"))
    got = recompute_touched(target, allm, touched, "date", daily_aggregate,
                            source_column=text_date("period_datetime_from_utc"))

    def rounded(df):
        return sorted((r[0], r[1], r[3], round(r[5], 9), r[6], r[7], r[8]) for r in df.collect())

    assert rounded(got) == rounded(daily_aggregate(allm))
    appended = append_frame(target, daily_aggregate(second)) if target is not None else daily_aggregate(second)
    assert appended.count() >= daily_aggregate(allm).count()
