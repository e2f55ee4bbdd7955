
from pyspark.sql import functions as F

from medallion.functions import text_date
from medallion.operators.aggregates import daily_aggregate
from medallion.operators.dedup import repeated_keys, resolve_repeated
from medallion.operators.merge import append_frame, empty_like, merge_newest, recompute_touched, upsert_frame
from tests.conftest import rows


def test_upsert_replaces_matched_and_inserts_new(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b2")], "id long, v string")
    b = spark.createDataFrame([("B", 2), ("C", 3), ("N", None)], "v string, id long")
    got = upsert_frame(t, b, ["id"])
    assert got.columns == ["id", "v"]
    assert rows(got) == [(1, "a"), (2, "B"), (3, "C"), (None, "N")]


def test_upsert_is_idempotent(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    b = spark.createDataFrame([(2, "B")], "id long, v string")
    once = upsert_frame(t, b, ["id"])
    assert rows(upsert_frame(once, b, ["id"])) == rows(once)


def test_empty_batch_leaves_target(spark):
    t = spark.createDataFrame([(1, "a")], "id long, v string")
    assert rows(upsert_frame(t, empty_like(t), ["id"])) == [(1, "a")]
    assert rows(append_frame(t, empty_like(t))) == [(1, "a")]


def test_recompute_equals_full_rebuild_for_straddling_day(spark):
    schema = "sensor_id long, parameter_id long, period_interval string, period_datetime_from_utc string, value double"
    all_rows = [(1, 1, "1h", "2024-01-20T10:00:00Z", 1.0), (1, 1, "1h", "2024-01-20T13:00:00Z", 3.0),
                (1, 1, "1h", "2024-01-19T13:00:00Z", 5.0), (2, 1, "1h", "2024-01-21T01:00:00Z", 2.0)]
    m = spark.createDataFrame(all_rows, schema)
    first = spark.createDataFrame(all_rows[:1] + all_rows[2:3], schema)
    second = spark.createDataFrame([all_rows[1], all_rows[3]], schema)
    target = daily_aggregate(first)
    touched = second.select(text_date("period_datetime_from_utc").alias("date"))
    got = recompute_touched(target, m, touched, "date", daily_aggregate,
                            source_column=text_date("period_datetime_from_utc"))
    assert rows(got) == rows(daily_aggregate(m))
    appended = append_frame(daily_aggregate(first), daily_aggregate(second))
    assert appended.count() == daily_aggregate(m).count() + 1


def test_only_keys_with_several_rows_are_merged(spark):
    schema = "id long, k string, v double, version int, load int"
    old = [(1, "a", 1.0, 1, 1), (2, "b", 2.0, 5, 1), (3, "c", 3.0, 1, 1), (3, "c", 3.5, 1, 1), (4, "d", 4.0, 2, 1), (None, "n", 9.0, 1, 1)]
    new = [(1, "x", 6.0, 1, 2), (2, "b", 7.0, 4, 2), (4, "d", 4.0, 2, 2), (4, "d", 8.0, 3, 2), (4, "d", 8.0, 3, 2), (5, "e", 1.0, None, 2), (6, None, 1.0, 1, 2)]
    t, b = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    repeated = repeated_keys(t.union(b).select("id", "k"), ["id", "k"])
    assert repeated.count() == 3  # 2, 3 and 4
    got = rows(merge_newest(t, b, ["id", "k"], "version", "load", repeated))
    assert got == rows(merge_newest(t, b, ["id", "k"], "version", "load"))
    assert got == [(1, "a", 1.0, 1, 1), (1, "x", 6.0, 1, 2), (2, "b", 2.0, 5, 1), (3, "c", 3.0, 1, 1), (3, "c", 3.5, 1, 1), (4, "d", 8.0, 3, 2)]
    seen = []
    resolve_repeated(t, ["id", "k"], repeated, lambda d: seen.append(rows(d, "id")) or d)
    assert seen == [[(2,), (3,), (3,), (4,)]]


def test_rows_without_a_key_are_distinct_too(spark):
    df = spark.createDataFrame([(1, "a"), (None, None), (None, None), (None, "b"), (2, "b")], "id long, k string")
    got = resolve_repeated(df, ["id", "k"], repeated_keys(df, ["id", "k"]), lambda d: d.distinct())
    assert rows(got) == rows(df.distinct())
