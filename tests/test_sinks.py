import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from medallion.sinks.tables import LayerTable
from tests.conftest import rows


def test_versioned_table_upsert_append_overwrite(spark, tmp_path):
    t = LayerTable(spark, str(tmp_path), "silver", "country", ("id",))
    assert t.read() is None and not t.exists()
    t.overwrite(spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string"))
    assert t.current_version() == 1
    t.upsert(spark.createDataFrame([(2, "B"), (3, "c")], "id long, v string"))
    assert t.current_version() == 2
    assert rows(t.read()) == [(1, "a"), (2, "B"), (3, "c")]
    # the previous version is untouched and still readable
    assert rows(spark.read.parquet(glob.glob(f"{t.path}/v=1-*")[0])) == [(1, "a"), (2, "b")]
    t.append(spark.createDataFrame([(4, "d")], "id long, v string"))
    assert rows(t.read(), "id") == [(1,), (2,), (3,), (4,)]


def test_uncommitted_version_is_ignored(spark, tmp_path):
    t = LayerTable(spark, str(tmp_path), "gold", "sensor", ("id",))
    t.overwrite(spark.createDataFrame([(1, "a")], "id long, v string"))
    # a crashed writer leaves data without a commit marker
    spark.createDataFrame([(9, "x")], "id long, v string").write.parquet(f"{t.path}/v=2")
    assert rows(t.read()) == [(1, "a")]
    t.upsert(spark.createDataFrame([(2, "b")], "id long, v string"))
    assert t.current_version() == 2
    assert rows(t.read()) == [(1, "a"), (2, "b")]


def test_partitioned_upsert_touches_only_batch_dates(spark, tmp_path):
    t = LayerTable(spark, str(tmp_path), "bronze", "measurement", ("sensor_id", "from_utc"), "measurement_date")
    base = spark.createDataFrame([
        (1, "2025-12-28T10:00:00Z", 1.0), (1, "2025-12-29T10:00:00Z", 2.0), (2, "2025-12-29T11:00:00Z", 3.0),
    ], "sensor_id long, from_utc string, value double").withColumn("measurement_date", F.to_date("from_utc"))
    t.upsert(base)
    day28 = [p for p in os.listdir(t.data()) if p.startswith("measurement_date=2025-12-28")][0]
    before = sorted(os.listdir(f"{t.data()}/{day28}"))
    batch = spark.createDataFrame([(1, "2025-12-29T10:00:00Z", 20.0), (3, "2025-12-30T00:00:00Z", 4.0)],
                                  "sensor_id long, from_utc string, value double") \
        .withColumn("measurement_date", F.to_date("from_utc"))
    t.upsert(batch)
    assert rows(t.read(), "sensor_id", "value") == [(1, 1.0), (1, 20.0), (2, 3.0), (3, 4.0)]
    assert sorted(os.listdir(f"{t.data()}/{day28}")) == before
    t.upsert(batch)  # replay: idempotent
    assert t.read().count() == 4
    assert dict(t.read().dtypes)["measurement_date"] == "date"


def test_partitioned_append_and_replace(spark, tmp_path):
    t = LayerTable(spark, str(tmp_path), "gold", "agg", (), "date")
    d = spark.createDataFrame([(dt.date(2025, 1, 1), 1), (dt.date(2025, 1, 2), 2)], "date date, n long")
    t.append(d)
    t.append(d.where("n = 2"))
    assert rows(t.read(), "n") == [(1,), (2,), (2,)]
    t.replace_partitions(spark.createDataFrame([(dt.date(2025, 1, 2), 5)], "date date, n long"))
    assert rows(t.read(), "n") == [(1,), (5,)]


UTC = dt.timezone.utc


def dated(spark, rows_, ts):
    schema = "sensor_id long, from_utc string, value double, load_timestamp timestamp"
    return spark.createDataFrame([(s, f, v, ts) for s, f, v in rows_], schema).withColumn("measurement_date", F.to_date("from_utc"))


def test_pending_loads_and_pruned_incremental_reads(spark, tmp_path):
    t = LayerTable(spark, str(tmp_path), "silver", "measurement", ("sensor_id", "from_utc"), "measurement_date")
    target = LayerTable(spark, str(tmp_path), "gold", "measurement", ("sensor_id", "from_utc"), "measurement_date")
    assert t.newest_load() == dt.datetime(1900, 1, 1, tzinfo=UTC)
    t1, t2 = dt.datetime(2025, 12, 30, 7, tzinfo=UTC), dt.datetime(2025, 12, 31, 7, tzinfo=UTC)
    t.upsert(dated(spark, [(1, "2025-12-28T10:00:00Z", 1.0), (1, "2025-12-29T10:00:00Z", 2.0)], t1), load_ts=t1)
    assert t.newest_load() == t1 and t.next_load(t1) == t1 + dt.timedelta(microseconds=1) and t.next_load(t2) == t2
    target.consume(t, target.pending(t))
    assert target.pending(t).isEmpty()
    t.upsert(dated(spark, [(2, "2025-12-29T11:00:00Z", 3.0)], t2), load_ts=t2)
    pending = target.pending(t)
    assert rows(pending, "measurement_date") == [(dt.date(2025, 12, 29),)]
    since = t.rows_of(pending)
    assert rows(since, "sensor_id") == [(2,)]
    plan = spark._jvm.PythonSQLUtils.explainString(since._jdf.queryExecution(), "formatted")
    assert "dynamicpruning" in plan and "BroadcastHashJoin LeftSemi" in plan
    assert not target.pending(t).isEmpty()  # not before the write that takes it in


def test_files_follow_the_data_not_the_shuffle(spark, tmp_path):
    t = LayerTable(spark, str(tmp_path), "bronze", "measurement", ("sensor_id", "from_utc"), "measurement_date")
    days = spark.range(4000).select(F.col("id").alias("sensor_id"), F.concat(F.lit("2025-12-"), F.lpad((F.col("id") % 20 + 1).cast("string"), 2, "0")).alias("from_utc"))
    df = days.withColumn("measurement_date", F.to_date("from_utc")).repartition(16, "sensor_id")
    t.overwrite(df)
    t.upsert(df.where("sensor_id % 2 = 0"))
    for day in os.listdir(t.data()):
        if day.startswith("measurement_date="):
            assert len([f for f in os.listdir(f"{t.data()}/{day}") if f.endswith(".parquet")]) <= 2
    assert t.read().count() == 4000


def test_a_failed_full_refresh_leaves_the_old_table(spark, tmp_path):
    t = LayerTable(spark, str(tmp_path), "gold", "agg", (), "date")
    t.overwrite(spark.createDataFrame([(dt.date(2025, 1, 1), 1)], "date date, n long"))
    broken = spark.createDataFrame([(dt.date(2025, 1, 2), 2)], "date date, n long").withColumn("n", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        t.overwrite(broken)
    assert rows(t.read(), "n") == [(1,)]
    t.overwrite(spark.createDataFrame([(dt.date(2025, 1, 3), 3)], "date date, n long"))
    assert rows(t.read(), "n") == [(3,)]


def test_only_the_version_before_is_kept(spark, tmp_path):
    t = LayerTable(spark, str(tmp_path), "gold", "country", ("id",))
    for i in range(4):
        t.upsert(spark.createDataFrame([(i, "x")], "id long, v string"))
    assert t.current_version() == 4
    assert sorted(d.split("-")[0] for d in os.listdir(t.path) if d.startswith("v=")) == ["v=3", "v=4"]
    assert rows(t.read(), "id") == [(0,), (1,), (2,), (3,)]


def test_of_two_writers_of_a_version_one_fails(spark, tmp_path, monkeypatch):
    t, other = (LayerTable(spark, str(tmp_path), "silver", "x", ("id",)) for _ in range(2))
    t.overwrite(spark.createDataFrame([(1, "a")], "id long, v string"))
    put = LayerTable._put

    def late(self, df, path, mode, **options):
        put(self, df, path, mode, **options)
        if self is t:  # the other writer commits in between
            other.overwrite(spark.createDataFrame([(2, "b")], "id long, v string"))

    monkeypatch.setattr(LayerTable, "_put", late)
    with pytest.raises(Exception, match="already exists|AlreadyExists"):
        t.overwrite(spark.createDataFrame([(3, "c")], "id long, v string"))
    monkeypatch.setattr(LayerTable, "_put", put)
    assert rows(t.read()) == [(2, "b")]
    t.upsert(spark.createDataFrame([(4, "d")], "id long, v string"))
    assert rows(t.read()) == [(2, "b"), (4, "d")]


def test_a_marker_that_was_not_finished_is_no_version(spark, tmp_path):
    t = LayerTable(spark, str(tmp_path), "silver", "x", ("id",))
    t.overwrite(spark.createDataFrame([(1, "a")], "id long, v string"))
    with open(f"{t.path}/_commits/v=2", "w") as f:
        f.write('{"data": "v=2')
    assert t.current_version() == 1 and rows(t.read()) == [(1, "a")]
    t.overwrite(spark.createDataFrame([(5, "e")], "id long, v string"))
    assert t.current_version() == 3 and rows(t.read()) == [(5, "e")]
