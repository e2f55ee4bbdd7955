"""Models side by side, packed tables, row order in files, catalog views."""

import datetime as dt
import threading
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from medallion.plans.models import MODELS
from medallion.plans.runner import PipelineConfig, Runner
from medallion.sinks.catalog import publish, withdraw
from medallion.sinks.tables import LayerTable
from medallion.sources import fs
from tests import landing_fixtures as lf
from tests.conftest import rows

T = [dt.datetime(2025, 12, 30 + k, 7, 0, tzinfo=dt.timezone.utc) for k in range(2)]


def config(tmp_path, **more):
    return PipelineConfig(landing_root=str(tmp_path / "raw"), warehouse_root=str(tmp_path / "wh"), country_ids=(80, 110), **more)


def test_models_start_when_their_inputs_have_run_and_side_by_side(spark, tmp_path, monkeypatch):
    began, ended, lock = {}, {}, threading.Lock()

    def model(self, name, **_):
        with lock:
            began[name] = time.monotonic()
        time.sleep(0.05)
        with lock:
            ended[name] = time.monotonic()
        return "full"

    monkeypatch.setattr(Runner, "run_model", model)
    out = Runner(spark, config(tmp_path)).run_models([m.name for m in MODELS])
    assert list(out) == [m.name for m in MODELS] and set(out.values()) == {"full"}
    for m in MODELS:
        assert all(ended[i] <= began[m.name] for i in m.inputs)
    assert sum(began[a] < ended[b] and began[b] < ended[a] for a in began for b in began if a < b) > 5


def test_a_failed_model_stops_only_those_that_read_it(spark, tmp_path, monkeypatch):
    ran = []

    def model(self, name, **_):
        ran.append(name)
        if name == "silver_country":
            raise ValueError("no country")
        return "full"

    monkeypatch.setattr(Runner, "run_model", model)
    with pytest.raises(ValueError, match="no country"):
        Runner(spark, config(tmp_path)).run_models([m.name for m in MODELS])
    assert set(ran) == {m.name for m in MODELS} - {"gold_country", "gold_locality"}


def test_side_by_side_equals_one_after_the_other(spark, tmp_path):
    got = []
    for n in (1, 4):
        cfg = config(tmp_path / str(n), side_by_side=n)
        lf.land_first_batch(cfg.landing_root)
        Runner(spark, cfg, load_ts=T[0]).run_pipeline(test=False)
        lf.land_second_batch(cfg.landing_root)
        last = Runner(spark, cfg, load_ts=T[1])
        last.run_pipeline(test=False)
        got.append({m.name: rows(last.table(m).read().drop("instruments")) for m in MODELS})
    assert got[0] == got[1]


def readings(spark, lo, hi):
    return spark.range(lo, hi).select(F.col("id").alias("sensor_id"), F.lit(1).cast("long").alias("parameter_id"), F.lit(dt.date(2025, 1, 1)).alias("date"),
                                      F.rand(1).alias("value"))


def test_compaction_keeps_rows_loads_and_what_is_pending(spark, tmp_path):
    table = LayerTable(spark, str(tmp_path), "silver", "m", (), "date")
    reader = LayerTable(spark, str(tmp_path), "gold", "g", ())
    for k in range(5):
        table.append(readings(spark, 100 * k, 100 * k + 100), load_ts=T[0] + dt.timedelta(days=k))
        if k < 3:
            reader.consume(table, reader.pending(table))
    before, loads, pending = rows(table.read()), rows(table.loads()), rows(reader.pending(table))
    assert len(pending) == 2
    n = table.compact()
    reader_files = len(fs.data_files(spark, f"{reader.path}/_consumed"))
    reader._pack_log(f"{reader.path}/_consumed")
    assert n == (5, 1) and reader_files == 3
    assert len(fs.data_files(spark, table.load_log())) == len(fs.data_files(spark, f"{reader.path}/_consumed")) == 1
    assert rows(table.read()) == before and rows(table.loads()) == loads and rows(reader.pending(table)) == pending
    assert table.compact() == (1, 1)


def test_compaction_leaves_partitions_that_are_packed(spark, tmp_path):
    table = LayerTable(spark, str(tmp_path), "silver", "m", (), "date")
    table.append(readings(spark, 0, 100))
    other = readings(spark, 0, 50).withColumn("date", F.lit(dt.date(2025, 1, 2)))
    for _ in range(2):
        table.append(other)
    kept = [n for n in fs.data_files(spark, table.data()) if "2025-01-01" in n]
    assert table.compact() == (3, 2)
    assert [n for n in fs.data_files(spark, table.data()) if "2025-01-01" in n] == kept
    assert table.read().count() == 200


def test_row_groups_of_a_date_are_apart_in_sensors(spark, tmp_path):
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.setInt("parquet.block.size", 1 << 15)
    hadoop.setInt("parquet.page.size.row.check.min", 100)
    try:
        table = LayerTable(spark, str(tmp_path), "silver", "m", ("sensor_id",), "date")
        mixed = readings(spark, 0, 40_000).orderBy(F.xxhash64("sensor_id"))
        table.upsert(mixed.where("sensor_id % 2 = 0"))
        table.upsert(mixed.where("sensor_id % 2 = 1"))
    finally:
        hadoop.unset("parquet.block.size")
        hadoop.unset("parquet.page.size.row.check.min")
    groups = []
    for name in fs.data_files(spark, table.data()):
        meta = pq.ParquetFile(f"{table.data()}/{name}").metadata
        at = meta.schema.names.index("sensor_id")
        groups += [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
    assert len(groups) > 5
    hit = [s for s in groups if s.min <= 12_345 <= s.max]
    assert len(hit) == 1 and table.read().where("sensor_id = 12345").count() == 1


def test_views_follow_versions_and_may_be_empty(spark, tmp_path):
    table = LayerTable(spark, str(tmp_path), "gold", "thing", ("id",))
    assert publish(spark, table, "t_") is None
    table.upsert(spark.sql("SELECT 1 AS id, 'a' AS name, array(named_struct('id', 1)) AS parts"))
    name = publish(spark, table, "t_")
    assert name == "t_gold.thing"
    first = spark.table(name)
    table.upsert(spark.sql("SELECT 1 AS id, 'b' AS name, array(named_struct('id', 2)) AS parts"))
    publish(spark, table, "t_")
    assert rows(spark.table(name), "id", "name") == [(1, "b")] and rows(first, "id", "name") == [(1, "a")]
    assert spark.table(name).schema["parts"].dataType == table.read().schema["parts"].dataType
    fact = LayerTable(spark, str(tmp_path), "gold", "fact", (), "date")
    fact.overwrite(readings(spark, 0, 0))
    assert spark.table(publish(spark, fact, "t_")).columns == fact.read().columns
    assert spark.table("t_gold.fact").count() == 0
    fact.overwrite(readings(spark, 0, 5))
    publish(spark, fact, "t_")
    fact.append(readings(spark, 5, 7))  # inside the version: the view sees it
    assert spark.table("t_gold.fact").where("date = DATE'2025-01-01'").count() == 7
    withdraw(spark, ["gold"], "t_")
    assert not spark.catalog.databaseExists("t_gold") and fact.read().count() == 7
