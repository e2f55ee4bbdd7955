"""Run-when-available loading with Structured Streaming (file source checkpoint,
foreachBatch keyed upsert, archive of processed files)."""

import json
import os

import pytest

from medallion.plans.runner import PipelineConfig, Runner
from medallion.sinks.tables import LayerTable
from medallion.sources.landing import scan_landing
from medallion.streaming.incremental import run_available_now, start_bronze_stream, start_layer_streams, start_page_stream
from tests import landing_fixtures as lf
from tests.conftest import rows


def test_bronze_stream_processes_each_file_once(spark, tmp_path):
    cfg = PipelineConfig(landing_root=str(tmp_path / "raw"), warehouse_root=str(tmp_path / "wh"),
                         country_ids=(80, 110), extra={"stream_checkpoint_root": str(tmp_path / "ckpt")})
    lf.land_first_batch(cfg.landing_root)
    q = start_bronze_stream(spark, cfg, "measurement", archive=False)
    q.awaitTermination()
    r = Runner(spark, cfg)
    first = r.read("bronze", "measurement")
    assert first.count() == 6  # the tied copy of sensor 1002's reading is kept
    # nothing new: a second availableNow run processes no file
    q = start_bronze_stream(spark, cfg, "measurement", archive=False)
    q.awaitTermination()
    assert r.read("bronze", "measurement").count() == 6
    lf.land_second_batch(cfg.landing_root)
    q = start_bronze_stream(spark, cfg, "measurement", archive=False)
    q.awaitTermination()
    got = r.read("bronze", "measurement")
    assert got.count() == 8
    assert rows(got.where("sensor_id = 1000 and period_datetime_from_utc = '2025-12-29T10:00:00Z'"),
                "value") == [(99.0,)]


def test_available_now_pipeline_and_archive(spark, tmp_path):
    cfg = PipelineConfig(landing_root=str(tmp_path / "raw"), warehouse_root=str(tmp_path / "wh"),
                         country_ids=(80, 110), entities=("country", "parameter", "location", "sensor", "measurement"),
                         extra={"stream_checkpoint_root": str(tmp_path / "ckpt")})
    lf.land_first_batch(cfg.landing_root)
    results = {x.test: x.failures for x in run_available_now(spark, cfg).collect()}
    assert {k: v for k, v in results.items() if v} == {"duplicates": 1}
    lf.land_second_batch(cfg.landing_root)
    run_available_now(spark, cfg, test=False)
    r = Runner(spark, cfg)
    assert rows(r.read("gold", "location"), "id") == [(100,), (101,), (102,), (103,), (104,)]
    silver = r.read("silver", "measurement")
    assert rows(silver.where("sensor_id = 1000"), "value") == [(10.0,), (20.0,), (50.0,), (99.0,)]
    # processed files of earlier runs were moved under the archive folder
    archived = []
    for dirpath, _, files in os.walk(f"{cfg.landing_root}/measurement/archive"):
        archived += [f for f in files if f.endswith(".parquet")]
    assert archived


def test_a_batch_that_is_still_being_written_waits(spark, tmp_path):
    cfg = PipelineConfig(landing_root=str(tmp_path / "raw"), warehouse_root=str(tmp_path / "wh"),
                         country_ids=(80, 110), extra={"stream_checkpoint_root": str(tmp_path / "ckpt")})
    lf.land_first_batch(cfg.landing_root)
    new = f"{cfg.landing_root}/country/new"
    [batch] = os.listdir(new)
    os.rename(f"{new}/{batch}", f"{new}/_{batch}")
    start_bronze_stream(spark, cfg, "country").awaitTermination()
    assert Runner(spark, cfg).read("bronze", "country") is None
    os.rename(f"{new}/_{batch}", f"{new}/{batch}")
    start_bronze_stream(spark, cfg, "country").awaitTermination()
    assert Runner(spark, cfg).read("bronze", "country").count() == 3


def config(tmp_path):
    return PipelineConfig(landing_root=str(tmp_path / "raw"), warehouse_root=str(tmp_path / "wh"), country_ids=(80, 110),
                          entities=("measurement",), extra={"stream_checkpoint_root": str(tmp_path / "ckpt")})


def test_a_micro_batch_that_is_tried_again_loads_once(spark, tmp_path, monkeypatch):
    cfg = config(tmp_path)
    r = Runner(spark, cfg)
    silver, gold = r.table("silver_measurement"), r.table("gold_measurement_daily_aggregate")
    models = ["silver_measurement", "gold_measurement_daily_aggregate"]
    lf.land_first_batch(cfg.landing_root)
    run_available_now(spark, cfg, test=False, models=models)
    lf.land_second_batch(cfg.landing_root)
    start_bronze_stream(spark, cfg, "measurement").awaitTermination()
    before = [t.loads().select("load_timestamp").distinct().count() for t in (silver, gold)]
    consume = LayerTable.consume
    for model in models:  # each fails once after its load was logged
        monkeypatch.setattr(LayerTable, "consume", lambda self, *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(Exception):
            start_layer_streams(spark, cfg, model)
        monkeypatch.setattr(LayerTable, "consume", consume)
        start_layer_streams(spark, cfg, model)
    assert [t.loads().select("load_timestamp").distinct().count() for t in (silver, gold)] == [n + 1 for n in before]
    assert silver.pending(r.table("bronze_measurement")).isEmpty() and gold.pending(silver).isEmpty()
    assert rows(silver.read().where("sensor_id = 1000"), "value") == [(10.0,), (20.0,), (50.0,), (99.0,)]
    assert rows(gold.read().where("sensor_id = 1000"), "daily_average", "number_of_measurements") == [(15.0, 2), (74.5, 2)]


def test_a_stream_of_json_pages_has_two_sinks(spark, tmp_path):
    cfg = config(tmp_path)
    cfg.pages_root = str(tmp_path / "json")
    folder = f"{cfg.pages_root}/measurement"
    os.makedirs(folder)
    page = lambda sensor, hour: json.dumps({"parent_id": sensor, "results": [lf.measurement(hour * 1.0, lf.PM25, lf.t(29, hour), lf.t(29, hour + 1))]})
    for k in range(2):
        for name, text in ((f"a{k}", page(1000, 10 + k)), (f"b{k}", '{"results": [{"value"'), (f"c{k}", "")):
            with open(f"{folder}/{name}.json", "w") as f:
                f.write(text)
        start_page_stream(spark, cfg, "measurement").awaitTermination()
    landed = scan_landing(spark, cfg.landing_root, "measurement", scope="new")
    assert rows(landed, "sensor_id", "value") == [(1000, 10.0), (1000, 11.0)]
    # the last micro-batch once more: the same batch, landed once
    from medallion.sources.api_pages import parsed_pages

    pages = parsed_pages(spark.read, f"{folder}/a1.json", "measurement")
    Runner(spark, cfg).land_parsed(pages, "measurement", "stream_measurement_1")
    assert scan_landing(spark, cfg.landing_root, "measurement", scope="new").count() == 2
    cfg.pages_root = None
    run_available_now(spark, cfg, test=False, models=[])
    failures = {x.test: x.failures for x in Runner(spark, cfg).test(store=False).collect()}
    assert failures["bad_pages"] in (1, 2) and Runner(spark, cfg).read("bronze", "measurement").count() == 2
