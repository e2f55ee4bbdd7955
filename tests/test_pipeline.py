"""End to end: landed pages -> bronze -> silver -> gold -> archive -> tests."""

import datetime as dt
import glob
import json
import os
import random
import shutil
import time

import pytest
from pyspark.sql import functions as F

from medallion.operators.aggregates import daily_aggregate, hourly_aggregate
from medallion.operators.selection import read_mark
from medallion.plans.models import MODELS
from medallion.plans.runner import PipelineConfig, Runner
from medallion.sinks import tables
from medallion.sources.landing import files_exist
from tests import landing_fixtures as lf
from tests.conftest import rows

T1 = dt.datetime(2025, 12, 30, 7, 0)
T2 = dt.datetime(2025, 12, 31, 7, 0)
T3 = dt.datetime(2026, 1, 1, 7, 0)


@pytest.fixture(scope="module")
def two_runs(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("pipe")
    cfg = PipelineConfig(landing_root=str(base / "raw"), warehouse_root=str(base / "wh"), country_ids=(80, 110))
    lf.land_first_batch(cfg.landing_root)
    first = Runner(spark, cfg, load_ts=T1)
    tests1 = {r.test: r.failures for r in first.run_pipeline().collect()}
    snap = {n: rows(first.read(*n)) for n in [("gold", "measurement_daily_aggregate"), ("bronze", "measurement")]}
    lf.land_second_batch(cfg.landing_root)
    second = Runner(spark, cfg, load_ts=T2)
    tests2 = {r.test: r.failures for r in second.run_pipeline().collect()}
    return cfg, second, tests1, tests2, snap


def test_first_run_builds_every_layer_and_passes_tests(two_runs):
    cfg, runner, tests1, _, snap = two_runs
    # the reading of sensor 1002 landed twice with the same extraction time:
    # latest-wins keeps both tied copies in bronze and the duplicate report
    # flags exactly that key; every other test passes
    assert {k: v for k, v in tests1.items() if v} == {"duplicates": 1}
    assert sum(1 for r in snap[("bronze", "measurement")] if r[-4] == 1002) == 2


def test_second_run_incremental_semantics(spark, two_runs):
    cfg, runner, _, tests2, _ = two_runs
    assert {k: v for k, v in tests2.items() if v} == {"duplicates": 1}
    dq = spark.read.parquet(f"{cfg.warehouse_root}/dq/duplicates")
    assert rows(dq, "table_name", "count") == [("bronze_measurement", 2)]
    bronze = runner.read("bronze", "measurement")
    revised = bronze.where("sensor_id = 1000 and period_datetime_from_utc = '2025-12-29T10:00:00Z'")
    assert rows(revised, "value") == [(99.0,)]
    silver = runner.read("silver", "measurement")
    assert rows(silver.where("sensor_id = 1000"), "value") == [(10.0,), (20.0,), (50.0,), (99.0,)]
    # recompute mode: the straddling day equals a rebuild from all silver rows
    daily = runner.read("gold", "measurement_daily_aggregate").drop("load_timestamp")
    assert rows(daily) == rows(daily_aggregate(silver).select(*daily.columns))
    hourly = runner.read("gold", "measurement_hourly_aggregate").drop("load_timestamp")
    assert rows(hourly) == rows(hourly_aggregate(silver).select(*hourly.columns))
    # everything landed was archived
    for e in cfg.entities:
        assert not files_exist(spark, f"{cfg.landing_root}/{e}/new")


def test_gold_tables(two_runs):
    _, runner, _, _, _ = two_runs
    assert rows(runner.read("gold", "country"), "id") == [(80,), (110,)]
    # parameter 9 has no measurement
    assert rows(runner.read("gold", "parameter"), "id", "display_name") == [(2, "Fine particles"), (5, "no2")]
    loc = rows(runner.read("gold", "locality"), "id", "name", "display_name")
    assert loc == [(100, "Belgrade", "Belgrade, RS"), (102, "Novi Sad", "Novi Sad, RS"),
                   (103, "Sarajevo", "Sarajevo, BA")]
    assert rows(runner.read("gold", "location"), "id", "locality_id") == [
        (100, 100), (101, 100), (102, 102), (103, 103), (104, 103)]
    sensors = runner.read("gold", "sensor")
    assert dict(sensors.dtypes)["summary_min"] == "double"
    assert rows(sensors, "id", "summary_min", "latest_value") == [
        (1000, 1.0, 12.5), (1001, 2.5, 12.5), (1002, 3.5, None), (1003, 4.0, 12.5)]


def test_replay_without_new_files_changes_nothing(spark, two_runs):
    cfg, runner, _, _, _ = two_runs
    before = {m: rows(runner.read(*m).drop("load_timestamp"))
              for m in [("bronze", "measurement"), ("gold", "measurement_daily_aggregate"), ("gold", "sensor")]}
    third = Runner(spark, cfg, load_ts=T3)
    outcome = {layer: third.run_layer(layer) for layer in ("bronze", "silver")}
    assert set(outcome["bronze"].values()) == {"skip"}
    assert set(outcome["silver"].values()) == {"skip"}
    after = {m: rows(third.read(*m).drop("load_timestamp")) for m in before}
    assert after == before


def test_full_refresh_equals_incremental(spark, two_runs):
    cfg, runner, _, _, _ = two_runs
    incremental = {m: rows(runner.read(*m).drop("load_timestamp"))
                   for m in [("silver", "measurement"), ("gold", "measurement_daily_aggregate"),
                             ("gold", "locality"), ("gold", "sensor")]}
    full = Runner(spark, cfg, load_ts=T3)
    full.run_pipeline(full_refresh=True, archive=False, test=False)
    refreshed = {m: rows(full.read(*m).drop("load_timestamp")) for m in incremental}
    assert refreshed == incremental


def test_reference_modes_append_partials(spark, tmp_path):
    cfg = PipelineConfig(landing_root=str(tmp_path / "raw"), warehouse_root=str(tmp_path / "wh"),
                         country_ids=(80, 110), aggregate_mode="append", measurement_mode="append",
                         bronze_watermark=True)
    lf.land_first_batch(cfg.landing_root)
    Runner(spark, cfg, load_ts=T1).run_pipeline(test=False)
    lf.land_second_batch(cfg.landing_root)
    r = Runner(spark, cfg, load_ts=T2)
    r.run_pipeline(test=False)
    daily = r.read("gold", "measurement_daily_aggregate")
    # sensor 1000 on 2025-12-29 has a row from each batch
    assert daily.where("sensor_id = 1000 and date = '2025-12-29'").count() == 2
    # the revised reading was added in silver, not replaced
    assert r.read("silver", "measurement").where("sensor_id = 1000").count() == 5
    dups = {x.test: x.failures for x in r.test().collect()}["duplicates"]
    assert dups >= 1


def test_relanding_the_same_batch_is_idempotent(spark, tmp_path):
    cfg = PipelineConfig(landing_root=str(tmp_path / "raw"), warehouse_root=str(tmp_path / "wh"),
                         country_ids=(80, 110))
    lf.land_first_batch(cfg.landing_root)
    Runner(spark, cfg, load_ts=T1).run_pipeline(test=False)
    lf.land_second_batch(cfg.landing_root)
    r = Runner(spark, cfg, load_ts=T2)
    r.run_pipeline(test=False)
    tables = [("bronze", "measurement"), ("bronze", "sensor"), ("silver", "measurement"), ("silver", "location"),
              ("gold", "measurement"), ("gold", "measurement_daily_aggregate"),
              ("gold", "measurement_hourly_aggregate"), ("gold", "locality"), ("gold", "parameter")]
    before = {t: rows(r.read(*t).drop("load_timestamp")) for t in tables}
    lf.land_second_batch(cfg.landing_root)  # the same pages land again
    again = Runner(spark, cfg, load_ts=T3)
    again.run_pipeline(test=False)
    after = {t: rows(again.read(*t).drop("load_timestamp")) for t in tables}
    assert after == before


def test_parameters_with_data_side_table_matches_a_scan(spark, two_runs):
    cfg, runner, _, _, _ = two_runs
    side = {r.parameter_id for r in runner.parameters_with_data().collect()}
    scan = {r.parameter_id for r in runner.read("silver", "measurement").select("parameter_id").collect()}
    assert side == scan == {2, 5}


def content(runner):
    """All 18 tables without their load times."""
    return {m.name: rows(df.drop("load_timestamp")) for m in MODELS if (df := runner.read(m.layer, m.alias)) is not None}


def config(tmp_path, name=""):
    return PipelineConfig(landing_root=str(tmp_path / f"raw{name}"), warehouse_root=str(tmp_path / f"wh{name}"),
                          country_ids=(80, 110))


def test_one_runner_takes_in_every_batch(spark, tmp_path):
    cfg = config(tmp_path)
    r = Runner(spark, cfg, load_ts=T1)  # one load time for both runs
    lf.land_first_batch(cfg.landing_root)
    r.run_pipeline(test=False)
    lf.land_second_batch(cfg.landing_root)
    r.run_pipeline(test=False)
    incremental = content(r)
    r.run_pipeline(full_refresh=True, test=False)
    assert content(r) == incremental and len(incremental) == 18


def test_a_load_committed_late_is_taken_in(spark, tmp_path):
    """A bronze load stamped before, but committed after, a silver run."""
    cfg = config(tmp_path)
    lf.land_first_batch(cfg.landing_root)
    Runner(spark, cfg, load_ts=T2).run_pipeline(test=False)
    lf.land_second_batch(cfg.landing_root)
    Runner(spark, cfg, load_ts=T1).run_layer("bronze")
    assert Runner(spark, cfg, load_ts=T1).run_model("silver_measurement") == "upsert"
    silver = Runner(spark, cfg).read("silver", "measurement")
    assert rows(silver.where("sensor_id = 1000"), "value") == [(10.0,), (20.0,), (50.0,), (99.0,)]


def test_older_versions_never_replace_newer_ones(spark, tmp_path):
    cfg = config(tmp_path)
    m = lambda v: [lf.measurement(v, lf.PM25, lf.t(29, 10), lf.t(29, 11))]
    lf.write_page(cfg.landing_root, "measurement", m(99.0), "b1", dt.datetime(2025, 12, 31), ("sensor_id", 1))
    r = Runner(spark, cfg)
    r.run_model("bronze_measurement")
    lf.write_page(cfg.landing_root, "measurement", m(10.0), "b2", dt.datetime(2025, 12, 30), ("sensor_id", 1))
    r.run_model("bronze_measurement")
    assert rows(r.read("bronze", "measurement"), "value") == [(99.0,)]


def test_any_order_and_split_of_pages_equals_a_full_refresh(spark, tmp_path):
    """Also with a parameter whose first reading comes in a later batch."""
    rnd = random.Random(11)
    pages = str(tmp_path / "pages")
    lf.land_first_batch(pages)
    lf.land_second_batch(pages)
    co = {"id": 9, "name": "co", "units": "ppm", "display_name": "CO"}
    lf.write_page(pages, "measurement", [lf.measurement(3.0, co, lf.t(27, 1), lf.t(27, 2))], "measurement_b3",
                  dt.datetime(2026, 1, 1), ("sensor_id", 1001))
    lf.write_page(pages, "country", [lf.country(80, "RS", "Old name")], "country_b0", dt.datetime(2025, 12, 1))
    files = sorted(glob.glob(f"{pages}/*/new/*/*.parquet"))
    want = None
    for name, runs in (("full", 1), ("a", 3)):
        cfg = config(tmp_path, name)
        order = rnd.sample(files, len(files))
        # every entity has a page in the first run, so that all layers exist
        first = {f.split("/new/")[0]: f for f in reversed(order)}
        split = {f: 0 if runs == 1 or f in first.values() else rnd.randrange(runs) for f in order}
        for k in range(runs):
            for f in order:
                if split[f] == k:
                    to = f"{cfg.landing_root}/{f[len(pages) + 1:]}"
                    if rnd.random() < 0.5:  # a plain file in new/
                        to = f"{to.split('/new/')[0]}/new/{os.path.basename(os.path.dirname(f))}-{os.path.basename(f)}"
                    os.makedirs(os.path.dirname(to), exist_ok=True)
                    shutil.copy(f, to)
            Runner(spark, cfg).run_pipeline(test=False)
            assert not any(files_exist(spark, f"{cfg.landing_root}/{e}/{d}") for e in cfg.entities for d in ("new", "loading"))
        got = content(Runner(spark, cfg))
        assert len(got) == 18
        want = want or got
        for table in want:
            assert got[table] == want[table], (name, table)
    assert [r[0] for r in want["gold_parameter"]] == [2, 5, 9]


def test_rows_without_a_date_are_kept_aside_and_counted(spark, tmp_path):
    cfg = config(tmp_path)
    r = Runner(spark, cfg)
    for k in range(2):
        lf.write_page(cfg.landing_root, "measurement", [lf.measurement(1.0 + k, lf.PM25, f"no time {k}", lf.t(29, 11)),
                                                        lf.measurement(5.0, lf.PM25, lf.t(29, 10 + k), lf.t(29, 11 + k))],
                      f"b{k}", dt.datetime(2025, 12, 30 + k), ("sensor_id", 1))
        r.run_model("bronze_measurement")
    assert r.read("bronze", "measurement").count() == 2
    failures = {x.test: x.failures for x in r.test(store=False).collect()}
    assert failures["undated_measurement"] == 2
    r.run_model("bronze_measurement", full_refresh=True)
    assert {x.test: x.failures for x in r.test(store=False).collect()}["undated_measurement"] == 2


def test_files_landed_during_a_run_wait_for_the_next(spark, tmp_path):
    cfg = config(tmp_path)
    lf.land_first_batch(cfg.landing_root)
    r = Runner(spark, cfg)
    r.run_layer("bronze")
    lf.land_second_batch(cfg.landing_root)  # while silver and gold run
    r.archive()
    assert files_exist(spark, f"{cfg.landing_root}/measurement/new")
    r.run_pipeline(test=False)
    assert rows(r.read("silver", "measurement").where("sensor_id = 1000"), "value") == [(10.0,), (20.0,), (50.0,), (99.0,)]


def test_pages_are_landed_and_the_mark_advances(spark, tmp_path):
    cfg = config(tmp_path)
    cfg.pages_root = str(tmp_path / "json")
    os.makedirs(f"{cfg.pages_root}/measurement")
    with open(f"{cfg.pages_root}/measurement/p1.json", "w") as f:
        json.dump({"parent_id": 1000, "results": [lf.measurement(1.5, lf.PM25, lf.t(29, 10), lf.t(29, 11))]}, f)
    with open(f"{cfg.pages_root}/measurement/p2.json", "w") as f:
        f.write('{"results": [{"value": 1.5, "period"')
    lf.land_first_batch(cfg.landing_root)
    failures = {x.test: x.failures for x in Runner(spark, cfg, load_ts=T1).run_pipeline().collect()}
    assert failures["bad_pages"] == 1
    r = Runner(spark, cfg)
    assert rows(r.read("bronze", "measurement").where("sensor_id = 1000"), "value") == [(1.5,), (10.0,), (20.0,)]
    mark = spark.range(1).select(F.unix_micros(read_mark(spark, cfg.mark))).first()[0]
    assert mark == int(T1.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6)
    assert os.listdir(f"{cfg.pages_root}/measurement/loading") == []


def test_load_times_are_utc_whatever_the_zone_of_the_driver(spark, tmp_path, monkeypatch):
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        cfg = config(tmp_path)
        lf.land_first_batch(cfg.landing_root)
        r = Runner(spark, cfg, load_ts=T1)
        r.run_model("bronze_country")
        micros = r.read("bronze", "country").select(F.unix_micros("load_timestamp")).distinct().collect()
        want = int(T1.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6)
        assert [x[0] for x in micros] == [want]
        assert r.table("bronze_country").newest_load() == T1.replace(tzinfo=dt.timezone.utc)
    finally:
        monkeypatch.undo()
        time.tzset()


def reading(sensor, day, hour, value, param=lf.PM25, interval="01:00:00"):
    m = lf.measurement(value, param, lf.t(day, hour), lf.t(day, hour + 1))
    m["period"]["interval"] = interval
    return sensor, m


def land_readings(cfg, k, readings):
    for i, (sensor, m) in enumerate(readings):
        lf.write_page(cfg.landing_root, "measurement", [m], f"m{k}_{i}", dt.datetime(2025, 12, 30 + k // 24, k % 24), ("sensor_id", sensor))


AGGREGATES = ("measurement_daily_aggregate", "measurement_hourly_aggregate")


def aggregates(runner):
    daily, hourly = (runner.read("gold", a).drop("load_timestamp") for a in AGGREGATES)
    silver = runner.read("silver", "measurement")
    assert rows(daily) == rows(daily_aggregate(silver).select(*daily.columns))
    assert rows(hourly) == rows(hourly_aggregate(silver).select(*hourly.columns))
    return rows(daily, "sensor_id", "date", "daily_minimum")


def run_measurements(runner):
    for m in ("bronze_measurement", "silver_measurement"):
        runner.run_model(m)
    return [runner.run_model(f"gold_{a}") for a in AGGREGATES]


def test_aggregate_states_merge_to_a_full_rebuild(spark, tmp_path):
    cfg = config(tmp_path)
    r = Runner(spark, cfg)
    land_readings(cfg, 0, [reading(1, 28, 10, 1.0), reading(1, 28, 11, 2.0), reading(1, 29, 10, 3.0), reading(2, 28, 10, None)])
    assert run_measurements(r) == ["full", "full"]
    aggregates(r)
    # new readings only: the states of the touched dates are merged
    land_readings(cfg, 1, [reading(1, 28, 12, 5.0), reading(3, 28, 1, 7.0), reading(2, 28, 10, 4.0, lf.NO2)])
    assert run_measurements(r) == ["merge", "merge"]
    stamps = {x.date.day: x.load_timestamp for x in r.read("gold", AGGREGATES[0]).collect()}
    assert len(aggregates(r)) == 5 and stamps[28] > stamps[29]  # the other date wasn't written
    # a least value that is revised upwards, a null that gets a value, another interval
    land_readings(cfg, 2, [reading(1, 28, 10, 9.0), reading(2, 28, 10, 8.0), reading(3, 28, 1, 7.0, interval="00:30:00"), reading(1, 28, 13, 6.0)])
    assert run_measurements(r) == ["merge", "merge"]
    got = aggregates(r)
    assert (1, dt.date(2025, 12, 28), 2.0) in got
    assert run_measurements(r) == ["skip", "skip"]


@pytest.mark.parametrize("few", [tables.FEW, -1])
def test_a_fact_table_is_merged_as_it_is_written(spark, tmp_path, monkeypatch, few):
    """Only rows of keys that come again are shuffled by key, if those are few,
    and merged rows aren't written twice."""
    monkeypatch.setattr(tables, "FEW", few)
    staged, stage = {}, tables._Stages.stage

    def counted(self, df, tag):
        out = stage(self, df, tag)
        staged.setdefault(tag, []).append(out.count())
        return out

    monkeypatch.setattr(tables._Stages, "stage", counted)
    r = Runner(spark, config(tmp_path))
    land_readings(r.cfg, 0, [reading(1, 28, 10, 1.0), reading(1, 28, 11, 2.0), reading(2, 28, 10, None)])
    run_measurements(r)
    land_readings(r.cfg, 1, [reading(1, 28, 10, 9.0), reading(1, 28, 10, 9.0), reading(3, 28, 1, 7.0)])
    run_measurements(r)
    assert "merged" not in staged and "recomputed" not in staged
    # nothing is archived, so bronze reads its three rows again; one key of silver comes again
    assert staged["repeated"] == [0, 3, 1]
    assert rows(r.read("bronze", "measurement"), "sensor_id", "value") == [(1, 2.0), (1, 9.0), (2, None), (3, 7.0)]
    assert rows(r.table("silver_measurement").changes(r.table("silver_measurement").loads().orderBy(F.desc("load_timestamp")).limit(1)), "_change", "value") \
        == [("added", 7.0), ("added", 9.0), ("replaced", 1.0)]
    aggregates(r)


def test_several_pending_loads_are_merged_once(spark, tmp_path, monkeypatch):
    cfg = config(tmp_path)
    r = Runner(spark, cfg)
    land_readings(cfg, 0, [reading(1, 28, 10, 1.0)])
    run_measurements(r)
    for k, value in ((1, 2.0), (2, 3.0)):  # two silver loads, the second revises the first
        land_readings(cfg, k, [reading(1, 28, 11, value), reading(k, 29, 5, 1.0)])
        for m in ("bronze_measurement", "silver_measurement"):
            r.run_model(m)
    # the first try fails after the state was written, before the load counts as taken in
    fail = r.table("gold_measurement_daily_aggregate").__class__
    consume = fail.consume
    monkeypatch.setattr(fail, "consume", lambda self, *a: (_ for _ in ()).throw(OSError("lost")))
    for a in AGGREGATES:
        with pytest.raises(OSError):
            r.run_model(f"gold_{a}")
    monkeypatch.setattr(fail, "consume", consume)
    assert [r.run_model(f"gold_{a}") for a in AGGREGATES] == ["merge", "merge"]
    aggregates(r)
    # a full refresh of silver keeps no feed: everything is made anew
    r.run_model("silver_measurement", full_refresh=True)
    assert [r.run_model(f"gold_{a}") for a in AGGREGATES] == ["full", "full"]
    aggregates(r)


def test_a_moved_location_changes_two_groups(spark, tmp_path):
    cfg = config(tmp_path)
    lf.land_first_batch(cfg.landing_root)
    r = Runner(spark, cfg, load_ts=T1)
    names = ("bronze_country", "silver_country", "bronze_location", "silver_location", "gold_location", "gold_locality")
    for n in names:
        r.run_model(n)
    versions = [r.table(n).current_version() for n in names[4:]]
    assert [Runner(spark, cfg, load_ts=T2).run_model(n) for n in names[4:]] == ["skip", "skip"]
    assert [r.table(n).current_version() for n in names[4:]] == versions
    before = {x.id: x for x in r.read("gold", "locality").collect()}
    # 100 was the least of Belgrade; it moves to Sarajevo's country and place
    lf.write_page(cfg.landing_root, "location", [lf.location(100, "Moved", " Sarajevo ", 110, "BA", 1.0, 2.0)], "location_b2", dt.datetime(2025, 12, 31))
    second = Runner(spark, cfg, load_ts=T2)
    assert [second.run_model(n) for n in names[2:]] == ["upsert", "upsert", "groups", "groups"]
    got = {(x.id, x.name): x for x in second.read("gold", "locality").collect()}
    assert set(got) == {(101, "Belgrade"), (102, "Novi Sad"), (100, "Sarajevo")}
    assert got[102, "Novi Sad"] == before[102] and got[100, "Sarajevo"].load_timestamp == got[101, "Belgrade"].load_timestamp > before[102].load_timestamp
    assert rows(second.read("gold", "location"), "id", "locality_id") == [(100, 100), (101, 101), (102, 102), (103, 100)]
    # a country's new code touches its groups only, and no location
    lf.write_page(cfg.landing_root, "country", [lf.country(110, "BH", "Bosnia")], "country_b2", dt.datetime(2025, 12, 31))
    third = Runner(spark, cfg, load_ts=T3)
    assert [third.run_model(n) for n in ("bronze_country", "silver_country", *names[4:])] == ["upsert", "upsert", "skip", "groups"]
    last = {x.id: x for x in third.read("gold", "locality").collect()}
    assert last[100].display_name == "Sarajevo, BH" and last[101] == got[101, "Belgrade"]


def test_places_and_countries_may_be_null(spark, tmp_path):
    cfg = config(tmp_path)
    r = Runner(spark, cfg)
    odd = [lf.location(i, None, None, None, None, 1.0 * i, 2.0) for i in (1, 2)] + [lf.location(3, "a", None, None, None, 1.0, 1.0)]
    for k, recs in enumerate((odd[:1] + odd[2:], odd[1:2])):
        lf.write_page(cfg.landing_root, "country", [lf.country(80, "RS", "Serbia")], f"c{k}", dt.datetime(2025, 12, 30 + k))
        lf.write_page(cfg.landing_root, "location", recs, f"l{k}", dt.datetime(2025, 12, 30 + k))
        for n in ("bronze_country", "silver_country", "bronze_location", "silver_location", "gold_location", "gold_locality"):
            r.run_model(n)
    assert rows(r.read("gold", "location"), "id", "locality_id") == [(1, 1), (2, 1), (3, 3)]
    assert sorted((x.id, x.name, x.coordinates_latitude) for x in r.read("gold", "locality").where("id = 1").collect()) == [(1, None, 1.5)]
