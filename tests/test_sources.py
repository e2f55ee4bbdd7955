import datetime as dt
import os

import pandas as pd
from pyspark.sql import functions as F

from medallion.schemas import landing_schema, nested_schema
from medallion.sources.drift import align_to_schema, scan_drifting, union_aligned
from medallion.sources.flatten import dotted_to_snake, explode_results, flatten_structs
from medallion.sources.landing import archive_loaded, claim_new, files_exist, land, list_files, scan_landing, stamp_lineage
from tests import landing_fixtures as lf
from tests.conftest import rows


def test_flatten_then_snake(spark):
    df = spark.createDataFrame([(1, ((("2025-01-01T00:00:00Z",), "raw"),), [1, 2])],
                               "id long, period struct<p:struct<datetime_from:struct<utc:string>,label:string>>, "
                               "bounds array<int>")
    flat = flatten_structs(df)
    assert flat.columns == ["id", "period.p.datetime_from.utc", "period.p.label", "bounds"]
    snake = dotted_to_snake(flat)
    assert snake.columns == ["id", "period_p_datetime_from_utc", "period_p_label", "bounds"]
    assert snake.first().bounds == [1, 2]


def test_explode_api_pages(spark):
    pages = spark.createDataFrame([(7, [(1, "a"), (2, "b")])], "sensors_id long, results array<struct<id:long,n:string>>")
    got = explode_results(pages, keep=["sensors_id"])
    assert got.columns == ["sensors_id", "id", "n"]
    assert rows(got) == [(7, 1, "a"), (7, 2, "b")]


def test_json_pages_flatten_to_landing_columns(spark):
    schema = nested_schema("measurement")
    text = '{"value": 1.5, "period": {"datetime_from": {"utc": "2025-12-30T23:05:00Z"}}, "sensor_id": 3}'
    df = spark.createDataFrame([(text,)], "j string").select(F.from_json("j", schema).alias("r")).select("r.*")
    flat = flatten_structs(df)
    assert "period.datetime_from.utc" in flat.columns
    assert flat.select(F.col("`period.datetime_from.utc`")).first()[0] == "2025-12-30T23:05:00Z"


def test_drift_scan_unions_int_double_and_missing(spark, tmp_path):
    root = str(tmp_path)
    lf.land_first_batch(root)
    path = f"{root}/sensor"
    df = scan_drifting(spark, path, landing_schema("sensor"))
    assert dict(df.dtypes)["summary.min"] == "double"
    got = rows(df, "id", "summary.min", "latest.value", "location_id")
    assert got == [(1000, 1.0, 12.5, 100), (1001, 2.5, 12.5, 101), (1002, 3.5, None, 103)]


def test_plain_scan_and_listing(spark, tmp_path):
    root = str(tmp_path)
    assert not files_exist(spark, f"{root}/nothing")
    assert scan_landing(spark, root, "country", scope="new").count() == 0
    lf.land_first_batch(root)
    assert files_exist(spark, f"{root}/country/new")
    df = scan_landing(spark, root, "location", scope="new")
    assert df.count() == 4
    assert rows(df.where(F.col("`country.id`") == 110), "id") == [(103,)]


def test_land_stamp_and_archive(spark, tmp_path):
    root = str(tmp_path)
    rec = spark.createDataFrame([(1, "a")], "id long, name string")
    stamped = stamp_lineage(rec, parent_column="location_id", parent_value=5, at=dt.datetime(2025, 1, 1))
    assert stamped.columns == ["id", "name", "location_id", "extraction_timestamp"]
    assert land(rec.where("false"), root, "sensor") is None
    folder = land(stamped, root, "sensor", prefix="sensor")
    assert folder and os.path.basename(folder).startswith("sensor_")
    assert claim_new(spark, root, "sensor") == f"{root}/sensor/loading"
    assert archive_loaded(spark, root, "sensor") == 1
    assert not files_exist(spark, f"{root}/sensor/new")
    assert spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/sensor").count() == 1
    assert claim_new(spark, root, "sensor") is None and archive_loaded(spark, root, "sensor") == 0
    assert list_files(spark, f"{root}/nothing").count() == 0


def test_align_to_schema(spark):
    a = spark.createDataFrame([(1, 2)], "id long, v long")
    b = spark.createDataFrame([(2, 2.5, "x")], "id long, v double, extra string")
    target = a.schema.__class__.fromJson({"type": "struct", "fields": [
        {"name": "id", "type": "long", "nullable": True, "metadata": {}},
        {"name": "v", "type": "double", "nullable": True, "metadata": {}},
        {"name": "w", "type": "string", "nullable": True, "metadata": {}}]})
    got = union_aligned([a, b], target)
    assert got.dtypes == [("id", "bigint"), ("v", "double"), ("w", "string")]
    assert rows(got) == [(1, 2.0, None), (2, 2.5, None)]
    assert align_to_schema(a, target).columns == ["id", "v", "w"]


def test_json_normalize_fixture_has_dotted_names(tmp_path):
    p = lf.write_page(str(tmp_path), "country", [lf.country(1, "A", "a")], "b", dt.datetime(2025, 1, 1))
    cols = pd.read_parquet(p).columns
    assert "parameters" in cols and "extraction_timestamp" in cols


def test_read_api_pages_explode_flatten_stamp(spark, tmp_path):
    import json

    from medallion.sources.api_pages import read_api_pages

    pages = tmp_path / "pages"
    pages.mkdir()
    for sid, recs in [(1000, [lf.measurement(1.5, lf.PM25, lf.t(29, 10), lf.t(29, 11)),
                              lf.measurement(2.5, lf.PM25, lf.t(29, 11), lf.t(29, 12))]),
                      (1001, [lf.measurement(3.0, lf.NO2, lf.t(29, 10), lf.t(29, 11))])]:
        (pages / f"page-{sid}.json").write_text(json.dumps({"meta": {"page": 1}, "parent_id": sid,
                                                            "results": recs}))
    got = read_api_pages(spark, str(pages), "measurement", extracted_at=dt.datetime(2025, 12, 30, 6))
    assert got.columns == landing_schema("measurement").fieldNames()
    assert rows(got, "sensor_id", "value", "period.datetime_from.utc", "parameter.id") == [
        (1000, 1.5, lf.t(29, 10), 2), (1000, 2.5, lf.t(29, 11), 2), (1001, 3.0, lf.t(29, 10), 5)]
    assert {r.extraction_timestamp for r in got.select("extraction_timestamp").collect()} == {
        dt.datetime(2025, 12, 30, 6)}
    # landed, it is read back by the landing scan
    land(got, str(tmp_path / "raw"), "measurement")
    assert scan_landing(spark, str(tmp_path / "raw"), "measurement", scope="new").count() == 3


def test_a_relanded_batch_is_archived_beside_the_first(spark, tmp_path):
    root = str(tmp_path)
    rec = stamp_lineage(spark.createDataFrame([(1, "a")], "id long, name string"), at=dt.datetime(2025, 1, 1))
    for _ in range(2):
        rec.write.parquet(f"{root}/country/new/country_b1")
        claim_new(spark, root, "country")
        assert archive_loaded(spark, root, "country") == 1
    assert sorted(os.listdir(f"{root}/country/{d}") for d in os.listdir(f"{root}/country") if d.startswith("load_")) == [["country_b1"]] * 2


def test_pages_with_empty_lists_and_all_null_fields(spark, tmp_path):
    root, e1 = str(tmp_path), dt.datetime(2025, 12, 30, 6)
    a, b, c = (lf.location(i, "n", "l", 80, "RS", 1.0, 2.0) for i in (1, 2, 3))
    a["instruments"], a["sensors"] = [], []
    b["sensors"] = [{"id": 20, "name": "s", "parameter": {"id": 2, "name": "pm25", "units": "u", "display_name": None}}]
    c["instruments"], c["bounds"], c["distance"] = None, [1, 2], 3
    for i, rec in enumerate((a, b, c)):
        lf.write_page(root, "location", [rec], f"b %#{i}", e1)
    for i, ps in enumerate(([], [{**lf.PM25, "display_name": None}], [lf.PM25], None)):
        lf.write_page(root, "country", [{**lf.country(i, "c", "n"), "parameters": ps}], f"b{i}", e1)
    got = {r.id: r for r in scan_drifting(spark, f"{root}/location", landing_schema("location")).collect()}
    assert got[1].instruments == [] and got[3].instruments is None and got[2].instruments[0].name == "Government Monitor"
    assert got[2].sensors[0].parameter.display_name is None and got[2].sensors[0].parameter.units == "u"
    assert got[3].bounds == [1.0, 2.0] and got[3].distance == 3.0 and got[1].distance is None
    got = {r.id: r.parameters for r in scan_drifting(spark, f"{root}/country", landing_schema("country")).collect()}
    assert got[0] == [] and got[1][0].display_name is None and got[2][0].display_name == "PM2.5" and got[3] is None


def write(path, **columns):
    import pyarrow as pa
    import pyarrow.parquet as pq

    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(pa.table(columns), path)


def test_columns_of_any_type_are_aligned(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyspark.sql import types as T

    at = dt.datetime(2024, 1, 2, 3, 4, 5, 123456)
    item = pa.list_(pa.struct([("x", pa.float64())]))
    shapes = {
        "floats": {"l": pa.array([[{"x": 1.0}], None, [], [{"x": None}, None]], item)},
        "empty": {"l": pa.array([[], None, [None], []], pa.list_(pa.null()))},
        "all null": {"l": pa.nulls(4), "n": pa.nulls(4), "s": pa.nulls(4), "t": pa.nulls(4)},
        "text": {"n": pa.array(["1", "x", None, "2"]), "s": pa.array([{"x": 1}, None, {"x": 2}, {"x": None}], pa.struct([("x", pa.int64())]))},
        "no struct": {"s": pa.array([1, 2, 3, 4]), "n": pa.array([1.9, -1.9, float("nan"), None])},
        "small": {"n": pa.array([1, 2, 3, None], pa.int16()), "s": pa.array([{"y": "z"}] * 4)},
        "dict": {"n": pa.array([1, 2, None, 3], pa.uint32()), "t": pa.array([at] * 4, pa.timestamp("us"))},
        "nanos": {"t": pa.array([at] * 4, pa.timestamp("ns", "UTC"))},
        "words": {"t": pa.array(["2024-01-02T03:04:05.123456Z", "soon", None, ""]), "n": pa.array([True, False, None, True])},
        "binary": {"n": pa.array([b"1"] * 4), "more": pa.array([1] * 4)},
    }
    for name, columns in shapes.items():
        write(f"{tmp_path}/{name} [*]{{a}}.parquet", k=pa.array([f"{name}{i}" for i in range(4)]).dictionary_encode(), **columns)
    pq.write_table(pa.table({"k": [f"old{i}" for i in range(4)], "t": pa.array([at] * 4, pa.timestamp("us"))}), f"{tmp_path}/old.parquet", use_deprecated_int96_timestamps=True)
    shapes["old"] = {}
    schema = T.StructType.fromDDL("k string, l array<struct<x: long, y: string>>, n long, s struct<x: string>, t timestamp")
    got = {r.k: r for r in scan_drifting(spark, str(tmp_path), schema).collect()}
    assert len(got) == 4 * len(shapes)
    column = lambda name, c: [got[f"{name}{i}"][c] for i in range(4)]
    assert column("floats", "l") == [[(1, None)], None, [], [(None, None), None]]
    assert column("empty", "l") == [[], None, [None], []] and column("all null", "l") == [None] * 4
    assert column("text", "n") == [1, None, None, 2] and column("text", "s") == [("1",), None, ("2",), (None,)]
    assert column("no struct", "s") == [None] * 4 and column("no struct", "n")[:2] == [1, -1]
    assert column("small", "n") == [1, 2, 3, None] and column("dict", "n") == [1, 2, None, 3]
    assert column("dict", "t") == column("nanos", "t") == column("old", "t") == [at] * 4 and column("words", "t") == [at, None, None, None]
    assert column("words", "n") == [1, 0, None, 1]


def test_a_scan_for_each_signature_with_pruning_and_pushdown(spark, tmp_path):
    import pyarrow as pa
    from pyspark.sql import types as T

    for i in range(6):
        write(f"{tmp_path}/p{i}.parquet", id=pa.array([i, i + 10]), v=pa.array([1, 2]) if i % 2 else pa.array([0.5, 1.5]), w=pa.array(["a", "b"]))
    df = scan_drifting(spark, str(tmp_path), T.StructType.fromDDL("id long, v double, w string")).where("id > 5").select("id", "v")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2 and "MapInArrow" not in plan
    assert plan.count("ReadSchema: struct<id:bigint,v:double>") == 1 and plan.count("ReadSchema: struct<id:bigint,v:bigint>") == 1
    assert plan.count("PushedFilters: [IsNotNull(id), GreaterThan(id,5)]") == 2
    assert df.count() == 6 + 0 and rows(df, "v")[0] == (1.5,)


def test_files_too_large_for_the_footer_job(spark, tmp_path, monkeypatch):
    import pyarrow as pa
    from pyspark.sql import types as T

    from medallion.sources import drift

    monkeypatch.setattr(drift, "LARGE", 0)
    write(f"{tmp_path}/a.parquet", id=pa.array([1]), v=pa.array([3]))
    write(f"{tmp_path}/b.parquet", id=pa.array([2]), v=pa.array([2.5]))
    got = scan_drifting(spark, str(tmp_path), T.StructType.fromDDL("id long, v double"))
    assert rows(got) == [(1, 3.0), (2, 2.5)]
