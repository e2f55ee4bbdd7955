from medallion.operators.quality import KeySpec, duplicate_report, not_null, relationships, run_checks, unique
from tests.conftest import rows


def test_unique_ignores_nulls(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "id long")
    assert rows(unique(df, "id")) == [(1, 2)]
    assert unique(df.where("id = 2"), "id").isEmpty()


def test_not_null(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "id long, v string")
    assert rows(not_null(df, "id"), "v") == [("b",)]
    assert not_null(df.where("id = 1"), "id").isEmpty()


def test_relationships(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "fk long")
    parent = spark.createDataFrame([(1,)], "id long")
    assert rows(relationships(child, "fk", parent, "id")) == [(2,), (2,)]
    assert relationships(child.where("fk = 1"), "fk", parent, "id").isEmpty()
    # beyond the broadcast bound the result is the same (shuffled anti join)


def test_duplicate_report_mixes_int_and_composite_keys(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "id long")
    m = spark.createDataFrame([(1, 2, "t0", "t1"), (1, 2, "t0", "t1"), (1, 3, "t0", "t1")],
                              "sensor_id long, parameter_id long, f string, t string")
    rep = duplicate_report([KeySpec("bronze_country", a, ("id",)),
                            KeySpec("bronze_measurement", m, ("sensor_id", "parameter_id", "f", "t"))])
    assert rep.columns == ["id", "table_name", "count"]
    assert rows(rep) == [("1", "bronze_country", 2), ("1|2|t0|t1", "bronze_measurement", 2)]


def test_run_checks_counts(spark):
    df = spark.createDataFrame([(1,), (1,)], "id long")
    got = rows(run_checks({"u": unique(df, "id"), "n": not_null(df, "id")}))
    assert got == [("n", 0), ("u", 1)]


def test_key_tests_from_one_scan_of_each_table(spark):
    from medallion.operators.quality import duplicates_of, key_failures, key_suspects

    a = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "id long")
    b = spark.createDataFrame([(1, "x"), (1, "x"), (1, None), (2, "y|z"), (2, "y|z"), (2, "y|z")], "k long, s string")
    c = spark.createDataFrame([(1,), (2,)], "id long")
    specs = [KeySpec("a", a, ("id",)), KeySpec("b", b, ("k", "s")), KeySpec("c", c, ("id",))]
    found = key_suspects(specs)
    assert rows(key_failures(found), "table_name", "unique", "not_null") == [("a", 1, 2), ("b", 2, 1)]
    assert rows(duplicates_of(found)) == rows(duplicate_report(specs))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 3 or plan.count("LocalTableScan") == 3
