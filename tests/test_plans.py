"""The physical plans have the shape we want at scale (pruned scans, pushed
filters, partial aggregation, checked broadcasts, no windows where a
group-by suffices)."""

import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")


def plan(spark, name):
    """The ``explain("formatted")`` text of a registered query."""
    df = entry.queries()[name](spark, SF)
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_hourly_aggregate_prunes_and_preaggregates(spark):
    p = plan(spark, "hourly_aggregate")
    assert "partial_avg" in p and "partial_count" in p
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in p
    assert "props" not in p.split("ReadSchema")[1].split("\n")[0]


def test_latest_wins_is_aggregate_plus_semi_join(spark):
    p = plan(spark, "latest_composite_key")
    assert "partial_max" in p and "LeftSemi" in p and "Window" not in p
    assert "PushedFilters: [IsNotNull(l_shipdate), IsNotNull(l_orderkey), IsNotNull(l_linenumber)]" in p


def test_watermark_is_a_pushed_scalar_subquery(spark):
    p = plan(spark, "watermark_filter")
    main_scan = p.split("===== Subqueries")[0]
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts,ScalarSubquery" in main_scan
    assert "partial_max" in p


def test_locality_key_uses_group_by_not_window(spark):
    p = plan(spark, "locality_window_key")
    assert "Window" not in p and "partial_min" in p


def test_relationship_test_joins_right_on_its_shuffles(spark):
    # so that AQE can broadcast a small parent and split a hot child key
    p = plan(spark, "dq_relationships").split("== Initial Plan")[0]
    assert "LeftAnti" in p and "Aggregate" not in p


def test_recompute_broadcasts_the_dates(spark):
    p = plan(spark, "incremental_daily_recompute")
    assert "BroadcastHashJoin LeftSemi" in p and "BroadcastHashJoin LeftAnti" in p and "SortMergeJoin" not in p


def test_empty_batch_is_optimised_to_the_target_scan(spark):
    # anti join with an empty relation and union with an empty relation are
    # both removed: the plan is a single scan of the target, no join
    p = plan(spark, "empty_batch")
    assert p.count("Scan parquet  (") == 1 and "Join" not in p and "Union" not in p


def test_session_policy_respects_launch_values(spark):
    from medallion.session import BROADCAST_POLICY, CLUSTER_PROFILE, apply_semantic_conf

    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    apply_semantic_conf(spark)
    assert spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold") in (
        BROADCAST_POLICY["spark.sql.adaptive.autoBroadcastJoinThreshold"], "10485760b", "10485760")
    assert "spark.sql.shuffle.partitions" in CLUSTER_PROFILE
