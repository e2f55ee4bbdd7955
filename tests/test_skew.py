"""A key holding a third of all rows: results stay whole and the joins that
could concentrate it are split by AQE's skew handling (final plans checked)."""

import contextlib

from pyspark.sql import functions as F

from medallion.operators.aggregates import with_locality_key
from medallion.operators.dedup import latest_wins
from medallion.operators.merge import upsert_frame
from tests.conftest import rows

SKEW_CONF = {
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


@contextlib.contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def skewed(spark, n=30_000):
    """Key 0 holds a third of the rows, all tied on the newest version."""
    hot = F.col("id") < n
    return spark.range(3 * n).select(
        F.when(hot, F.lit(0)).otherwise(F.col("id") % 5000 + 1).cast("long").alias("k"),
        F.when(hot, F.lit(9)).otherwise(F.col("id") % 7).cast("long").alias("ts"),
        F.col("id").alias("v"))


def final_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_wins_hot_key_is_whole_and_split(spark):
    with conf(spark, SKEW_CONF):
        df = skewed(spark).repartition(8)
        got = latest_wins(df, ["k"], "ts")
        n = got.count()
        expected = latest_wins(df, ["k"], "ts", strategy="window").count()
        assert n == expected
        assert got.where("k = 0").count() == 30_000  # every tied row of the hot key is kept
        got.collect()
        plan = final_plan(got)
        assert "isFinalPlan=true" in plan
        assert "skew=true" in plan, plan


def test_upsert_anti_join_with_hot_key(spark):
    with conf(spark, SKEW_CONF):
        target = skewed(spark).repartition(8)
        batch = spark.range(100).select((F.col("id") + 1).alias("k"), F.lit(99).cast("long").alias("ts"),
                                        F.lit(-1).cast("long").alias("v"))
        out = upsert_frame(target, batch, ["k"])
        out.collect()
        assert out.where("k = 0").count() == 30_000
        assert out.where("k between 1 and 100 and v != -1").count() == 0
        assert "skew=true" in final_plan(out)


def test_locality_key_with_hot_locality(spark):
    with conf(spark, SKEW_CONF):
        loc = spark.range(30_000).select(
            F.col("id").alias("id"), F.lit("n").alias("name"),
            F.when(F.col("id") % 3 == 0, F.lit("Hot")).otherwise(F.concat(F.lit("L"), (F.col("id") % 500).cast("string")))
            .alias("locality"),
            F.lit(1).alias("country_id")).repartition(8)
        got = with_locality_key(loc)
        assert rows(got.where("locality = 'Hot'").select("locality_id").distinct()) == [(0,)]
        assert got.count() == 30_000


def test_parent_child_semi_join_with_hot_parent(spark):
    from medallion.operators.selection import select_children

    with conf(spark, SKEW_CONF):
        children = skewed(spark).repartition(8)
        parents = spark.range(0, 2000).select(F.col("id").alias("id"))
        got = select_children(children, "k", parents)
        got.collect()
        assert got.where("k = 0").count() == 30_000
        assert got.count() == children.where("k < 2000").count()
        assert "skew=true" in final_plan(got)


def test_pages_of_a_hot_sensor_are_bounded(spark, tmp_path, monkeypatch):
    from medallion import flow_queries

    pages = str(tmp_path / "pages")
    monkeypatch.setattr(flow_queries, "staging_path", lambda spark, name: pages)
    events = spark.range(200_000).select(
        F.col("id").alias("event_id"), F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("ts"), F.when(F.col("id") % 10 > 0, 7).when(F.col("id") % 20 > 0, 8).cast("long").alias("user_id"),
        F.lit("t").alias("event_type"), F.lit(1.5).alias("value"))
    events.repartition(2).write.parquet(str(tmp_path / "events.parquet"))
    got = flow_queries.q_page_flatten(spark, str(tmp_path))
    assert rows(got.groupBy("sensor_id").count()) == [(7, 180_000), (8, 10_000), (None, 10_000)]
    assert got.select("parameter_id").distinct().count() == 200_000
    most = spark.read.json(f"{pages}/measurement").select(F.max(F.size("results"))).first()[0]
    assert most <= 8192
