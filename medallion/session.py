"""Spark session defaults for medallion jobs.

The library never hard-codes cluster resources.  It only pins the settings
its semantics depend on (UTC session zone, AQE) and leaves sizing
(`spark.sql.shuffle.partitions`, executor memory, ...) to the submitter.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the pipeline semantics rely on.  Applied with `setIfMissing`
# semantics: a cluster submit that already sets them wins.
SEMANTIC_CONF = {
    # every *_utc column and the load timestamp are interpreted in UTC
    "spark.sql.session.timeZone": "UTC",
    # runtime re-planning: coalesce small shuffles, split skewed join
    # partitions, turn sort-merge joins into broadcast joins when the
    # measured (not estimated) build side is small
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}

# Broadcast policy: never broadcast on a *static* estimate (the planner
# sizes Parquet relations from compressed file sizes, which is no bound on
# the rows), but let AQE broadcast a join side whose *measured* shuffle
# output is small.  Only frames of dates and loads, bounded by the calendar,
# get an explicit hint.  Applied unless the submitter set the thresholds at
# launch.
BROADCAST_POLICY = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
}


# Sizing for very large inputs (opt-in: ``build_session(profile="cluster")``;
# values the submitter sets at launch win).  Start with many shuffle
# partitions and let AQE coalesce them towards the advisory size, so a
# 100 TB shuffle stays at ~256 MB per task and small ones shrink; read
# Parquet in 256 MB splits; treat a partition as skewed from 512 MB or 5x
# the median and split it.
CLUSTER_PROFILE = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512MB",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "32",
}


def build_session(master: str | None = None, app_name: str = "medallion",
                  extra: dict[str, str] | None = None, profile: str | None = None) -> SparkSession:
    """Create (or reuse) a session with the semantic defaults applied.

    ``profile="cluster"`` adds CLUSTER_PROFILE sizing for large inputs.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    for key, value in {**SEMANTIC_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_semantic_conf(spark)
    if profile == "cluster":
        _apply_unless_launched(spark, CLUSTER_PROFILE, skip=set(extra or {}))
    ensure_checkpoint_dir(spark)
    return spark


def apply_semantic_conf(spark: SparkSession) -> None:
    """Apply SEMANTIC_CONF to an existing session where a key is unset."""
    for key, value in SEMANTIC_CONF.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
    # the session zone is semantic, not tuning: always UTC
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    _apply_unless_launched(spark, BROADCAST_POLICY)


def _launch_conf(spark: SparkSession):
    """The context's launch configuration, or None on a remote (Connect)
    session, which has no local SparkContext."""
    try:
        return spark.sparkContext.getConf()
    except Exception:  # noqa: BLE001 - Connect sessions raise here
        return None


def _apply_unless_launched(spark: SparkSession, values: dict[str, str], skip: set[str] = frozenset()) -> None:
    """Set session values, except those given at launch (``--conf``,
    defaults file, builder) or listed in ``skip``."""
    launch = _launch_conf(spark)
    for key, value in values.items():
        if key not in skip and (launch is None or not launch.contains(key)):
            spark.conf.set(key, value)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster the submitter sets it to a shared file system and we only
    read it.  Only when it is unset (local tests) do we create a scratch
    folder and register it as the checkpoint directory.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: the server owns the setting
        return spark.conf.get("spark.checkpoint.dir", "") or ""
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        existing = sc.getCheckpointDir()
        if existing:
            return existing.rsplit("/", 1)[0]
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="medallion-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for lineage cuts."""
    import uuid

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/medallion-staging/{name}-{uuid.uuid4().hex}"
