"""Run in a subprocess by test_resilience.py: a partitioned upsert whose batch
loses a task on its first attempt (simulated executor loss)."""

import datetime as dt
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from medallion.session import build_session  # noqa: E402
from medallion.sinks.tables import LayerTable  # noqa: E402


MARKER = os.environ.get("RESILIENCE_MARKER", "/tmp/resilience-marker")


def flaky(batches):
    tc = TaskContext.get()
    if tc.attemptNumber() == 0 and tc.partitionId() == 0:
        with open(MARKER, "a") as fh:  # evidence that the first attempt failed
            fh.write("failed attempt 0\n")
        raise RuntimeError("simulated executor loss")
    yield from batches


def main(root: str) -> None:
    spark = build_session("local[4,3]", extra={"spark.sql.shuffle.partitions": "4"})
    spark.sparkContext.setLogLevel("OFF")
    t = LayerTable(spark, root, "silver", "measurement", ("sensor_id", "from_utc"), "measurement_date")
    schema = "sensor_id long, from_utc string, value double"
    base = spark.range(400).select(F.col("id").alias("sensor_id"),
                                   F.concat(F.lit("2025-12-2"), (F.col("id") % 4).cast("string"),
                                            F.lit("T10:00:00Z")).alias("from_utc"),
                                   F.lit(1.0).alias("value"))
    t.upsert(base.withColumn("measurement_date", F.to_date("from_utc")), load_ts=dt.datetime(2025, 12, 30))
    batch = (spark.range(0, 400, 2).repartition(4)
             .select(F.col("id").alias("sensor_id"),
                     F.concat(F.lit("2025-12-2"), (F.col("id") % 4).cast("string"), F.lit("T10:00:00Z")).alias("from_utc"),
                     F.lit(2.0).alias("value"))
             .mapInPandas(flaky, schema)
             .withColumn("measurement_date", F.to_date("from_utc")))
    t.upsert(batch, load_ts=dt.datetime(2025, 12, 31))
    got = t.read()
    print(json.dumps({"failed_attempts": sum(1 for _ in open(MARKER)) if os.path.exists(MARKER) else 0,
                      "rows": got.count(),
                      "keys": got.select("sensor_id", "from_utc").distinct().count(),
                      "twos": got.where("value = 2.0").count(),
                      "ones": got.where("value = 1.0").count()}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
