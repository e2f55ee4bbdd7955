"""Extraction control: the high-water mark of landed data and the
parent -> child selection of what to fetch next.

Marks live in a small Parquet control table, the newest of which is read as a
scalar subquery (never collected) and advanced only after a successful load.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.functions.exprs import instant, utc_lit
from medallion.operators.joins import semi_join
from medallion.operators.watermark import default_mark, fresh_ids
from medallion.sources.landing import files_exist

MARK_COLUMN = "last_extraction_timestamp"


def read_mark(spark: SparkSession, path: str, *, default_days: int = 7) -> Column:
    """The stored extraction mark, or now minus ``default_days`` on a first run."""
    if not files_exist(spark, path):
        return default_mark(default_days)
    stored = spark.read.parquet(path).select(F.max(MARK_COLUMN)).scalar()
    return F.coalesce(stored, default_mark(default_days))


def write_mark(spark: SparkSession, path: str, mark: _dt.datetime) -> None:
    """Advance the stored mark (call after the load it covers succeeded).
    Marks are appended and the newest counts, so a crash never loses one."""
    spark.range(1).select(utc_lit(mark).alias(MARK_COLUMN)).write.mode("append").parquet(path)


def period_between(df: DataFrame, column: str, lo: Column, hi: Column) -> DataFrame:
    """Rows whose period start lies in ``[lo, hi]`` (both edges inclusive)."""
    return df.where(instant(column).between(lo, hi))


def select_children(children: DataFrame, child_fk: str, parents: DataFrame, parent_key: str = "id") -> DataFrame:
    """Children of the selected parents (``child_fk IN (SELECT parent_key ...)``).

    Parent ids are unique, so the key side is not pre-aggregated and AQE
    can still split a parent with a hot share of the children.
    """
    return semi_join(children, parents, [child_fk], [parent_key], dedup=False)


def fresh_chain(locations: DataFrame, sensors: DataFrame, mark: Column | str) -> tuple[DataFrame, DataFrame]:
    """Fresh locations -> their fresh sensors: the ids whose measurements to fetch."""
    fresh_locations = fresh_ids(locations, mark)
    their_sensors = select_children(sensors, "location_id", fresh_locations)
    return fresh_locations, fresh_ids(their_sensors, mark)
