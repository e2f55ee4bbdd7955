"""Frame-level incremental semantics: keyed upsert, append, recompute.

These build the *content* of the next table version as a lazy plan; the
sinks in :mod:`medallion.sinks` decide how it is written (new version,
touched partitions, append).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.operators.dedup import latest_wins, not_null, resolve_repeated
from medallion.operators.joins import anti_join


def upsert_frame(target: DataFrame | None, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in the batch, plus all batch rows.

    Delete-matched-then-insert: a batch row replaces every target row with
    the same key.  Null-key batch rows never match anything.  Columns are
    aligned by name (the batch may carry columns in another order).
    """
    if target is None:
        return batch
    # batch keys are (nearly) unique: no pre-aggregation, so the anti join
    # sits directly on its shuffles and AQE can split a hot target key
    kept = anti_join(target, batch, list(keys), dedup=False)
    return kept.unionByName(batch.select(*target.columns), allowMissingColumns=False)


def append_frame(target: DataFrame | None, batch: DataFrame) -> DataFrame:
    """Target rows followed by the batch rows (``UNION ALL``)."""
    if target is None:
        return batch
    return target.unionByName(batch.select(*target.columns))


def empty_like(df: DataFrame) -> DataFrame:
    """Zero rows with ``df``'s schema (``WHERE 1 = 0``): Spark plans it as
    an empty local relation and reads nothing."""
    return df.where(F.lit(False))


def touched_values(batch: DataFrame, column: str) -> DataFrame:
    """Distinct values of ``column`` in the batch (e.g. the dates it touches)."""
    return batch.select(column).distinct()


def merge_newest(target: DataFrame, batch: DataFrame, keys: Sequence[str], version: str, load: str,
                 repeated: DataFrame | None = None) -> DataFrame:
    """Per key, the rows of the newest version over target and batch.

    A row that both hold (equal but for the ``load`` column) is kept once, as
    first loaded.  So any order and split of the batches, and a batch loaded
    again, give the rows that one load of everything gives.  Equal rows have one
    version, so they are put together after older versions went, on the
    partitions of the join that drops those.

    ``repeated``: the keys with several rows in both together, if they are few
    (:func:`medallion.operators.dedup.repeated_keys`).
    """
    both = target.unionByName(batch.select(*target.columns))
    content = [c for c in target.columns if c != load]

    def newest(rows: DataFrame) -> DataFrame:
        return latest_wins(rows, keys, version).groupBy(*content).agg(F.min(load).alias(load)).select(*target.columns)

    return resolve_repeated(both.where(not_null(keys, version)), keys, repeated, newest)


def rebuild_touched(source: DataFrame, touched: DataFrame, column: str, build, *, source_column=None) -> DataFrame:
    """``build`` over all ``source`` rows of the touched values of ``column``.

    ``touched`` is a small frame (the dates of a batch: bounded by the
    calendar, however many rows the batch has); it is broadcast, so the
    source isn't shuffled for it and, where it is partitioned by the column,
    only the touched partitions are scanned.
    """
    dates = F.broadcast(touched.select(F.col(column).alias("__touch")).distinct())
    key = F.col(column) if source_column is None else F.col(source_column) if isinstance(source_column, str) else source_column
    return build(source.join(dates, key == F.col("__touch"), "left_semi"))


def recompute_touched(target: DataFrame | None, source: DataFrame, touched: DataFrame,
                      column: str, build, *, source_column=None) -> DataFrame:
    """The target with the aggregate of the touched values of ``column``
    recomputed from all their source rows, so a group split over two batches
    yields one row, identical to a full rebuild.  ``source_column`` (name or
    Column) maps ``source`` rows to ``column`` values when it is not a
    column of ``source`` itself.
    """
    fresh = rebuild_touched(source, touched, column, build, source_column=source_column)
    if target is None:
        return fresh
    dates = F.broadcast(touched.select(F.col(column).alias("__touch")).distinct())
    kept = target.join(dates, target[column] == F.col("__touch"), "left_anti")
    return kept.unionByName(fresh.select(*target.columns))
