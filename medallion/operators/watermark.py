"""High-water marks and freshness filters.

The mark is a scalar subquery (``DataFrame.scalar()``), so it stays inside
one plan: Spark evaluates the ``max`` first and pushes the comparison to
the Parquet scan as a data filter (row-group skipping on the timestamp).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.functions.exprs import EPOCH_FLOOR, col_of, instant


def _field_type(df: DataFrame, name: str) -> T.DataType | None:
    for f in df.schema.fields:
        if f.name == name:
            return f.dataType
    return None


def floor_for(dtype: T.DataType | None) -> Column:
    """``'1900-01-01'`` typed like the watermark column."""
    target = dtype.simpleString() if dtype is not None else "timestamp"
    return F.lit(EPOCH_FLOOR).cast(target)


def high_watermark(target: DataFrame | None, column: str = "load_timestamp") -> Column:
    """``coalesce(max(target.column), '1900-01-01')`` as a scalar column.

    ``target=None`` (table not created yet) gives the floor itself.
    """
    if target is None:
        return floor_for(None)
    dtype = _field_type(target, column)
    return target.select(F.coalesce(F.max(col_of(column)), floor_for(dtype))).scalar()


def newer_than(df: DataFrame, column: str, mark: Column) -> DataFrame:
    """Rows strictly newer than the mark (null timestamps drop out)."""
    return df.where(col_of(column) > mark)


def incremental_filter(batch: DataFrame, target: DataFrame | None, *,
                       batch_column: str = "load_timestamp",
                       target_column: str = "load_timestamp") -> DataFrame:
    """Keep batch rows newer than the target's newest load time."""
    return newer_than(batch, batch_column, high_watermark(target, target_column))


def last_seen_field(df: DataFrame, struct_field: str = "datetime_last", leaf: str = "utc") -> Column:
    """``datetime_last.utc`` whether landed flat (dotted name) or nested."""
    dotted = f"{struct_field}.{leaf}"
    if dotted in df.columns:
        return col_of(dotted)
    if struct_field in df.columns:
        return F.col(struct_field).getField(leaf)
    snake = f"{struct_field}_{leaf}"
    if snake in df.columns:
        return F.col(snake)
    raise ValueError(f"no {dotted} column in {df.columns}")


def fresh_ids(df: DataFrame, mark: Column | str, *, id_column: str = "id",
              struct_field: str = "datetime_last", leaf: str = "utc") -> DataFrame:
    """Ids whose last reading (ISO text, offset honoured) is after ``mark``.

    A null last reading is never fresh (the comparison is null).
    """
    if isinstance(mark, str):
        mark = instant(F.lit(mark))
    last = instant(last_seen_field(df, struct_field, leaf))
    return df.where(last > mark).select(col_of(id_column).alias(id_column))


def default_mark(days: int = 7) -> Column:
    """First-run look-back: now minus ``days`` days."""
    return F.current_timestamp() - F.make_dt_interval(F.lit(days))
