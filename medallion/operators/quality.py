"""Data-quality tests: each returns a DataFrame of failing rows.

A test passes when its DataFrame is empty.  Semantics follow the usual
column tests: ``unique`` and ``relationships`` ignore null values,
``not_null`` reports every null.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.functions.exprs import col_of, key_text


def _as_list(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def unique(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Key values occurring more than once, with their row count ``n_records``.

    A partial + final count per key: a hot key collapses map-side.
    """
    cols = _as_list(columns)
    cond = reduce(lambda a, b: a & b, [col_of(c).isNotNull() for c in cols])
    return (df.where(cond)
            .groupBy(*[col_of(c).alias(c) for c in cols])
            .agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1))


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is null (whole rows, as the test reports them)."""
    return df.where(col_of(column).isNull())


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child values of ``column`` with no ``parent.field`` (one row per child row).

    The parent's keys are not made distinct first: an anti join doesn't
    repeat rows, parents are keyed by ``field``, and with the join right on
    its shuffles AQE can broadcast small parents by their measured size and
    split a hot child key.
    """
    keys = parent.select(col_of(field).alias("to_field")).where(F.col("to_field").isNotNull())
    kids = child.select(col_of(column).alias("from_field")).where(F.col("from_field").isNotNull())
    return kids.join(keys, kids["from_field"] == keys["to_field"], "left_anti")


@dataclass(frozen=True)
class KeySpec:
    """One branch of the duplicate report: a table and its grain."""

    table_name: str
    frame: DataFrame
    keys: tuple[str, ...]


def duplicate_branch(spec: KeySpec) -> DataFrame:
    """``id`` (key as text), ``table_name``, ``count`` for keys seen > 1 time."""
    keys = list(spec.keys)
    grouped = (spec.frame.groupBy(*[col_of(k).alias(f"__dk{i}") for i, k in enumerate(keys)])
               .agg(F.count(F.lit(1)).alias("count"))
               .where(F.col("count") > 1))
    if len(keys) == 1:
        ident = F.col("__dk0").cast("string")
    else:
        ident = key_text(*[F.col(f"__dk{i}") for i in range(len(keys))])
    return grouped.select(ident.alias("id"), F.lit(spec.table_name).alias("table_name"), "count")


def _text_is_injective(spec: KeySpec) -> bool:
    """Can two different keys of this branch render to the same text?

    A single key casts injectively (null stays null).  A composite key
    joined with ``|`` is injective when no part is text: numbers, dates and
    times never contain ``|`` and are never empty, so null (rendered empty)
    cannot collide either.
    """
    if len(spec.keys) == 1:
        return True
    types = dict(spec.frame.dtypes)
    return all(types.get(k, "string") not in ("string", "binary") for k in spec.keys)


def duplicate_report(specs: Sequence[KeySpec]) -> DataFrame:
    """Union (distinct) of the duplicate branches of many tables.

    Every branch is an independent partial+final aggregate; keys are cast to
    text before the union so integer and composite keys mix.  Rows of
    different branches differ in ``table_name``, so the ``UNION``'s
    de-duplication is only needed inside a branch whose key text can
    collide; only those branches get a ``distinct`` (on their small,
    already aggregated output) and the union itself needs no shuffle.
    """
    names = [s.table_name for s in specs]
    if len(set(names)) != len(names):  # branches could repeat rows: full UNION semantics
        return reduce(DataFrame.unionByName, [duplicate_branch(s) for s in specs]).distinct()
    parts = [duplicate_branch(s) if _text_is_injective(s) else duplicate_branch(s).distinct()
             for s in specs]
    return reduce(DataFrame.unionByName, parts)


def key_suspects(specs: Sequence[KeySpec]) -> DataFrame:
    """What the key tests of many tables need, from one scan and one
    aggregation of each: ``id`` (the key as text), ``table_name``, ``count`` and
    ``null_key`` of the keys that occur more than once or have a null part.  A
    table that passes has no row here, so the frame is small and is written by
    its user before the tests read it."""
    parts = []
    for spec in specs:
        names = [f"__k{i}" for i in range(len(spec.keys))]
        grouped = spec.frame.groupBy(*[col_of(k).alias(n) for k, n in zip(spec.keys, names)]).agg(F.count(F.lit(1)).alias("count"))
        null_key = reduce(lambda a, b: a | b, [F.col(n).isNull() for n in names])
        ident = F.col(names[0]).cast("string") if len(names) == 1 else key_text(*[F.col(n) for n in names])
        parts.append(grouped.where((F.col("count") > 1) | null_key)
                     .select(ident.alias("id"), F.lit(spec.table_name).alias("table_name"), "count", null_key.alias("null_key")))
    return reduce(DataFrame.unionByName, parts)


def duplicates_of(suspects: DataFrame) -> DataFrame:
    """The duplicate report, from the suspects of its tables."""
    return suspects.where(F.col("count") > 1).select("id", "table_name", "count").distinct()


def key_failures(suspects: DataFrame) -> DataFrame:
    """Per table with a suspect: failures of the tests ``unique`` (keys without
    null that repeat) and ``not_null`` (rows whose key has a null)."""
    repeats = ~F.col("null_key") & (F.col("count") > 1)
    return suspects.groupBy("table_name").agg(
        F.sum(F.when(repeats, 1).otherwise(0)).alias("unique"), F.sum(F.when(F.col("null_key"), F.col("count")).otherwise(0)).alias("not_null"))


def run_checks(checks: dict[str, DataFrame]) -> DataFrame:
    """Count failures of named checks into one ``(test, failures)`` frame.

    All counts are computed in one Spark job (a union of per-test counts).
    """
    counts = [df.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("test"), "failures")
              for name, df in checks.items()]
    return reduce(DataFrame.unionByName, counts)
