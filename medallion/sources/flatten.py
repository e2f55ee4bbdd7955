"""Nested record flattening (JSON API pages -> flat dotted columns -> snake names)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.functions.exprs import col_of, quote


def _leaves(schema: T.StructType, prefix: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    out: list[tuple[str, ...]] = []
    for f in schema.fields:
        path = prefix + (f.name,)
        if isinstance(f.dataType, T.StructType) and f.dataType.fields:
            out.extend(_leaves(f.dataType, path))
        else:
            out.append(path)
    return out


def _path_col(path: tuple[str, ...]) -> Column:
    c = F.col(quote(path[0]))
    for p in path[1:]:
        c = c.getField(p)
    return c


def flatten_structs(df: DataFrame, sep: str = ".") -> DataFrame:
    """Expand every nested struct into top-level leaf columns named ``a.b.c``.

    Arrays (also arrays of structs) stay as they are, like a JSON normalise:
    lists are carried, not exploded.  A pure projection: no shuffle.
    """
    paths = _leaves(df.schema)
    return df.select(*[_path_col(p).alias(sep.join(p)) for p in paths])


def snake_name(name: str) -> str:
    return name.replace(".", "_")


def dotted_to_snake(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rename ``"a.b.c"`` columns to ``a_b_c`` (optionally selecting only ``columns``)."""
    names = list(columns) if columns is not None else df.columns
    return df.select(*[col_of(c).alias(snake_name(c)) for c in names])


def explode_results(pages: DataFrame, results_field: str = "results",
                    keep: Sequence[str] = ()) -> DataFrame:
    """One row per element of an API page's ``results`` array, with page-level
    columns in ``keep`` carried along (e.g. the parent id of the request)."""
    return pages.select(*[col_of(k) for k in keep], F.explode(col_of(results_field)).alias("__r")).select(
        *[col_of(k) for k in keep], "__r.*")


def parse_json_pages(raw: DataFrame, text_column: str, schema: T.StructType | str) -> DataFrame:
    """Parse a JSON text column with a declared schema (no inference pass)."""
    return raw.withColumn("__json", F.from_json(col_of(text_column), schema))
