"""Layers as databases of the session's catalog, tables as views of their
committed version: ``spark.table("gold.location")``.

A view names the folder of a version, so it is replaced when another version is
committed (:func:`publish` after the write); loads that work inside a version
need nothing, since a view lists its files when it is read.  The version before
is kept, so a reader that has resolved the view is not disturbed.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from medallion.sinks.tables import LayerTable
from medallion.sources import fs


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def database(prefix: str, layer: str) -> str:
    return f"{prefix}{layer}"


def publish(spark: SparkSession, table: LayerTable, prefix: str = "") -> str | None:
    """(Re)create the view of ``table``'s current version; its name, or None
    where the table was never written.  A version without files has a view
    without rows and the table's columns."""
    df = table.read()
    if df is None:
        return None
    layer = database(prefix, table.layer)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(layer)} LOCATION '{table.root.rstrip('/')}/_catalog/{table.layer}'")
    name = f"{_quoted(layer)}.{_quoted(table.alias)}"
    cast = "CAST({} AS {}) AS {}"
    if fs.has_file(spark, table.data()):
        columns = [cast.format(_quoted(f.name), f.dataType.simpleString(), _quoted(f.name)) for f in df.schema]
        query = f"SELECT {', '.join(columns)} FROM parquet.{_quoted(table.data())}"
    else:
        columns = [cast.format("NULL", f.dataType.simpleString(), _quoted(f.name)) for f in df.schema]
        query = f"SELECT {', '.join(columns)} WHERE false"
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
    return f"{layer}.{table.alias}"


def withdraw(spark: SparkSession, layers, prefix: str = "") -> None:
    """Drop the layers' databases and views; the tables stay as they are."""
    for layer in layers:
        spark.sql(f"DROP DATABASE IF EXISTS {_quoted(database(prefix, layer))} CASCADE")
