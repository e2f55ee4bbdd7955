"""The declared column tests of every layer and the cross-table duplicate report."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from medallion.operators.quality import KeySpec, duplicate_report, key_failures, key_suspects, not_null, relationships, unique
from medallion.plans.models import MEASUREMENT_KEY

# The declared tests.  (table, column) pairs with unique +
# not_null tests, and (child, column, parent, field) relationship tests.
KEYED = {
    "bronze": ["country", "location", "parameter", "sensor"],
    "silver": ["country", "location", "parameter", "sensor"],
    "gold": ["country", "location", "parameter", "sensor", "locality"],
}
RELATIONSHIPS = {
    "bronze": [("location", "country_id", "country", "id"),
               ("measurement", "sensor_id", "sensor", "id"),
               ("measurement", "parameter_id", "parameter", "id"),
               ("sensor", "location_id", "location", "id"),
               ("sensor", "parameter_id", "parameter", "id")],
    "silver": [("location", "country_id", "country", "id"),
               ("measurement", "sensor_id", "sensor", "id"),
               ("measurement", "parameter_id", "parameter", "id"),
               ("sensor", "location_id", "location", "id"),
               ("sensor", "parameter_id", "parameter", "id")],
    "gold": [("location", "locality_id", "locality", "id"),
             ("measurement", "sensor_id", "sensor", "id"),
             ("measurement", "parameter_id", "parameter", "id"),
             ("sensor", "location_id", "location", "id"),
             ("locality", "country_id", "country", "id"),
             ("measurement_hourly_aggregate", "sensor_id", "sensor", "id"),
             ("measurement_hourly_aggregate", "parameter_id", "parameter", "id"),
             ("measurement_daily_aggregate", "sensor_id", "sensor", "id"),
             ("measurement_daily_aggregate", "parameter_id", "parameter", "id")],
}
# Grain of the tables in the duplicate report (the two aggregates are not in it).
DUPLICATE_GRAIN = {
    "bronze": ["country", "parameter", "location", "sensor", "measurement"],
    "silver": ["country", "parameter", "location", "sensor", "measurement"],
    "gold": ["country", "parameter", "location", "sensor", "locality", "measurement"],
}


def column_tests(read: Callable[[str, str], DataFrame | None]) -> dict[str, DataFrame]:
    """Failing-row frames of all declared column tests, by test name.

    ``read(layer, alias)`` returns the table or None if it does not exist.
    """
    out: dict[str, DataFrame] = {}
    for layer, tables in KEYED.items():
        for t in tables:
            df = read(layer, t)
            if df is None:
                continue
            out[f"unique_{layer}_{t}_id"] = unique(df, "id")
            out[f"not_null_{layer}_{t}_id"] = not_null(df, "id")
    for layer, rels in RELATIONSHIPS.items():
        for child, col, parent, fld in rels:
            c, p = read(layer, child), read(layer, parent)
            if c is None or p is None:
                continue
            out[f"relationships_{layer}_{child}_{col}__{parent}_{fld}"] = relationships(c, col, p, fld)
    return out


def _specs(read: Callable[[str, str], DataFrame | None]) -> list[KeySpec]:
    out = []
    for layer, tables in DUPLICATE_GRAIN.items():
        for t in tables:
            df = read(layer, t)
            if df is not None:
                out.append(KeySpec(f"{layer}_{t}", df, tuple(MEASUREMENT_KEY) if t == "measurement" else ("id",)))
    return out


def suspects(read: Callable[[str, str], DataFrame | None]) -> DataFrame | None:
    """The keys that the key tests and the duplicate report are about: every
    table is scanned once."""
    specs = _specs(read)
    return key_suspects(specs) if specs else None


def key_tests(read: Callable[[str, str], DataFrame | None], found: DataFrame) -> dict[str, int]:
    """Failures of the declared unique and not_null tests, by test name, from
    the suspects (a row per table reaches the driver)."""
    by = {r.table_name: r for r in key_failures(found).collect()}
    out = {}
    for layer, tables in KEYED.items():
        for t in tables:
            if read(layer, t) is not None:
                for test in ("unique", "not_null"):
                    out[f"{test}_{layer}_{t}_id"] = by[f"{layer}_{t}"][test] if f"{layer}_{t}" in by else 0
    return out


def relationship_tests(read: Callable[[str, str], DataFrame | None]) -> dict[str, DataFrame]:
    return {name: df for name, df in column_tests(read).items() if name.startswith("relationships_")}


def duplicates(read: Callable[[str, str], DataFrame | None]) -> DataFrame | None:
    """The 16-branch duplicate report over the layer tables that exist."""
    specs = _specs(read)
    return duplicate_report(specs) if specs else None
