"""Target schemas of the landed entities.

Landing files hold one flattened API record per row, with literal dots in
the column names (``"period.datetime_from.utc"``), plus the lineage columns
``extraction_timestamp`` (and the parent id for sensors/measurements).
Every scan aligns its files to these schemas, so type drift between files
ends at the door.  Time fields stay ISO-8601 text as landed; the gold layer
types them (wall clock vs instant, see :mod:`medallion.functions.exprs`).
"""

from __future__ import annotations

from pyspark.sql import types as T

L, S, D, B = T.LongType(), T.StringType(), T.DoubleType(), T.BooleanType()

_NAMED = T.StructType([T.StructField("id", L), T.StructField("name", S)])
_PARAM_REF = T.StructType([T.StructField("id", L), T.StructField("name", S),
                           T.StructField("units", S), T.StructField("display_name", S)])

# Fixed layout: leaf columns of each landed entity, in landing order.
# Element fields of the list columns are not part of any model's logic;
# they are carried through as declared here.
ENTITY_FIELDS: dict[str, list[tuple[str, T.DataType]]] = {
    "country": [
        ("id", L), ("code", S), ("name", S), ("datetime_first", S), ("datetime_last", S),
        ("parameters", T.ArrayType(_PARAM_REF)),
    ],
    "parameter": [
        ("id", L), ("name", S), ("units", S), ("display_name", S), ("description", S),
    ],
    "location": [
        ("id", L), ("name", S), ("locality", S), ("timezone", S), ("is_mobile", B), ("is_monitor", B),
        ("instruments", T.ArrayType(_NAMED)),
        ("sensors", T.ArrayType(T.StructType([T.StructField("id", L), T.StructField("name", S),
                                              T.StructField("parameter", _PARAM_REF)]))),
        ("bounds", T.ArrayType(D)), ("distance", D),
        ("country.id", L), ("country.code", S), ("country.name", S),
        ("owner.id", L), ("owner.name", S), ("provider.id", L), ("provider.name", S),
        ("coordinates.latitude", D), ("coordinates.longitude", D),
        ("datetime_first.utc", S), ("datetime_first.local", S),
        ("datetime_last.utc", S), ("datetime_last.local", S),
    ],
    "sensor": [
        ("id", L), ("name", S),
        ("parameter.id", L), ("parameter.name", S), ("parameter.units", S), ("parameter.display_name", S),
        ("datetime_first.utc", S), ("datetime_first.local", S),
        ("datetime_last.utc", S), ("datetime_last.local", S),
        ("coverage.expected_count", L), ("coverage.expected_interval", S),
        ("coverage.observed_count", L), ("coverage.observed_interval", S),
        ("coverage.percent_complete", D), ("coverage.percent_coverage", D),
        ("coverage.datetime_from.utc", S), ("coverage.datetime_from.local", S),
        ("coverage.datetime_to.utc", S), ("coverage.datetime_to.local", S),
        ("latest.datetime.utc", S), ("latest.datetime.local", S), ("latest.value", D),
        ("latest.coordinates.latitude", D), ("latest.coordinates.longitude", D),
        ("summary.min", D), ("summary.q02", D), ("summary.q25", D), ("summary.median", D),
        ("summary.q75", D), ("summary.q98", D), ("summary.max", D), ("summary.avg", D), ("summary.sd", D),
        ("location_id", L),
    ],
    "measurement": [
        ("value", D),
        ("period.label", S), ("period.interval", S),
        ("period.datetime_from.utc", S), ("period.datetime_from.local", S),
        ("period.datetime_to.utc", S), ("period.datetime_to.local", S),
        ("parameter.id", L), ("parameter.name", S), ("parameter.units", S), ("parameter.display_name", S),
        ("coverage.expected_count", L), ("coverage.expected_interval", S),
        ("coverage.observed_count", L), ("coverage.observed_interval", S),
        ("coverage.percent_complete", D), ("coverage.percent_coverage", D),
        ("coverage.datetime_from.utc", S), ("coverage.datetime_from.local", S),
        ("coverage.datetime_to.utc", S), ("coverage.datetime_to.local", S),
        ("sensor_id", L),
    ],
}

EXTRACTION_TS = "extraction_timestamp"

# Lineage column naming the parent of a child entity's request (stamped at
# landing, not part of the API record).
PARENT_COLUMN: dict[str, str] = {"sensor": "location_id", "measurement": "sensor_id"}
LOAD_TS = "load_timestamp"

# Natural keys of the bronze tables (snake names).
ENTITY_KEYS: dict[str, list[str]] = {
    "country": ["id"],
    "parameter": ["id"],
    "location": ["id"],
    "sensor": ["id"],
    "measurement": ["sensor_id", "parameter_id", "period_datetime_from_utc", "period_datetime_to_utc"],
}


def landing_schema(entity: str) -> T.StructType:
    """Flat landed schema of ``entity`` (dotted names + extraction timestamp)."""
    fields = [T.StructField(n, t, True) for n, t in ENTITY_FIELDS[entity]]
    fields.append(T.StructField(EXTRACTION_TS, T.TimestampType(), True))
    return T.StructType(fields)


def landed_columns(entity: str) -> list[str]:
    return [n for n, _ in ENTITY_FIELDS[entity]]


def nested_schema(entity: str) -> T.StructType:
    """The API record shape of ``entity`` (dotted names folded into structs),
    as found in raw JSON pages before flattening."""
    root: dict = {}
    for name, dtype in ENTITY_FIELDS[entity]:
        if name == PARENT_COLUMN.get(entity):
            continue
        node = root
        parts = name.split(".")
        for p in parts[:-1]:
            node = node.setdefault(p, {})
        node[parts[-1]] = dtype

    def build(node: dict) -> T.StructType:
        return T.StructType([T.StructField(k, build(v) if isinstance(v, dict) else v, True)
                             for k, v in node.items()])

    return build(root)
