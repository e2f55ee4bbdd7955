"""Raw API response pages -> landed rows.

A page is one JSON document ``{"results": [record, ...], ...}``; child
entities' pages also carry the id of the parent they were requested for
(``"parent_id"`` by default).  Reading is one distributed JSON scan with the
declared record schema (no inference pass), an ``explode`` of ``results``
and a flatten of nested records to dotted column names, the layout the
landing zone and the bronze models read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.functions.exprs import col_of, utc_lit
from medallion.schemas import EXTRACTION_TS, PARENT_COLUMN, landing_schema, nested_schema
from medallion.sources.drift import align_to_schema
from medallion.sources.flatten import flatten_structs


def page_schema(entity: str, parent_field: str = "parent_id") -> T.StructType:
    fields = [T.StructField("results", T.ArrayType(nested_schema(entity)), True)]
    if entity in PARENT_COLUMN:
        fields.append(T.StructField(parent_field, T.LongType(), True))
    return T.StructType(fields)


CORRUPT = "_corrupt_page"


def parsed_pages(reader, path: str, entity: str, *, parent_field: str = "parent_id", multi_line: bool = True) -> DataFrame:
    """The pages under ``path``, by ``spark.read`` or ``spark.readStream``:
    results, parent id, the whole page if it can't be read as JSON of the
    declared shape, and its file's path and time."""
    schema = page_schema(entity, parent_field).add(CORRUPT, T.StringType())
    pages = (reader.schema(schema)
             .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
             .option("multiLine", str(multi_line).lower())
             .option("recursiveFileLookup", "true")
             .json(path))
    return pages.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_modification_time").alias("_file_ts"))


def bad_of(pages: DataFrame) -> DataFrame:
    """(path, page) of the parsed pages that can't be read."""
    # Spark wants another column to be read beside the corrupt record
    other = F.coalesce(F.size("results"), F.lit(0)) >= -1
    return pages.where(F.col(CORRUPT).isNotNull() & other).select(F.col("_path").alias("path"), F.col(CORRUPT).alias("page"))


def bad_pages(spark: SparkSession, path: str, entity: str, *, parent_field: str = "parent_id",
              multi_line: bool = True) -> DataFrame:
    """(path, page): pages that can't be read as JSON of the declared shape."""
    return bad_of(parsed_pages(spark.read, path, entity, parent_field=parent_field, multi_line=multi_line))


def read_api_pages(spark: SparkSession, path: str, entity: str, *, parent_field: str = "parent_id",
                   multi_line: bool = True, extracted_at=None) -> DataFrame:
    """Landed rows of ``entity`` from the JSON pages under ``path``.

    Each page's records become rows; nested objects become dotted columns
    (lists are carried); the parent id becomes the entity's lineage column
    (``location_id`` / ``sensor_id``); ``extraction_timestamp`` is the
    given time (UTC if it has no zone) or the file's modification time.
    Pages that aren't JSON have no rows here; :func:`bad_pages` has them.
    """
    return landed_rows(parsed_pages(spark.read, path, entity, parent_field=parent_field, multi_line=multi_line), entity, parent_field=parent_field, extracted_at=extracted_at)


def landed_rows(pages: DataFrame, entity: str, *, parent_field: str = "parent_id", extracted_at=None) -> DataFrame:
    """Landed rows of parsed pages."""
    pages = pages.where(F.col(CORRUPT).isNull())
    keep = ["_file_ts"] + ([parent_field] if entity in PARENT_COLUMN else [])
    records = pages.select(*[col_of(k) for k in keep], F.explode("results").alias("__r"))
    flat = flatten_structs(records.select(*[col_of(k) for k in keep], "__r.*"))
    stamped = flat.withColumn(EXTRACTION_TS, utc_lit(extracted_at) if extracted_at is not None else F.col("_file_ts"))
    if entity in PARENT_COLUMN:
        stamped = stamped.withColumnRenamed(parent_field, PARENT_COLUMN[entity])
    return align_to_schema(stamped, landing_schema(entity))
