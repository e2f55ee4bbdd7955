"""Landing zone: append-only raw files per entity.

Layout::

    <root>/<entity>/new/...              landed: batch folders or plain files
    <root>/<entity>/loading/<load>/...   claimed by a load
    <root>/<entity>/<load>/...           archived: loaded

A load first *claims* what is in ``new/`` by renaming it to a folder of its
own, reads exactly the claimed files, and the archive step renames that
folder.  What lands meanwhile stays in ``new/`` for the next load; what a
failed load claimed stays in ``loading/`` and is read again by the next.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.schemas import ENTITY_FIELDS, EXTRACTION_TS, landing_schema
from medallion.sources import fs

NEW_DIR = "new"
LOADING_DIR = "loading"


def entity_dir(root: str, entity: str) -> str:
    return f"{root.rstrip('/')}/{entity}"


def new_dir(root: str, entity: str) -> str:
    return f"{entity_dir(root, entity)}/{NEW_DIR}"


def loading_dir(root: str, entity: str) -> str:
    return f"{entity_dir(root, entity)}/{LOADING_DIR}"


def list_files(spark: SparkSession, path: str, glob: str = "*.parquet", recursive: bool = True) -> DataFrame:
    """``(path, modificationTime, length)`` of matching files, as a DataFrame.

    Uses the ``binaryFile`` source without selecting ``content``, so only
    the file listing happens (no file is opened).  A missing folder gives
    an empty frame.
    """
    schema = "path string, modificationTime timestamp, length long"
    if not fs.exists(spark, path):
        return spark.createDataFrame([], schema)
    return (spark.read.format("binaryFile")
            .option("pathGlobFilter", glob)
            .option("recursiveFileLookup", str(recursive).lower())
            .load(path)
            .select("path", "modificationTime", "length"))


def files_exist(spark: SparkSession, path: str, glob: str = "*.parquet") -> bool:
    """Are there landed files under ``path``?  A metadata walk that stops at
    the first match (no Spark job)."""
    return fs.has_file(spark, path, glob.lstrip("*"))


def scan_landing(spark: SparkSession, root: str, entity: str, *, scope: str = "all",
                 schema: T.StructType | None = None) -> DataFrame:
    """Read landed files of ``entity`` with the declared schema.

    scope="all": archived + pending files (full refresh); scope="new":
    pending files only (incremental).  Columns missing from a file read as
    null; no inference pass is made.  For files whose column *types*
    drift, use :func:`medallion.sources.drift.scan_drifting`.
    """
    schema = schema or landing_schema(entity)
    path = entity_dir(root, entity) if scope == "all" else new_dir(root, entity)
    if not files_exist(spark, path):
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema)
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet")
            .parquet(path))


def stamp_lineage(df: DataFrame, *, parent_column: str | None = None, parent_value=None,
                  at=None) -> DataFrame:
    """Add ``extraction_timestamp`` (and a parent id column) to landed rows."""
    out = df
    if parent_column is not None and parent_value is not None:
        out = out.withColumn(parent_column, F.lit(parent_value).cast("bigint"))
    ts = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    return out.withColumn(EXTRACTION_TS, ts)


def batch_name(prefix: str = "", suffix: str = "", now: _dt.datetime | None = None) -> str:
    """``<prefix>_<yyyyMMdd_HHmmssffffff>_<suffix>`` (underscores only where needed)."""
    now = now or _dt.datetime.now(_dt.timezone.utc)
    stamp = now.strftime("%Y%m%d_%H%M%S%f")  # fixed value: the file-name format of landed batches
    return "_".join(p for p in (prefix, stamp, suffix) if p)


def is_landed(spark: SparkSession, root: str, entity: str, name: str) -> bool:
    """Is a batch of this name landed, claimed or archived?"""
    base = entity_dir(root, entity)
    folders = [new_dir(root, entity), *(f"{loading_dir(root, entity)}/{n}" for n in fs.child_dirs(spark, loading_dir(root, entity))),
               *(f"{base}/{n}" for n in fs.child_dirs(spark, base))]
    return any(fs.exists(spark, f"{f}/{name}") for f in folders)


def land(df: DataFrame, root: str, entity: str, *, prefix: str = "", suffix: str = "",
         skip_empty: bool = True, align: bool = True, name: str | None = None) -> str | None:
    """Append one batch of records under ``<root>/<entity>/new/``.

    Rows of a known entity are first aligned to its landing schema (types
    cast, missing columns null-filled), so files landed here never drift;
    only pages written by other tools need the drift scan.  The batch is
    written under a hidden name and renamed when complete, so a load never
    claims half of it.  An empty batch leaves nothing and returns None.
    ``name``: the batch's own name; what an earlier try left of it goes.
    """
    if align and entity in ENTITY_FIELDS:
        from medallion.sources.drift import align_to_schema

        df = align_to_schema(df, landing_schema(entity))
    mode = "overwrite" if name else "errorifexists"
    name = name or batch_name(prefix or entity, suffix)
    hidden, target = f"{new_dir(root, entity)}/_{name}", f"{new_dir(root, entity)}/{name}"
    df.write.mode(mode).parquet(hidden)
    if skip_empty and df.sparkSession.read.schema(df.schema).parquet(hidden).isEmpty():
        fs.delete(df.sparkSession, hidden)
        return None
    fs.rename(df.sparkSession, hidden, target)
    return target


def claim_new(spark: SparkSession, root: str, entity: str) -> str | None:
    """Move what is in ``new/`` to a load folder of its own; returns the folder
    of all claimed files (older claims included), or None if there are none.

    One rename per batch folder or plain file: no file is read or copied.
    """
    pending = fs.children(spark, new_dir(root, entity))
    if pending:
        to = f"{loading_dir(root, entity)}/{batch_name('load', uuid.uuid4().hex[:8])}"
        for name, _ in pending:
            fs.rename(spark, f"{new_dir(root, entity)}/{name}", f"{to}/{name}")
    return loading_dir(root, entity) if files_exist(spark, loading_dir(root, entity)) else None


def claimed_and_archived(spark: SparkSession, root: str, entity: str) -> list[str]:
    """Paths of everything claimed or archived: all but ``new/``."""
    base = entity_dir(root, entity)
    return [f"{base}/{name}" for name, _ in fs.children(spark, base) if name != NEW_DIR]


def archive_loaded(spark: SparkSession, root: str, entity: str) -> int:
    """Move the claimed load folders to the archive; returns how many."""
    names = fs.child_dirs(spark, loading_dir(root, entity))
    for name in names:
        fs.rename(spark, f"{loading_dir(root, entity)}/{name}", f"{entity_dir(root, entity)}/{name}")
    return len(names)
