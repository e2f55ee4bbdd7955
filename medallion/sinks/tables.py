"""Layer tables on plain Parquet: full refresh, keyed upsert, append.

No table format is assumed.  A table holds numbered versions, each written to
a folder of its own, ``<path>/v=<n>-<id>/``, and the newest with a commit marker
``<path>/_commits/v=<n>`` is read; the marker names the folder and holds the
schema, so reads infer nothing.  A full refresh writes a new version:
interrupted, it leaves no whole marker and the old one stays.  Of two writers
that make the same version, the marker's exclusive creation lets one through;
the other fails, and neither has touched the other's files.

* **Dimension** tables are small; every write makes a new version.
* **Fact** tables are partitioned by a date column.  Upserts and appends
  work inside the current version and rewrite only the partitions of the
  batch.  A dynamic partition overwrite puts its files in the place of the old
  ones when all of its tasks have ended, so the merged rows are written as they
  are worked out.  Rows are rebalanced by date before every write: files follow
  the data, not the number of shuffle partitions.  In a file they are in the
  order of sensor and parameter, so that the statistics of row groups and pages
  let a scan of some sensors skip the others.

Every load has an id, its load time, unique in the table and stamped on its
rows.  ``<path>/_loads/`` logs the loads with the dates they touched, and
``<path>/_consumed/`` the loads of other tables that this table has taken
in.  What is pending is the difference of the two logs, so a load is taken
in whenever it was committed.  A load made by a micro-batch of a stream is
logged with the stream's name and the batch's number, in the same file, so a
micro-batch that is tried again finds its load and logs no other.  A table with a *feed* also keeps what each of
its upserts and appends changed, ``<path>/_changes/load=<micros>/``: the rows
it added and the rows it replaced, as they were.  Tables made of it read that
instead of its partitions.  A load without a feed (a full refresh) says that
anything may have changed.  Dates and load ids stay in Spark: small frames
(a row per load and date) that are broadcast so that they prune partitions.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.functions.exprs import EPOCH_FLOOR, utc_lit
from medallion.operators.dedup import of_repeated, resolve_repeated
from medallion.operators.joins import anti_join, semi_join
from medallion.operators.merge import merge_newest
from medallion.schemas import LOAD_TS
from medallion.session import staging_path
from medallion.sources import fs

_UTC = _dt.timezone.utc
FLOOR = _dt.datetime.fromisoformat(EPOCH_FLOOR).replace(tzinfo=_UTC)
_EPOCH = _dt.datetime(1970, 1, 1, tzinfo=_UTC)


CHANGE = "_change"
TARGET_BYTES = 128 << 20  # of a packed file
FEW = 200_000  # keys that are broadcast, by their count
CLUSTERED = ("sensor_id", "parameter_id")  # the order of rows in a file of a fact table


def _micros(t: _dt.datetime) -> int:
    return (t - _EPOCH) // _dt.timedelta(microseconds=1)


def load_time(micros: int | None) -> _dt.datetime:
    return FLOOR if micros is None else _EPOCH + _dt.timedelta(microseconds=micros)


def prune_to(df: DataFrame, values: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose ``columns`` are in ``values``, a small frame of
    dates (and load ids) that is broadcast; where ``df`` is partitioned by
    one of them, only those partitions are scanned.  Its size is bounded by
    the calendar, not by the rows of ``df``."""
    first = columns[0]
    # a comparison makes the frame selective for dynamic partition pruning
    floor = F.lit("0001-01-01").cast(dict(values.dtypes)[first])
    keys = values.where(F.col(first) >= floor).select(*columns).distinct()
    return df.join(F.broadcast(keys), list(columns), "left_semi").select(*df.columns)


def few(keys: DataFrame) -> DataFrame | None:
    """``keys``, a staged frame of keys, to be broadcast if it is small."""
    return F.broadcast(keys) if keys.count() <= FEW else None


@dataclass
class LayerTable:
    """A table ``<root>/<layer>/<alias>`` with its grain and storage shape."""

    spark: SparkSession
    root: str
    layer: str
    alias: str
    keys: Sequence[str] = field(default_factory=tuple)
    partition_by: str | None = None
    feed: bool = False
    batch: tuple[str, int] | None = None

    @property
    def path(self) -> str:
        return f"{self.root.rstrip('/')}/{self.layer}/{self.alias}"

    @property
    def name(self) -> str:
        return f"{self.layer}.{self.alias}"

    # ------------------------------------------------------------------ read
    def _markers(self) -> list[int]:
        """Version numbers that have a marker, whole or not, newest first."""
        found = [n for n, _ in fs.children(self.spark, f"{self.path}/_commits")]
        return sorted((int(n[2:]) for n in found if n.startswith("v=") and n[2:].isdigit()), reverse=True)

    def _current(self) -> tuple[int, dict] | None:
        """The newest committed version and its marker.  A marker that can't
        be read is of a writer that failed, or is about to end."""
        for v in self._markers():
            try:
                return v, json.loads(fs.read_text(self.spark, f"{self.path}/_commits/v={v}"))
            except ValueError:
                continue
        return None

    def current_version(self) -> int | None:
        """Newest committed version."""
        now = self._current()
        return now[0] if now else None

    def exists(self) -> bool:
        return self.current_version() is not None

    def data(self) -> str:
        """The folder of the current version."""
        return f"{self.path}/{self._current()[1]['data']}"

    def read(self) -> DataFrame | None:
        """Current content, or None when the table was never written."""
        now = self._current()
        if now is None:
            return None
        return self.spark.read.schema(T.StructType.fromJson(now[1]["schema"])).parquet(f"{self.path}/{now[1]['data']}")

    # ------------------------------------------------------------- load logs
    def _log_schema(self) -> str:
        return f"{LOAD_TS} timestamp, {self.partition_by or '_none'} date, stream string, batch long"

    def load_log(self) -> str:
        """The folder of the load log, a file a load (a stream may read it)."""
        return f"{self.path}/_loads"

    def loads(self) -> DataFrame:
        """(load id, date it touched) of every load (dimension tables: no date)."""
        return self._logged().drop("stream", "batch")

    def _logged(self) -> DataFrame:
        if not fs.has_file(self.spark, self.load_log()):
            return self.spark.createDataFrame([], self._log_schema())
        return self.spark.read.schema(self._log_schema()).parquet(self.load_log())

    def has_batch(self) -> bool:
        """Was this micro-batch of a stream logged with a load already?"""
        if self.batch is None:
            return False
        stream, batch = self.batch
        return not self._logged().where((F.col("stream") == stream) & (F.col("batch") == batch)).isEmpty()

    def newest_load(self) -> _dt.datetime:
        """The newest load time of the table (1900-01-01 when empty), in UTC."""
        return load_time(self.loads().agg(F.unix_micros(F.max(LOAD_TS))).first()[0])

    def next_load(self, at: _dt.datetime) -> _dt.datetime:
        """The id of a load at this time: the time itself, or the next free
        microsecond after the newest load."""
        at = at if at.tzinfo else at.replace(tzinfo=_UTC)
        return max(at, self.newest_load() + _dt.timedelta(microseconds=1))

    def _log(self, df: DataFrame | None, load_ts: _dt.datetime | None) -> None:
        """``df``: rows whose dates the load touched."""
        if load_ts is None:
            return
        if self.partition_by:
            touched = df.select(F.col(self.partition_by).cast("date").alias(self.partition_by)).distinct()
        else:
            touched = self.spark.range(1).select(F.lit(None).cast("date").alias("_none"))
        stream, batch = self.batch or (None, None)
        of_batch = F.lit(stream).cast("string").alias("stream"), F.lit(batch).cast("long").alias("batch")
        touched.select(utc_lit(load_ts).alias(LOAD_TS), *touched.columns, *of_batch).coalesce(1) \
            .write.mode("append").parquet(self.load_log())

    def pending(self, source: "LayerTable") -> DataFrame:
        """Loads of ``source`` that this table hasn't consumed, as they are now:
        (load id, date).  The files of both logs are listed here, so later
        commits don't change the frame."""
        loads = source.loads()
        path = f"{self.path}/_consumed"
        if not fs.has_file(self.spark, path):
            return loads
        taken = self.spark.read.schema(f"source string, {LOAD_TS} timestamp").parquet(path)
        return loads.join(taken.where(F.col("source") == source.name).select(LOAD_TS), LOAD_TS, "left_anti")

    def consume(self, source: "LayerTable", pending: DataFrame) -> None:
        """Record that the pending loads were taken in (after the write)."""
        pending.select(F.lit(source.name).alias("source"), LOAD_TS).distinct().coalesce(1) \
            .write.mode("append").parquet(f"{self.path}/_consumed")

    def _feed(self, added: DataFrame, replaced: DataFrame | None, load_ts: _dt.datetime | None) -> None:
        """Written before the rows are: a load that then fails is never logged,
        so its feed is never read.  ``added`` and ``replaced`` are staged: their
        scans pack small files, so the feed's files follow its rows."""
        if self.feed and load_ts is not None:
            rows = added.withColumn(CHANGE, F.lit("added"))
            if replaced is not None:
                rows = rows.unionByName(replaced.withColumn(CHANGE, F.lit("replaced")))
            rows.write.mode("overwrite").parquet(f"{self.path}/_changes/load={_micros(load_ts)}")

    def changes(self, loads: DataFrame) -> DataFrame | None:
        """The table's columns, ``_change`` (added or replaced) and ``_load``
        (the load that made it) of the given loads; None if one of them kept no
        feed."""
        ids = [r[0] for r in loads.select(F.unix_micros(LOAD_TS).alias("m")).distinct().collect()]  # a number a load
        kept = set(fs.child_dirs(self.spark, f"{self.path}/_changes"))
        if not ids or any(f"load={m}" not in kept for m in ids):
            return None
        schema = self.read().schema.add(CHANGE, T.StringType())
        df = self.spark.read.schema(schema.add("load", T.LongType())).option("basePath", f"{self.path}/_changes")
        df = df.parquet(*[f"{self.path}/_changes/load={m}" for m in sorted(ids)])
        return df.withColumn("_load", F.timestamp_micros("load")).drop("load")

    def rows_of(self, loads: DataFrame) -> DataFrame:
        """The table's rows stamped with one of the loads (only their dates
        are scanned)."""
        df = self.read()
        if self.partition_by:
            return prune_to(df, loads, [self.partition_by, LOAD_TS])
        return prune_to(df, loads, [LOAD_TS])

    def stages(self) -> "_Stages":
        """``with table.stages() as stage: stage(df, tag)``: frames written under
        the shared checkpoint folder that go at the end."""
        return _Stages(self)

    # ----------------------------------------------------------------- write
    def _put(self, df: DataFrame, path: str, mode: str, **options: str) -> None:
        if self.partition_by:
            ordered = [c for c in CLUSTERED if c in df.columns]
            rows = df.hint("rebalance", self.partition_by).sortWithinPartitions(self.partition_by, *ordered)
            writer = rows.write.partitionBy(self.partition_by)
        else:
            writer = df.write
        writer.mode(mode).options(**options).parquet(path)

    def _commit(self, df: DataFrame) -> None:
        """Write ``df`` as a new version; the version before it is kept for its
        readers, older ones go."""
        now, version = self.current_version() or 0, max(self._markers(), default=0) + 1
        folder = f"v={version}-{uuid.uuid4().hex}"
        self._put(df, f"{self.path}/{folder}", "errorifexists")
        fs.create_text(self.spark, f"{self.path}/_commits/v={version}", json.dumps({"data": folder, "schema": df.schema.jsonValue()}))
        for d in fs.child_dirs(self.spark, self.path):
            if d.startswith("v=") and int(d[2:].split("-")[0]) < now:
                fs.delete(self.spark, f"{self.path}/_commits/{d.split('-')[0]}")
                fs.delete(self.spark, f"{self.path}/{d}")

    def overwrite(self, df: DataFrame, *, load_ts: _dt.datetime | None = None) -> None:
        """Full refresh: the table becomes exactly ``df``."""
        self._commit(df)
        self._log(self.read(), load_ts)

    def append(self, batch: DataFrame, *, load_ts: _dt.datetime | None = None) -> bool:
        """Add the batch rows (no key).  Returns whether there were any."""
        with _Stages(self) as stage:
            staged = stage(batch, "batch")
            if staged.isEmpty():
                return False
            current = self.read()
            self._feed(staged, None, load_ts)
            if current is None:
                self._commit(staged)
            elif self.partition_by:
                self._put(staged.select(*current.columns), self.data(), "append")
            else:
                self._commit(current.unionByName(staged.select(*current.columns)))
            self._log(staged, load_ts)
            return True

    def upsert(self, batch: DataFrame, *, load_ts: _dt.datetime | None = None, newest: str | None = None,
               repeated: DataFrame | None = None) -> bool:
        """Replace rows whose key is in the batch, insert the rest.

        With ``newest``, a version column, the newest version of a key is
        kept, be it the table's or the batch's.  With ``repeated``, the keys
        with several rows in table and batch together, only rows of those are
        shuffled by key.  The batch is staged once
        (lineage cut, evaluated once) and an empty one stops there.  Returns
        whether anything was written.
        """
        if not self.keys:
            raise ValueError(f"{self.name} has no key; use append")
        with _Stages(self) as stage:
            staged = stage(batch, "batch")
            if staged.isEmpty():
                return False
            current = self.read()
            if current is None:
                self._feed(staged, None, load_ts)
                self._commit(staged)
            else:
                old = prune_to(current, staged, [self.partition_by]) if self.partition_by else current
                rows, keys = staged.select(*current.columns), list(self.keys)
                may_go, gone = old, rows  # rows that may be replaced; rows with their keys
                if repeated is not None:
                    may_go, gone = of_repeated(old, keys, repeated), of_repeated(rows, keys, repeated)
                if self.feed and load_ts is not None:
                    gone = stage(semi_join(may_go, gone, keys, dedup=False), "replaced")
                    self._feed(rows, gone, load_ts)
                if newest:
                    merged = merge_newest(old, rows, keys, newest, LOAD_TS, repeated)
                else:
                    kept = resolve_repeated(old, keys, repeated, lambda d: anti_join(d, gone, keys, dedup=False))
                    merged = kept.unionByName(rows)
                if self.partition_by:
                    self._put(merged, self.data(), "overwrite", partitionOverwriteMode="dynamic")
                else:
                    self._commit(merged)
            self._log(staged, load_ts)
            return True

    def compact(self, target_bytes: int = TARGET_BYTES) -> tuple[int, int]:
        """Pack small files: partitions (or a whole dimension table) whose bytes
        fit in fewer files of ``target_bytes`` are written anew under the same
        rows, and the logs, a file a load, become one file each.  The rows keep
        their load ids and no load is logged, so nothing becomes pending.
        Returns the numbers of data files before and after.

        A log is packed into a file that is added before the packed ones go; one
        that stops in between leaves entries twice, which count once.  Nothing
        else may write the table at the time.
        """
        folder = self.data()
        before = fs.data_files(self.spark, folder)
        sizes: dict[str, list[int]] = {}
        for name, size in before.items():
            sizes.setdefault(name.rpartition("/")[0], []).append(size)
        small = [part for part, s in sizes.items() if len(s) > max(1, -(-sum(s) // target_bytes))]
        for log in (self.load_log(), f"{self.path}/_consumed"):
            self._pack_log(log)
        if not small:
            return len(before), len(before)
        if self.partition_by:
            dates = [part.rpartition("=")[2] for part in small]
            df = self.read().where(F.col(self.partition_by).cast("string").isin(dates))
            with _Stages(self) as stage:
                self._put(stage(df, "small"), folder, "overwrite", partitionOverwriteMode="dynamic")
        else:
            self._commit(self.read().hint("rebalance"))
        return len(before), len(fs.data_files(self.spark, self.data()))

    def _pack_log(self, path: str) -> None:
        held = list(fs.data_files(self.spark, path))
        if len(held) > 1:
            schema = self._log_schema() if path == self.load_log() else f"source string, {LOAD_TS} timestamp"
            entries = self.spark.read.schema(schema).parquet(*[f"{path}/{n}" for n in held])
            entries.distinct().coalesce(1).write.mode("append").parquet(path)
            for n in held:
                fs.delete(self.spark, f"{path}/{n}")

    def replace_partitions(self, df: DataFrame, *, load_ts: _dt.datetime | None = None, touched: DataFrame | None = None) -> None:
        """Overwrite exactly the partitions present in ``df`` (recompute mode).
        ``touched``: rows with exactly the dates of ``df`` that don't come from
        this table; without it ``df`` is staged, so that the log of the load
        doesn't work it out again."""
        if not self.partition_by:
            raise ValueError(f"{self.name} is not partitioned")
        with _Stages(self) as stage:
            staged = df if load_ts is None or touched is not None else stage(df, "recomputed")
            if self.exists():
                self._put(staged.select(*self.read().columns), self.data(), "overwrite", partitionOverwriteMode="dynamic")
            else:
                self._commit(staged)
            self._log(staged if touched is None else touched, load_ts)


class _Stages:
    """Frames staged under the shared checkpoint folder while a write lasts."""

    def __init__(self, table: LayerTable):
        self.table, self.paths = table, []

    def __enter__(self):
        return self.stage

    def stage(self, df: DataFrame, tag: str) -> DataFrame:
        path = staging_path(self.table.spark, f"{self.table.layer}-{self.table.alias}-{tag}")
        self.paths.append(path)
        df.write.mode("overwrite").parquet(path)
        return self.table.spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *_) -> None:
        for path in self.paths:  # the table holds the rows now (or nothing changed)
            fs.delete(self.table.spark, path)
