"""Run models, layers and the whole daily flow: land -> bronze -> silver ->
gold -> archive -> tests.

The driver only builds plans and issues writes; rows, dates and file lists
never pass through it.  What a table takes in is what its sources loaded and
it hasn't consumed yet (see :mod:`medallion.sinks.tables`), so nothing
depends on the order of load times, and a run that failed is made up by the
next.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.functions.exprs import utc_lit
from medallion.operators.aggregates import finished, locality_groups, merged_partials, of_groups, partials, reading_states, state_cell
from medallion.operators.dedup import repeated_keys
from medallion.operators.joins import anti_join, semi_join
from medallion.operators.merge import rebuild_touched
from medallion.operators.quality import duplicates_of, run_checks
from medallion.operators.selection import write_mark
from medallion.plans import checks
from medallion.plans.models import (
    DEFAULT_COUNTRY_IDS,
    MEASUREMENT_DATE,
    MODELS,
    MODELS_BY_NAME,
    Model,
    bronze_rename,
    build_bronze,
    build_daily,
    build_gold_country,
    build_gold_locality,
    build_gold_location,
    build_gold_measurement,
    build_gold_parameter,
    build_gold_sensor,
    build_hourly,
    build_silver,
    with_measurement_date,
)
from medallion.schemas import EXTRACTION_TS, LOAD_TS, landing_schema
from medallion.session import staging_path
from medallion.sinks.catalog import publish
from medallion.sinks.tables import TARGET_BYTES, LayerTable, few, load_time, prune_to
from medallion.sources import fs
from medallion.sources.api_pages import bad_of, landed_rows, parsed_pages
from medallion.sources.drift import scan_drifting
from medallion.sources.landing import archive_loaded, batch_name, claim_new, claimed_and_archived, is_landed, land


@dataclass
class PipelineConfig:
    """Where things live and which semantics to apply.

    The ``*_mode`` switches choose between the corrected default and the
    reference-exact behaviour:

    * ``bronze_watermark``: also drop landed rows extracted before the
      bronze table's newest load (reference: yes; default: no, pending
      files are tracked by the landing folders).
    * ``measurement_mode``: "upsert" (revised values replace) or "append".
    * ``aggregate_mode``: "merge" the loads' partial states and recompute only
      groups with a replaced reading (default), "recompute" touched dates, or
      "append" per batch.
    * ``locality_mode``: "groups" recomputes the localities that a load
      touched (default), "rebuild" the location/locality tables whole, or
      "incremental" (batch-only, as the reference).

    ``side_by_side``: models that run at the same time.  ``catalog``: when set
    ("" included), a model's table is published as a view, in a database named
    by this prefix and its layer, whenever the model ran.

    ``pages_root``: raw JSON pages, ``<pages_root>/<entity>/*.json``, that a
    run lands first; the extraction mark advances when the run succeeds.
    """

    landing_root: str
    warehouse_root: str
    country_ids: tuple[int, ...] = DEFAULT_COUNTRY_IDS
    bronze_watermark: bool = False
    measurement_mode: str = "upsert"
    aggregate_mode: str = "merge"
    locality_mode: str = "groups"
    entities: tuple[str, ...] = ("country", "parameter", "location", "sensor", "measurement")
    side_by_side: int = 4
    catalog: str | None = None
    pages_root: str | None = None
    extra: dict = field(default_factory=dict)

    @property
    def dq(self) -> str:
        return f"{self.warehouse_root.rstrip('/')}/dq"

    @property
    def mark(self) -> str:
        return f"{self.warehouse_root.rstrip('/')}/control/extraction_mark"


def undated(raw: DataFrame, entity: str) -> DataFrame:
    """Measurements whose period start can't be read as a time: they have no
    partition and go to a table of their own."""
    df = with_measurement_date(bronze_rename(raw, entity))
    return df.where(F.col(MEASUREMENT_DATE).isNull()).drop(MEASUREMENT_DATE)


# Tables that keep what their loads changed, for the tables made of them.
FEEDS = ("silver_measurement", "silver_location", "silver_country")


class Runner:
    """``batch``: the stream and micro-batch that this runner's loads are made
    by; ``loads``: the loads of a source, by its name, that it takes in (the
    others wait for their own micro-batch)."""

    def __init__(self, spark: SparkSession, cfg: PipelineConfig, load_ts: _dt.datetime | None = None,
                 batch: tuple[str, int] | None = None, loads: dict[str, DataFrame] | None = None):
        self.spark = spark
        self.cfg = cfg
        self._load_ts = load_ts
        self.batch = batch
        self.loads = loads or {}

    @property
    def load_ts(self) -> _dt.datetime:
        """The given load time (in UTC if it has no zone), else now."""
        return self._load_ts or _dt.datetime.now(_dt.timezone.utc)

    # ---------------------------------------------------------------- tables
    def table(self, model: Model | str) -> LayerTable:
        m = MODELS_BY_NAME[model] if isinstance(model, str) else model
        return LayerTable(self.spark, self.cfg.warehouse_root, m.layer, m.alias, m.keys, m.partition_by, m.name in FEEDS, self.batch)

    def read(self, layer: str, alias: str) -> DataFrame | None:
        for m in MODELS:
            if m.layer == layer and m.alias == alias:
                return self.table(m).read()
        return None

    def _source(self, name: str) -> tuple[LayerTable, DataFrame]:
        t = self.table(name)
        df = t.read()
        if df is None:
            raise RuntimeError(f"{name} has not been built yet")
        return t, df

    # ---------------------------------------------------------------- models
    def run_model(self, name: str, *, full_refresh: bool = False) -> str:
        """Load one model; returns what happened (full / upsert / append / skip ...)."""
        outcome = self._run_model(name, full_refresh)
        if self.cfg.catalog is not None:
            self.publish([name])
        return outcome

    def _run_model(self, name: str, full_refresh: bool) -> str:
        m = MODELS_BY_NAME[name]
        t = self.table(m)
        full = full_refresh or not t.exists()
        if t.has_batch():  # tried again after its load was logged
            for s in map(self.table, m.inputs):
                t.consume(s, self._pending(t, s, False))
            return "done"
        if m.layer == "bronze":
            return self._run_bronze(m, t, full)
        if name in ("gold_location", "gold_locality") and self.cfg.locality_mode == "groups":
            return self._run_groups(m, t, full)
        if name in ("gold_parameter", "gold_locality") or (name == "gold_location" and self.cfg.locality_mode == "rebuild"):
            return self._rebuild(m, t, full)
        if m.partition_by == "date" and self.cfg.aggregate_mode == "merge":
            return self._run_aggregate(m, t, full)
        return self._run_from(m, t, full)

    def _pending(self, t: LayerTable, source: LayerTable, full: bool) -> DataFrame:
        pending = t.pending(source)
        if full or source.name not in self.loads:
            return pending
        return semi_join(pending, self.loads[source.name], [LOAD_TS])

    def _run_bronze(self, m: Model, t: LayerTable, full: bool) -> str:
        cfg, e = self.cfg, m.entity
        claimed = claim_new(self.spark, cfg.landing_root, e)
        if not full and claimed is None:
            return "skip"
        paths = claimed_and_archived(self.spark, cfg.landing_root, e) if full else [claimed]
        return self.load_bronze(m, scan_drifting(self.spark, paths, landing_schema(e)), full)

    def load_bronze(self, m: Model, raw: DataFrame, full: bool) -> str:
        """Load landed rows into the bronze table of ``m``.  The rows are
        written once as they come from the landed files, so that those are read
        once however often the load goes over them."""
        t, e = self.table(m), m.entity
        if t.has_batch():
            return "done"
        ts = t.next_load(self.load_ts)
        mark = utc_lit(t.newest_load()) if self.cfg.bronze_watermark and not full else None
        with t.stages() as stage:
            raw = stage(raw, "landed")
            if e == "measurement":
                bad = undated(raw, e).withColumn(LOAD_TS, utc_lit(ts))
                bad.hint("rebalance").write.mode("overwrite" if full else "append").parquet(f"{self.cfg.dq}/undated_measurement")
            repeated = None
            if m.partition_by:
                landed = with_measurement_date(bronze_rename(raw, e))
                repeated = self._repeated(t, landed, None if full else landed, stage)
            batch = build_bronze(raw, e, load_ts=ts, mark=mark, versioned=True, repeated=repeated)
            if e == "measurement":
                batch = batch.where(F.col(MEASUREMENT_DATE).isNotNull())
            if full:
                t.overwrite(batch, load_ts=ts)
                return "full"
            return "upsert" if t.upsert(batch, load_ts=ts, newest=EXTRACTION_TS, repeated=repeated) else "skip"

    def _repeated(self, t: LayerTable, rows: DataFrame, dates: DataFrame | None, stage: Callable[[DataFrame, str], DataFrame]) -> DataFrame | None:
        """The keys with several rows in ``rows``, and in the table's rows of
        their ``dates`` if there are any, together; None if they aren't few."""
        found, current = rows.select(*t.keys), None if dates is None else t.read()
        if current is not None:
            found = found.union(prune_to(current, dates, [t.partition_by]).select(*t.keys))
        return few(stage(repeated_keys(found, t.keys), "repeated"))

    def _build(self, m: Model, df: DataFrame, ts: _dt.datetime, repeated: DataFrame | None = None) -> DataFrame:
        if repeated is not None:  # of measurements
            build = build_gold_measurement if m.layer == "gold" else lambda d, **of: build_silver(d, m.entity, **of)
            return build(df, load_ts=ts, repeated=repeated)
        if m.layer == "silver":
            return build_silver(df, m.entity, load_ts=ts)
        build = {
            "country": lambda d, load_ts: build_gold_country(d, country_ids=self.cfg.country_ids, load_ts=load_ts),
            "location": build_gold_location, "sensor": build_gold_sensor, "measurement": build_gold_measurement,
            "measurement_hourly_aggregate": build_hourly, "measurement_daily_aggregate": build_daily,
        }[m.alias]
        return build(df, load_ts=ts)

    def _run_from(self, m: Model, t: LayerTable, full: bool) -> str:
        """Take in the loads of the first input that are pending."""
        source = self.table(m.inputs[0])
        pending = self._pending(t, source, full)  # before the rows are read: later loads wait
        _, df = self._source(m.inputs[0])
        ts = t.next_load(self.load_ts)
        if full:
            t.overwrite(self._build(m, df, ts), load_ts=ts)
            outcome = "full"
        elif pending.isEmpty():
            return "skip"
        elif m.partition_by == "date" and self.cfg.aggregate_mode == "recompute":
            dates = pending.select(F.col(MEASUREMENT_DATE).alias("date"))
            t.replace_partitions(rebuild_touched(df, dates, "date", lambda d: self._build(m, d, ts),
                                                 source_column=MEASUREMENT_DATE), load_ts=ts)
            outcome = "recompute"
        else:
            rows = source.rows_of(pending)
            append = not t.keys or (m.partition_by and self.cfg.measurement_mode == "append")
            if append:
                written = t.append(self._build(m, rows, ts), load_ts=ts)
            else:
                with t.stages() as stage:
                    repeated = self._repeated(t, rows, pending, stage) if m.partition_by else None
                    written = t.upsert(self._build(m, rows, ts, repeated), load_ts=ts, repeated=repeated)
            outcome = ("append" if append else "upsert") if written else "skip"
        t.consume(source, pending)
        return outcome

    def _run_aggregate(self, m: Model, t: LayerTable, full: bool) -> str:
        """Merge the states of the pending loads' new readings into the state
        table; groups in whose cell a reading was replaced are recomputed from
        their readings.  Only the touched dates of state and table are written.

        Every written date of the state says up to which load it holds
        (``through``), so a run that failed in between merges nothing twice.
        """
        hourly = m.alias == "measurement_hourly_aggregate"
        source = self.table(m.inputs[0])
        pending = self._pending(t, source, full)
        _, df = self._source(m.inputs[0])
        ts = t.next_load(self.load_ts)
        state = LayerTable(self.spark, self.cfg.warehouse_root, "gold", f"_{m.alias}_state", (), "date")
        finish = lambda s: finished(s, hourly=hourly).withColumn(LOAD_TS, utc_lit(ts))
        if not full and pending.isEmpty():
            return "skip"
        changes = None if full or not state.exists() else source.changes(pending)
        taken = pending if changes is not None else source.loads()
        through = utc_lit(load_time(taken.agg(F.unix_micros(F.max(LOAD_TS))).first()[0]))
        if changes is None:
            pending = t.pending(source)  # all rows are read: no load waits
            state.overwrite(partials(df, hourly=hourly).withColumn("through", through))
            t.overwrite(finish(state.read()), load_ts=ts)
            outcome = "full"
        else:
            dates = pending.select(F.col(MEASUREMENT_DATE).alias("date")).distinct()
            held = prune_to(state.read(), dates, ["date"])
            cell = state_cell(hourly)
            with state.stages() as stage:
                # cells are few (revised readings), dates fewer: written, so that
                # each is worked out once.  Few cells are broadcast, and the
                # readings are combined with the states in one aggregate
                dirty = stage(partials(changes.where("_change = 'replaced'"), hourly=hourly).select(*cell).distinct(), "dirty")
                upto = stage(held.groupBy("date").agg(F.max("through").alias("upto")), "through")
                added = changes.where("_change = 'added'")
                late = added.join(F.broadcast(upto), F.col(MEASUREMENT_DATE) == F.col("date"), "left")
                late = late.where(F.col("upto").isNull() | (F.col("_load") > F.col("upto"))).select(*added.columns)
                small = few(dirty)
                redone, state_of = (dirty, partials) if small is None else (small, reading_states)
                redo = prune_to(df, dirty.withColumnRenamed("date", MEASUREMENT_DATE), [MEASUREMENT_DATE])
                redo = semi_join(redo, redone, ["sensor_id", "parameter_id", MEASUREMENT_DATE], ["sensor_id", "parameter_id", "date"], dedup=small is None)
                states = [
                    anti_join(held.drop("through"), redone, cell, null_safe=True, dedup=False),
                    anti_join(state_of(late, hourly=hourly), redone, cell, null_safe=True, dedup=False),
                    semi_join(state_of(redo, hourly=hourly), redone, cell, null_safe=True, dedup=False),
                ]
                new = merged_partials(reduce(DataFrame.unionByName, states), hourly=hourly)
                state.replace_partitions(new.withColumn("through", through))
            held = prune_to(state.read(), dates, ["date"])
            t.replace_partitions(finish(held), load_ts=ts, touched=held)
            outcome = "merge"
        t.consume(source, pending)
        return outcome

    def _run_groups(self, m: Model, t: LayerTable, full: bool) -> str:
        """Location and locality after the pending loads: the groups that a
        changed location was in or is in now, and those of a changed country,
        are made anew from their locations; all other rows stay."""
        sources = [self.table(n) for n in m.inputs]
        pending = [self._pending(t, s, full) for s in sources]
        locations = self._source("silver_location")[1]
        build = build_gold_location
        if m.alias == "locality":
            countries = self._source("silver_country")[1]
            build = lambda d, load_ts: build_gold_locality(d, countries, load_ts=load_ts)
        ts = t.next_load(self.load_ts)
        if not full and all(p.isEmpty() for p in pending):
            return "skip"
        changes = [None if full else s.read().limit(0) if p.isEmpty() else s.changes(p) for s, p in zip(sources, pending, strict=True)]
        if any(c is None for c in changes):
            pending = [t.pending(s) for s in sources]  # all rows are read: no load waits
            t.overwrite(build(locations, load_ts=ts), load_ts=ts)
            outcome = "full"
        else:
            with t.stages() as stage:
                touched = locality_groups(changes[0])
                if m.alias == "locality":
                    ids = changes[1].select("id").distinct()
                    touched = touched.union(locality_groups(semi_join(locations, ids, ["country_id"], ["id"]))).distinct()
                touched = stage(touched, "groups")
                members = of_groups(locations, touched)
                current = t.read()
                if m.alias == "locality":
                    cond = current["name"].eqNullSafe(F.col("place")) & current["country_id"].eqNullSafe(F.col("country"))
                    kept = current.join(touched, cond, "left_anti")
                else:
                    kept = current.join(members.select(F.col("id").alias("__id")), F.col("id") == F.col("__id"), "left_anti")
                t.overwrite(kept.unionByName(build(members, load_ts=ts)), load_ts=ts)
            outcome = "groups"
        for s, p in zip(sources, pending, strict=True):
            t.consume(s, p)
        return outcome

    def _rebuild(self, m: Model, t: LayerTable, full: bool) -> str:
        """Small tables that depend on all rows of their inputs are made anew;
        reference-exact locality mode upserts the pending locations' rows."""
        ts = t.next_load(self.load_ts)
        source, df = self._source(m.inputs[0])
        if m.alias == "parameter":
            sources = [self.table(n) for n in m.inputs]
            pending = [self._pending(t, s, full) for s in sources]
            if not full and all(p.isEmpty() for p in pending):
                return "skip"
            t.overwrite(build_gold_parameter(df, self.parameters_with_data(), load_ts=ts), load_ts=ts)
            for s, p in zip(sources, pending, strict=True):
                t.consume(s, p)
            return "full"
        if m.alias == "location":
            t.overwrite(build_gold_location(df, load_ts=ts), load_ts=ts)
            return "full"
        countries = self._source("silver_country")[1]
        if full or self.cfg.locality_mode == "rebuild":
            t.overwrite(build_gold_locality(df, countries, load_ts=ts), load_ts=ts)
            return "full"
        pending = t.pending(source)
        wrote = t.upsert(build_gold_locality(source.rows_of(pending), countries, load_ts=ts), load_ts=ts)
        t.consume(source, pending)
        return "upsert" if wrote else "skip"

    def parameters_with_data(self) -> DataFrame:
        """Distinct parameter ids present in silver measurements.

        The set only grows, so it is kept in a small side table to which the
        pending loads' ids are added: an id is there before the load that
        brought it counts as taken in.
        """
        source = self.table("silver_measurement")
        side = LayerTable(self.spark, self.cfg.warehouse_root, "gold", "_parameters_with_data", ("parameter_id",))
        pending = side.pending(source)
        if not side.exists() or not pending.isEmpty():
            rows = source.rows_of(pending) if side.exists() else source.read()
            side.upsert(rows.select("parameter_id").distinct())
            side.consume(source, pending)
        return side.read() if side.exists() else source.read().select("parameter_id")

    # ---------------------------------------------------------------- layers
    def run_layer(self, layer: str, *, full_refresh: bool = False) -> dict[str, str]:
        """Run a layer's models (bronze: those of the configured entities)."""
        return self.run_models([m.name for m in MODELS if m.layer == layer], full_refresh=full_refresh)

    def run_models(self, names: Sequence[str], *, full_refresh: bool = False) -> dict[str, str]:
        """Run the models, each after those among them that it reads; what
        doesn't depend on each other runs side by side, from ``side_by_side``
        driver threads.  Under ``spark.scheduler.mode=FAIR`` each has a pool of
        its own, so a long model doesn't hold up the others.

        When a model fails, those that read it don't run, the others do, and
        then the failure is raised; the next run makes up what is missing.
        """
        chosen = [m for m in MODELS if m.name in names and (m.layer != "bronze" or m.entity in self.cfg.entities)]

        @inheritable_thread_target(self.spark)
        def run(m: Model, before: list[Future]) -> str:
            for f in before:
                f.result()
            self.spark.sparkContext.setLocalProperty("spark.scheduler.pool", m.name)
            return self.run_model(m.name, full_refresh=full_refresh)

        running: dict[str, Future] = {}
        # MODELS is in dependency order, so what a thread waits for has a thread
        with ThreadPoolExecutor(max(1, self.cfg.side_by_side)) as threads:
            for m in chosen:
                running[m.name] = threads.submit(run, m, [running[n] for n in m.inputs if n in running])
        return {name: f.result() for name, f in running.items()}

    def publish(self, names: Sequence[str] | None = None) -> list[str]:
        """Views of the tables' committed versions in the session's catalog, in
        a database a layer, named with the prefix ``catalog``."""
        chosen = [m for m in MODELS if names is None or m.name in names]
        return [v for m in chosen if (v := publish(self.spark, self.table(m), self.cfg.catalog or ""))]

    def compact(self, target_bytes: int = TARGET_BYTES) -> dict[str, tuple[int, int]]:
        """Pack small files and logs of all tables; files before and after, by
        table (see :meth:`LayerTable.compact`).  No model or stream may run."""
        return {m.name: t.compact(target_bytes) for m in MODELS if (t := self.table(m)).exists()}

    def land_pages(self) -> dict[str, int]:
        """Land the pending JSON pages; a page that isn't JSON is kept, whole,
        under ``dq/bad_pages``.  Landed page files are renamed to ``done/``."""
        out = {}
        for e in self.cfg.entities:
            base = f"{self.cfg.pages_root.rstrip('/')}/{e}"
            names = [n for n, is_dir in fs.children(self.spark, base) if n.endswith(".json") and not is_dir]
            claim = f"{base}/loading/{batch_name('pages')}"
            for n in names:
                fs.rename(self.spark, f"{base}/{n}", f"{claim}/{n}")
            for d in fs.child_dirs(self.spark, f"{base}/loading"):
                path = f"{base}/loading/{d}"
                self.land_parsed(parsed_pages(self.spark.read, path, e), e, d)
                fs.rename(self.spark, path, f"{base}/done/{d}")
            out[e] = len(names)
        return out

    def land_parsed(self, pages: DataFrame, entity: str, batch: str) -> None:
        """Land the records of parsed pages and keep the bad ones aside, under
        the batch's name: a batch that is tried again lands nothing twice.  The
        pages are parsed once, for both."""
        table = self.table(f"bronze_{entity}")
        with table.stages() as stage:
            parsed = stage(pages, "pages")
            name = f"pages_{batch}"
            if not is_landed(self.spark, self.cfg.landing_root, entity, name):
                land(landed_rows(parsed, entity), self.cfg.landing_root, entity, name=name)
            bad = bad_of(parsed).withColumn("entity", F.lit(entity))
            bad.hint("rebalance").write.mode("overwrite").parquet(f"{self.cfg.dq}/bad_pages/{entity}-{batch}")

    def archive(self) -> dict[str, int]:
        return {e: archive_loaded(self.spark, self.cfg.landing_root, e) for e in self.cfg.entities}

    def test(self, *, store: bool = True) -> DataFrame:
        """Run every declared column test over the whole tables; store the
        duplicate report's failing rows under ``<warehouse>/dq/duplicates``.
        Key tests and report come from one scan of each table.  Returns
        ``(test, failures)``."""
        tests, counted = checks.relationship_tests(self.read), {}
        found = checks.suspects(self.read)
        if found is not None:
            path = f"{self.cfg.dq}/key_suspects" if store else staging_path(self.spark, "key-suspects")
            found.write.mode("overwrite").parquet(path)
            found = self.spark.read.schema(found.schema).parquet(path)
            counted = checks.key_tests(self.read, found)
            dups = duplicates_of(found)
            if store:
                dups.write.mode("overwrite").parquet(f"{self.cfg.dq}/duplicates")
                dups = self.spark.read.schema(dups.schema).parquet(f"{self.cfg.dq}/duplicates")
            tests["duplicates"] = dups
        for name in ("undated_measurement", "bad_pages"):
            if fs.has_file(self.spark, f"{self.cfg.dq}/{name}"):
                # a load that is repeated keeps the same rows aside again
                kept = self.spark.read.option("recursiveFileLookup", "true").parquet(f"{self.cfg.dq}/{name}")
                tests[name] = kept.drop(LOAD_TS).distinct()
        known = self.spark.createDataFrame(list(counted.items()), "test string, failures long")
        return known.unionByName(run_checks(tests)) if tests else known

    def run_pipeline(self, *, full_refresh: bool = False, archive: bool = True, test: bool = True) -> DataFrame | None:
        """Land pending pages, bronze, silver, gold, then archive the landed
        files, advance the extraction mark, then tests.

        Tests report and do not gate the load (they run last)."""
        began = self.load_ts
        if self.cfg.pages_root:
            self.land_pages()
        self.run_models([m.name for m in MODELS], full_refresh=full_refresh)
        if archive:
            self.archive()
        if self.cfg.pages_root:
            write_mark(self.spark, self.cfg.mark, began)
        return self.test() if test else None
