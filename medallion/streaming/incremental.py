"""Run-when-available loading of landed files with Structured Streaming.

The file source's checkpoint remembers which landed files were processed,
so nothing is skipped or loaded twice (no extraction-time watermark is
needed); ``trigger(availableNow=True)`` processes everything pending and
stops, which gives the daily batch cadence; ``cleanSource="archive"`` moves
processed files out of ``new/`` into the entity's archive folder.  Each
micro-batch is written with the same idempotent keyed upsert as the batch
runner, newest version of a key first, and logged with its load, so a retried
micro-batch leaves the same table and logs.  Silver and gold are streams over
the load logs of their inputs, chained by ``availableNow``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from medallion.plans.models import MODELS, MODELS_BY_NAME
from medallion.plans.runner import PipelineConfig, Runner
from medallion.schemas import landing_schema
from medallion.session import ensure_checkpoint_dir
from medallion.sources import fs
from medallion.sources.api_pages import parsed_pages
from medallion.sources.drift import scan_files
from medallion.sources.landing import entity_dir, new_dir

ARCHIVE_DIR = "archive"
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def stream_checkpoint(spark: SparkSession, cfg: PipelineConfig, entity: str) -> str:
    """Checkpoint folder of an entity's bronze stream, under the shared
    ``spark.checkpoint.dir`` unless the config names one."""
    base = cfg.extra.get("stream_checkpoint_root") or f"{ensure_checkpoint_dir(spark).rstrip('/')}/medallion-streams"
    return f"{base.rstrip('/')}/{entity}"


def landing_stream(spark: SparkSession, cfg: PipelineConfig, entity: str, *, archive: bool = True,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of newly landed files of ``entity``, with their content.

    The file source tracks which files were seen (in its checkpoint) and
    archives them; each micro-batch's files are read by signature, as in the
    drift scan, because landed pages disagree on column types and one fixed
    streaming schema cannot read them all.  Folders and files whose names begin
    with ``_`` or ``.`` are not complete yet and aren't listed.
    """
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("pathGlobFilter", "*.parquet"))
    if archive:
        reader = (reader.option("cleanSource", "archive")
                  .option("sourceArchiveDir", f"{entity_dir(cfg.landing_root, entity)}/{ARCHIVE_DIR}"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(f"{new_dir(cfg.landing_root, entity)}/[^_.]*/").select("path", "length", "content")


def _bronze_writer(spark: SparkSession, cfg: PipelineConfig, entity: str):
    model = MODELS_BY_NAME[f"bronze_{entity}"]

    def write(files: DataFrame, batch_id: int) -> None:
        runner = Runner(files.sparkSession, cfg, batch=(model.name, batch_id))
        if not runner.table(model).has_batch():
            runner.load_bronze(model, scan_files(files.sparkSession, files, landing_schema(entity)), full=False)

    return write


def _start(stream: DataFrame, write, name: str, checkpoint: str, available_now: bool, processing_time: str | None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def start_bronze_stream(spark: SparkSession, cfg: PipelineConfig, entity: str, *,
                        archive: bool = True, available_now: bool = True,
                        processing_time: str | None = None) -> StreamingQuery:
    """Start the bronze load of ``entity`` as a streaming query."""
    return _start(landing_stream(spark, cfg, entity, archive=archive), _bronze_writer(spark, cfg, entity), f"bronze_{entity}",
                  stream_checkpoint(spark, cfg, entity), available_now, processing_time)


def _page_writer(cfg: PipelineConfig, entity: str):
    def write(pages: DataFrame, batch_id: int) -> None:
        Runner(pages.sparkSession, cfg).land_parsed(pages, entity, f"stream_{entity}_{batch_id}")

    return write


def start_page_stream(spark: SparkSession, cfg: PipelineConfig, entity: str, *, multi_line: bool = True,
                      available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Start landing the raw JSON pages of ``entity``, ``<pages_root>/<entity>``:
    a micro-batch is parsed once and goes to two sinks, the landing zone and
    the bad pages, both under the batch's number."""
    pages = parsed_pages(spark.readStream, f"{cfg.pages_root.rstrip('/')}/{entity}", entity, multi_line=multi_line)
    return _start(pages, _page_writer(cfg, entity), f"pages_{entity}", stream_checkpoint(spark, cfg, f"pages_{entity}"), available_now, processing_time)


def _layer_writer(cfg: PipelineConfig, model: str, source: str):
    def write(loads: DataFrame, batch_id: int) -> None:
        runner = Runner(loads.sparkSession, cfg, batch=(f"{model}<{source}", batch_id), loads={source: loads})
        runner.run_model(model)

    return write


def start_layer_streams(spark: SparkSession, cfg: PipelineConfig, model: str, *, available_now: bool = True,
                        processing_time: str | None = None) -> list[StreamingQuery]:
    """Start a silver or gold model as streams over the load logs of its
    inputs: a micro-batch is the loads that a source logged since the last one,
    and takes in what they changed.  The load it makes is logged with the
    micro-batch, so that one that is tried again loads nothing twice."""
    runner, out = Runner(spark, cfg), []
    for source in map(runner.table, MODELS_BY_NAME[model].inputs):
        logs = spark.readStream.schema(source.loads().schema).parquet(source.load_log())
        out.append(_start(logs, _layer_writer(cfg, model, source.name), f"{model}<{source.name}",
                          stream_checkpoint(spark, cfg, f"{model}-{source.name}"), available_now, processing_time))
        if available_now:
            _finish(out[-1])
    return out


def _finish(q: StreamingQuery) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream {q.name} failed") from None


def run_available_now(spark: SparkSession, cfg: PipelineConfig, *, archive: bool = True,
                      test: bool = True, models: list[str] | None = None) -> DataFrame | None:
    """The daily flow in streaming form: pages are landed, every entity's bronze
    stream processes all pending files and stops, then the silver and gold
    streams (of all models, or of ``models``) take in the loads that the layer
    before logged, then the tests run."""
    for entity in cfg.entities:
        if cfg.pages_root and fs.exists(spark, f"{cfg.pages_root.rstrip('/')}/{entity}"):
            _finish(start_page_stream(spark, cfg, entity))
        if fs.exists(spark, new_dir(cfg.landing_root, entity)):
            _finish(start_bronze_stream(spark, cfg, entity, archive=archive))
    runner = Runner(spark, cfg)
    for m in MODELS:
        if m.layer != "bronze" and (models is None or m.name in models) and all(runner.table(i).exists() for i in m.inputs):
            start_layer_streams(spark, cfg, m.name)
    return runner.test() if test else None
