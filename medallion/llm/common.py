"""Helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib
import functools
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.session import staging_path


ROWS = 512
BUCKET_BYTES = 64 << 20
_REUSED: list = []


def reused(make: Callable) -> Callable:
    """What ``make`` returns stays in the Python worker for its later tasks
    (a model, a table), until a task of another operator starts there."""
    kept = functools.lru_cache(maxsize=2)(make)
    _REUSED.append(kept)
    return kept


def _started(start: Callable[[], object] | None):
    before = [kept.cache_info()[:2] for kept in _REUSED]
    state = start() if start else None
    for kept, was in zip(_REUSED, before, strict=True):
        if kept.cache_info()[:2] == was:
            kept.cache_clear()
    return state


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of ``ROWS`` rows, unless the submitter chose a size: rows
    are whole documents here, and Spark's 10,000 of them take much memory on
    both sides."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not spark.sparkContext.getConf().contains(key):
        spark.conf.set(key, str(ROWS))


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under new names: ``pick(df, id="doc_id")``.

    Columns are found by position, first by their exact name and then
    ignoring case, so extra columns (also ones that differ in case only, or
    repeat a name) never clash with an operator's own.
    """
    names = df.columns
    lower = [n.lower() for n in names]
    at = {new: names.index(old) if old in names else lower.index(old.lower()) for new, old in columns.items()}
    flat = df.toDF(*[f"_c{i}" for i in range(len(names))])
    return flat.select(*[F.col(f"_c{i}").alias(new) for new, i in at.items()])


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", more: Sequence[str] = ()) -> DataFrame:
    """(doc_id long, text binary): the input of the text operators.  Texts
    travel as UTF-8 bytes, which Python splits without decoding them; a null
    text is empty.  The columns ``more`` follow as they are."""
    d = pick(df, doc_id=id_col, text=text_col, **{c: c for c in more})
    return d.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
        *more,
    )


_collected: list[list[str]] = []


@contextlib.contextmanager
def collecting(paths: list[str]) -> Iterator[None]:
    """Within it, the folders of written tables are also listed in ``paths``,
    for the caller to delete when what was made of them has been written."""
    _collected.append(paths)
    try:
        yield
    finally:
        _collected.pop()


def _staged(spark: SparkSession, name: str) -> str:
    path = staging_path(spark, f"llm-{name}")
    for paths in _collected:
        paths.append(path)
    return path


def stored(df: DataFrame, name: str, options: dict | None = None) -> tuple[DataFrame, str]:
    """Cut the lineage: write ``df`` to the shared folder and read it back.
    A lost executor then costs a re-read, not a recomputation.  The folder is
    for the caller to delete when the frame's last reader has been written."""
    spark = df.sparkSession
    path = _staged(spark, name)
    df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, name: str, options: dict | None = None) -> DataFrame:
    """:func:`stored`, for frames that a query's result still reads."""
    return stored(df, name, options)[0]


def laid_out(df: DataFrame, key: str, name: str, size: int) -> DataFrame:
    """``df``, of about ``size`` bytes, written in hash buckets of its column
    ``key``: joins on it shuffle the other side only, however often."""
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    n = min(n, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))
    table, path = f"llm_{name}_{uuid.uuid4().hex}", _staged(spark, name)
    df.repartition(n, key).write.bucketBy(n, key).option("path", path).format("parquet").saveAsTable(table)
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # the files stay, and the frame knows them
    return out


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str, start: Callable[[], object] | None = None, rows: int = ROWS) -> DataFrame:
    """``mapInArrow`` with one column dictionary per batch.  ``start`` makes a
    task's own state (a model, a cache), given to ``fn`` as its second
    argument.  Batches are handed on in slices of ``rows``, so that what a
    worker holds besides the batch stays small."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _started(start)
        for batch in batches:
            for lo in range(0, batch.num_rows, rows):
                part = batch.slice(lo, rows)
                cols = fn(part, state) if start else fn(part)
                yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) for f in arrow], schema=arrow)

    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files behind tables that are written by now:
    it does so when the driver's garbage is collected."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()
