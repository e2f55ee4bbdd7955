"""Token ids of a corpus in flat, memory-mapped files.

A folder holds, for each part ``K`` (documents in ascending doc_id order
within and across the parts):

* ``part-K.bin``: the ids, unsigned 16-bit little-endian (32-bit for a
  vocabulary beyond 65,536), one document after the other;
* ``part-K.idx``: n + 1 unsigned 64-bit offsets into the part's ids;
* ``part-K.doc``: n signed 64-bit doc_ids (-2^63 stands for null);

and ``manifest.parquet``: a row per part with its document and id counts and
its ``base``, the ids of all parts before it (a prefix sum over the parts).
A document's ids start, in the whole corpus, at its part's base plus its
offset.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm.common import documents, small_batches
from medallion.llm.tokens import word_ids

NULL_ID = -(1 << 63)
_PARTS = "part long, docs long, ids long"
_DOCS_AT_ONCE = 4096


def _store(folder: str) -> tuple[pa.fs.FileSystem, str]:
    if "://" in folder or folder.startswith("file:"):
        scheme = urlparse(folder)
        if scheme.scheme == "file":
            return pa.fs.LocalFileSystem(), unquote(scheme.path)
        return pa.fs.FileSystem.from_uri(folder)
    return pa.fs.LocalFileSystem(), folder


def write_ids(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int) -> DataFrame:
    """Write the files of ``docs`` under ``folder``; returns the manifest.

    Texts are dealt out in ranges of (doc_id, hash of the text), so that one
    repeated doc_id doesn't make one large part, and sorted within the
    ranges; a task encodes its range and streams it to its own files, under
    names of the attempt, which it renames when complete.  A repeated attempt
    writes the same bytes.  Only a row per part reaches the driver.

    Null text: the end id alone.  Null doc_id: before all others.  Repeated
    doc_ids: in the order of the texts' hashes.  Empty table: no part.
    """
    spark = docs.sparkSession
    small_batches(spark)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        words = fs = None
        n_docs = n_ids = 0
        kinds, streams = ("bin", "idx", "doc"), []
        for batch in batches:
            if not batch.num_rows:
                continue
            if words is None:
                words, (fs, base) = word_ids(tokenizer_path), _store(folder)
                end = np.array([end_id], words.dtype).tobytes()
                fs.create_dir(base, recursive=True)
                names = [f"{base}/part-{part:06d}.{k}" for k in kinds]
                streams = [fs.open_output_stream(f"{n}.{attempt}.tmp") for n in names]
                streams[1].write(np.zeros(1, "<u8").tobytes())
            lens = []
            for t in batch.column(1).to_pylist():
                ids = words.ids(t) + end
                streams[0].write(ids)
                lens.append(len(ids) // words.dtype.itemsize)
            streams[1].write((n_ids + np.cumsum(lens)).astype("<u8").tobytes())
            doc_ids = batch.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False)
            streams[2].write(doc_ids.astype("<i8").tobytes())
            n_docs, n_ids = n_docs + len(lens), n_ids + sum(lens)
        if n_docs:
            for s, n in zip(streams, names, strict=True):
                s.close()
                fs.move(f"{n}.{attempt}.tmp", n)
            yield pa.RecordBatch.from_pydict({"part": [part], "docs": [n_docs], "ids": [n_ids]}, schema=pa.schema([(c, pa.int64()) for c in ("part", "docs", "ids")]))

    ranged = documents(docs).withColumn("h", F.xxhash64("text")).repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text")
    parts = sorted(ranged.select("doc_id", "text").mapInArrow(write, _PARTS).collect())
    bases = np.concatenate([[0], np.cumsum([p.ids for p in parts])]).astype(int).tolist()
    manifest = spark.createDataFrame([(*p, b) for p, b in zip(parts, bases, strict=False)], f"{_PARTS}, base long")
    path = f"{folder.rstrip('/')}/manifest.parquet"
    manifest.coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _array(fs: pa.fs.FileSystem, path: str, dtype: np.dtype) -> np.ndarray:
    """Memory-mapped where the store is a mounted file system."""
    if isinstance(fs, pa.fs.LocalFileSystem):
        return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.zeros(0, dtype)
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype)


def read_ids(spark: SparkSession, folder: str, dtype: np.dtype) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (of the ids as little-endian
    unsigned 32-bit integers) of every document in the files."""
    parts = spark.read.parquet(f"{folder.rstrip('/')}/manifest.parquet")

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = _store(folder)
        for frame in frames:
            for part, before in zip(frame["part"], frame["base"], strict=True):
                name = f"{base}/part-{part:06d}"
                ids, idx, doc = _array(fs, f"{name}.bin", dtype), _array(fs, f"{name}.idx", np.dtype("<u8")), _array(fs, f"{name}.doc", np.dtype("<i8"))
                for lo in range(0, len(doc), _DOCS_AT_ONCE):
                    at = idx[lo : lo + _DOCS_AT_ONCE + 1].astype(np.int64)
                    own = pd.Series(np.array(doc[lo : lo + _DOCS_AT_ONCE]), dtype="Int64")
                    yield pd.DataFrame({
                        "doc_id": own.mask(own == NULL_ID),
                        "start": at[:-1] + before,
                        "n_tokens": np.diff(at),
                        "ids_crc32": [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)],
                    })

    n = max(1, parts.count())
    return parts.repartition(n).mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
