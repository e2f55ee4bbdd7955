"""File-system metadata through the Hadoop FileSystem of a path.

Existence checks, version listing and renames are metadata operations; they
run on the driver against the file system (HDFS, object stores, local) and
never launch a Spark job.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def has_file(spark: SparkSession, path: str, suffix: str = ".parquet") -> bool:
    """Is there at least one ``*suffix`` data file under ``path`` (recursive)?

    Walks lazily and stops at the first match; hidden (``_``/``.``) files
    such as ``_SUCCESS`` do not count.
    """
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return False
    it = fs.listFiles(p, True)
    while it.hasNext():
        name = it.next().getPath().getName()
        if name.endswith(suffix) and not name.startswith(("_", ".")):
            return True
    return False


def children(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(name, is a folder) of what is in ``path`` and isn't hidden (empty when
    it does not exist)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    found = [(s.getPath().getName(), s.isDirectory()) for s in fs.listStatus(p)]
    return [(n, d) for n, d in found if not n.startswith(("_", "."))]


def data_files(spark: SparkSession, path: str, suffix: str = ".parquet") -> dict[str, int]:
    """Sizes of the data files under ``path`` (recursive), by their path in it."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return {}
    base, out = fs.makeQualified(p).toUri().getPath().rstrip("/") + "/", {}
    it = fs.listFiles(p, True)
    while it.hasNext():
        status = it.next()
        name = status.getPath().toUri().getPath()[len(base):]
        if name.endswith(suffix) and not any(part.startswith(("_", ".")) for part in name.split("/")):
            out[name] = status.getLen()
    return out


def child_dirs(spark: SparkSession, path: str) -> list[str]:
    return [n for n, is_dir in children(spark, path) if is_dir]


def rename(spark: SparkSession, src: str, dest: str) -> None:
    """Rename, creating the parent folder; fails if the store refuses."""
    fs, p = _fs(spark, src)
    to = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(dest)
    fs.mkdirs(to.getParent())
    if not fs.rename(p, to):
        raise OSError(f"cannot rename {src} to {dest}")


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def delete(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path`` (a metadata operation on the file system)."""
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """A small new file; fails if it is there already."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    out = fs.create(p, False)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
