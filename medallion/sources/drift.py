"""Schema-drift-tolerant scan: landed files grouped by signature, each group
read by Spark's own Parquet reader.

Files written page by page by a JSON normaliser drift: a column can be
int64 in one file and double in the next, missing, all null (a null-typed
column), or a list whose elements are empty or lack a field.  Spark reads a
set of files with one schema and fails on such mixes.  So a first job takes
the footers of all files (the ``binaryFile`` source opens any path that Spark
can; the footer is cut off in the JVM and only it reaches Python) and notes
each file's *signature*: the types of those columns that Spark can't read
as the target type.  The files of a signature are one Parquet scan with
those columns' own types, cast to the target by name, nested types included;
the scans are united.  Columns are pruned and filters pushed into every scan.

Most files agree, so there are few signatures.  The driver holds the files'
paths by signature, as Spark does for any scan it lists.  A file too large to
be handed over whole (``LARGE``) has its footer read by Spark's schema
inference, one by one.
"""

from __future__ import annotations

import json
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from medallion.functions.exprs import col_of
from medallion.sources import fs

LARGE = 1 << 30  # bytes of a file whose footer isn't taken by the job

# How the Parquet types that Arrow tells are read by Spark.
_READ_AS = {
    "null": T.IntegerType(), "bool": T.BooleanType(), "int8": T.ByteType(), "int16": T.ShortType(), "int32": T.IntegerType(),
    "int64": T.LongType(), "uint8": T.ShortType(), "uint16": T.IntegerType(), "uint32": T.LongType(), "uint64": T.DecimalType(20, 0),
    "float": T.FloatType(), "double": T.DoubleType(), "string": T.StringType(), "large_string": T.StringType(), "string_view": T.StringType(),
    "binary": T.BinaryType(), "large_binary": T.BinaryType(), "date32[day]": T.DateType(), "nanos": T.LongType(),
    "instant": T.TimestampType(), "wall": T.TimestampNTZType(),
}
# What Spark's reader widens by itself.
_WIDENS = {("int32", "bigint"), ("int32", "double"), ("float", "double"), ("int8", "int"), ("int16", "int")}


def described(t: pa.DataType, int96: bool = False):
    """The type of a column of a file: a name, ["list", element] or a dict of
    fields.  None: a type that no landed column has (read as missing).
    ``int96``: its nanoseconds are the old Parquet type, which is an instant."""
    if pa.types.is_dictionary(t):
        return described(t.value_type, int96)
    if pa.types.is_list(t) or pa.types.is_large_list(t):
        item = described(t.value_type, int96)
        return None if item is None else ["list", item]
    if pa.types.is_struct(t):
        fields = {f.name: described(f.type, int96) for f in t}
        return {n: d for n, d in fields.items() if d is not None} or None
    if pa.types.is_timestamp(t):
        return "nanos" if t.unit == "ns" and not int96 else "instant" if t.tz or int96 else "wall"
    return str(t) if str(t) in _READ_AS else f"decimal({t.precision},{t.scale})" if pa.types.is_decimal128(t) else None


def read_type(d) -> T.DataType:
    if isinstance(d, list):
        return T.ArrayType(read_type(d[1]))
    if isinstance(d, dict):
        return T.StructType([T.StructField(n, read_type(x)) for n, x in d.items()])
    return _READ_AS[d] if d in _READ_AS else T.DecimalType(*map(int, d[8:-1].split(",")))


def agrees(d, target: T.DataType) -> bool:
    """Does Spark's reader give a column of this type as ``target``?  Missing
    fields are null there."""
    if isinstance(target, T.ArrayType):
        return isinstance(d, list) and agrees(d[1], target.elementType)
    if isinstance(target, T.StructType):
        return isinstance(d, dict) and any(f.name in d for f in target) and all(f.name not in d or agrees(d[f.name], f.dataType) for f in target)
    return isinstance(d, str) and d != "null" and d != "nanos" and (read_type(d) == target or (d, target.simpleString()) in _WIDENS)


def aligned(c: Column, d, target: T.DataType) -> Column:
    """``c``, of the type ``d``, as ``target``: structs by field name (missing
    fields null), lists by element; a value that can't be cast is null."""
    nothing = F.lit(None).cast(target)
    if isinstance(target, T.StructType):
        if not isinstance(d, dict):
            return nothing
        parts = [(aligned(c.getField(f.name), d[f.name], f.dataType) if f.name in d else F.lit(None).cast(f.dataType)).alias(f.name) for f in target]
        return F.when(c.isNotNull(), F.struct(*parts))
    if isinstance(target, T.ArrayType):
        return F.transform(c, lambda x: aligned(x, d[1], target.elementType)).cast(target) if isinstance(d, list) else nothing
    if not isinstance(d, str):
        return nothing
    if d == "nanos":
        c = F.timestamp_micros(F.call_function("div", c - F.pmod(c, F.lit(1000)), F.lit(1000)))
        d = "instant"
    own = read_type(d)
    if isinstance(own, T.BinaryType) and not isinstance(target, T.BinaryType):
        c, own = c.cast("string"), T.StringType()
    return c.try_cast(target) if _castable(own, target) else nothing


def _castable(a: T.DataType, b: T.DataType) -> bool:
    """Is there a cast between the two: from and to text, among numbers and
    booleans, among dates and times."""
    text = T.StringType
    kinds = [(text, T.BinaryType), (T.NumericType, T.BooleanType), (T.DateType, T.TimestampType, T.TimestampNTZType)]
    return (isinstance(a, text) or isinstance(b, text) and not isinstance(a, T.BinaryType)) or any(isinstance(a, k) and isinstance(b, k) for k in kinds)


def _footers(files: DataFrame) -> DataFrame:
    """(path, footer) of files given with their content: a Parquet file ends
    with its footer, four bytes of its length and four of a mark."""
    n = F.col("length")
    digits = F.hex(F.substring("content", (n - 7).cast("int"), F.lit(4)))
    size = F.conv(F.concat(*[F.substring(digits, k, 2) for k in (7, 5, 3, 1)]), 16, 10).cast("long")
    return files.select("path", F.substring("content", (n - 7 - size).cast("int"), (size + 8).cast("int")).alias("footer"))


def signatures(files: DataFrame, schema: T.StructType) -> DataFrame:
    """(path, signature) of files (path, length, content): the target columns
    that need their own type, as JSON, by name."""
    targets = {f.name: f.dataType for f in schema}

    def run(batches):
        import pyarrow.parquet as pq

        for batch in batches:
            out = []
            for footer in batch.column(1):
                file = pq.ParquetFile(pa.BufferReader(b"PAR1" + footer.as_py()))
                # a leaf's path begins with its column, whose name may have dots
                old = [c.path + "." for c in map(file.schema.column, range(len(file.schema))) if c.physical_type == "INT96"]
                found = {f.name: described(f.type, any(p.startswith(f.name + ".") for p in old)) for f in file.schema_arrow if f.name in targets}
                out.append(signature(found, targets))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["path", "signature"])

    return _footers(files).mapInArrow(run, "path string, signature string")


def signature(found: dict, targets: dict[str, T.DataType]) -> str:
    return json.dumps({n: d for n, d in sorted(found.items()) if d is None or not agrees(d, targets[n])})


def _inferred(spark: SparkSession, path: str, schema: T.StructType) -> str:
    """The signature of one large file, by Spark's own reading of its footer."""
    own = spark.read.parquet(_literal(path)).schema
    return signature({f.name: described(to_arrow_type(f.dataType)) for f in own if f.name in schema.names}, {f.name: f.dataType for f in schema})


def _literal(path: str) -> str:
    """A path whose characters stand for themselves in a glob."""
    return "".join("\\" + c if c in "\\*?[]{}" else c for c in path)


def read_group(spark: SparkSession, paths: list[str], sig: str, schema: T.StructType) -> DataFrame:
    """The files of one signature, as ``schema``."""
    own = json.loads(sig)
    fields = [T.StructField(f.name, read_type(own[f.name]) if own.get(f.name) is not None else f.dataType) for f in schema if own.get(f.name, "") is not None]
    df = spark.read.schema(T.StructType(fields)).parquet(*map(_literal, paths))
    cols = []
    for f in schema:
        if f.name not in own:
            c = col_of(f.name)
        else:
            c = F.lit(None).cast(f.dataType) if own[f.name] is None else aligned(col_of(f.name), own[f.name], f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def scan_files(spark: SparkSession, files: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of the Parquet files (path, length, content) as ``schema``: one scan
    for each signature."""
    groups: dict[str, list[str]] = {}
    small = signatures(files.where(F.col("length") <= LARGE), schema)
    for r in small.groupBy("signature").agg(F.collect_list("path").alias("paths")).collect():
        groups.setdefault(r.signature, []).extend(r.paths)
    for r in files.where(F.col("length") > LARGE).select("path").collect():
        groups.setdefault(_inferred(spark, r.path, schema), []).append(r.path)
    if not groups:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, [read_group(spark, sorted(paths), sig, schema) for sig, paths in sorted(groups.items())])


def scan_drifting(spark: SparkSession, path: str | list[str], schema: T.StructType, *,
                  glob: str = "*.parquet") -> DataFrame:
    """Every file under the path(s) as ``schema``; paths that don't exist hold
    no files."""
    there = [p for p in ([path] if isinstance(path, str) else path) if fs.has_file(spark, p, glob.lstrip("*"))]
    if not there:
        return spark.createDataFrame([], schema)
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true").load(there))
    return scan_files(spark, files, schema)


def align_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: cast present columns, null-fill missing ones."""
    have = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name in have:
            cols.append(col_of(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def union_aligned(frames: list[DataFrame], schema: T.StructType) -> DataFrame:
    """Union frames of drifting shapes after aligning each to ``schema``."""
    return reduce(lambda a, b: a.unionByName(b), [align_to_schema(f, schema) for f in frames])
