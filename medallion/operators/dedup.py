"""Latest-version-wins and row de-duplication.

``latest_wins`` keeps, for every key, all rows carrying the key's newest
version timestamp (ties are kept, like a row-value ``IN`` against
``max(ts) ... GROUP BY key``).  Rows with a null key part or a null
timestamp never survive: equality with null is unknown.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.functions.exprs import col_of


def not_null(keys: Sequence[str], ts: str) -> Column:
    """Has a row a whole key and a version?"""
    cond = col_of(ts).isNotNull()
    for k in keys:
        cond = cond & col_of(k).isNotNull()
    return cond


def latest_wins(df: DataFrame, keys: Sequence[str], ts: str, *, strategy: str = "aggregate") -> DataFrame:
    """Rows of ``df`` whose ``ts`` equals the max ``ts`` of their key.

    strategy="aggregate" (default): ``max(ts)`` per key with a map-side
    partial aggregate, then a left-semi join back on (keys, ts).  Nothing
    ever gathers a whole key group in one task: the aggregate combines
    per map partition, and the semi join is hashed on (keys, ts), so a hot
    key with many versions spreads out; a hot key whose rows all tie is
    split by AQE's skew-join handling.  It reads ``df`` twice, the first
    time only the key and timestamp columns.

    strategy="window": one pass with ``rank() over (partition by keys
    order by ts desc)``.  Cheaper for unskewed keys, but a single key's
    rows all land in one task.
    """
    keys = list(keys)
    clean = df.where(not_null(keys, ts))
    if strategy == "window":
        w = Window.partitionBy(*[col_of(k) for k in keys]).orderBy(col_of(ts).desc())
        return (clean.withColumn("__rank", F.rank().over(w))
                .where(F.col("__rank") == 1).drop("__rank"))
    if strategy != "aggregate":
        raise ValueError(f"unknown strategy {strategy!r}")
    names = [f"__lw_k{i}" for i in range(len(keys))]
    newest = (clean.groupBy(*[col_of(k).alias(n) for k, n in zip(keys, names)])
              .agg(F.max(col_of(ts)).alias("__lw_ts")))
    cond = clean[_q(ts)] == F.col("__lw_ts")
    for k, n in zip(keys, names):
        cond = cond & (clean[_q(k)] == F.col(n))
    return clean.join(newest, cond, "left_semi")


def _key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``_key``: the hashes of the keys that more than one row of ``df`` has,
    for keys of whole numbers and text.  Eight bytes a row are shuffled, and
    keys that share a hash by chance only add to what is compared later."""
    hashes = df.select(_key_hash(keys).alias("_key"))
    return hashes.groupBy("_key").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1).select("_key")


def of_repeated(df: DataFrame, keys: Sequence[str], repeated: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows whose key is among the ``repeated``, a small frame that is
    broadcast (with ``how="left_anti"`` all others)."""
    return df.join(F.broadcast(repeated), _key_hash(keys) == F.col("_key"), how).select(*df.columns)


def resolve_repeated(df: DataFrame, keys: Sequence[str], repeated: DataFrame | None,
                     resolve: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``resolve(df)``, which works on the rows of each key by themselves and
    gives a key's only row as it is.  With ``repeated``, the hashes of all keys
    with several rows, only their rows are shuffled and compared."""
    if repeated is None:
        return resolve(df)
    return of_repeated(df, keys, repeated, "left_anti").unionByName(resolve(of_repeated(df, keys, repeated)))


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`" if "." in name else name


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``SELECT DISTINCT`` over ``columns`` (all by default).

    Spark plans it as a partial + final hash aggregate on all columns, so
    duplicates collapse map-side before the shuffle.
    """
    if columns is not None:
        df = df.select(*[col_of(c) for c in columns])
    return df.distinct()
