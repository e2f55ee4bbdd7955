"""Exact top-k search by tiled matrix products.

Candidates are dealt into shards and queries into blocks; every block meets
every shard in a tile, which is one integer matrix product and a partial
selection of the k best of each query.  The lists of a query are merged in a
tree: ``FAN`` shards at a time, then ``FAN`` of those results, until one is
left.  This is a stated query set against all rows, in blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.common import pick, written

SHARD = 8192  # candidates of a tile
BLOCK = 1024  # queries of a tile
FAN = 16
_LONG = (1 << 63) - 1


def usable(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id long, v array<double>) without null ids, null vectors and
    vectors that hold a null or a non-finite component."""
    d = pick(df, vec_id=id_col, v=vec_col)
    d = d.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("v").cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return d.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~bad)


def best(df: DataFrame, by: list[str], order: list[Column], k: int, name: str = "rank") -> DataFrame:
    """The k first of each group.  Spark cuts every partition's groups to k
    before it shuffles them."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(name) <= k)


def merge_tree(lists: DataFrame, shards: int, order: list[Column], k: int, query: str = "query_id") -> DataFrame:
    """Per-query lists of ``shards`` shards (column ``shard``) to one list."""
    while shards > FAN:
        shards = math.ceil(shards / FAN)
        lists = best(lists.withColumn("shard", F.floor(F.col("shard") / FAN)), [query, "shard"], order, k).drop("rank")
    return best(lists, [query], order, k).withColumn("rank", F.col("rank").cast("int")).drop("shard")


def matrix(rows: pd.Series) -> np.ndarray:
    return np.stack([np.frombuffer(r, np.float64) for r in rows]) if len(rows) else np.zeros((0, 0))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T for whole numbers held as doubles, exact: as doubles while no
    sum can pass 2^53, else as Python integers, kept within a long."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if top < 2**53:
        return (a @ b.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    return np.clip(whole(a) @ whole(b).T, -_LONG - 1, _LONG).astype(np.int64) if a.size and b.size else np.zeros((len(a), len(b)), np.int64)


def select(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores of a row, ties to smaller ids; some
    more where the k-th score is tied."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > least)
        tied = np.flatnonzero(scores == least)
        need = k - len(above)
        if len(tied) > need:
            tied = tied[np.argpartition(ids[tied], need - 1)[:need]]
        return np.concatenate([above, tied])
    return np.arange(len(scores))


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, scale: int = 1024) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of
    floor(scale * x) vectors; ties to the smaller vec_id.

    Queries are the rows whose vec_id is divisible by ``every``; candidates
    are all rows but those of the query's vec_id.  Rows that repeat a vec_id
    are candidates each; as queries, a vec_id's rows give their lists under
    one id, merged.  Vectors of other lengths than the query's are no
    candidates.  Null ids and vectors and non-finite components take no part.
    """
    own = usable(vectors)
    whole = lambda x: F.when(F.abs(x * scale) < 2**52, F.floor(x * scale).cast("double")).otherwise(x * scale)
    own = own.select("vec_id", F.size("v").alias("dim"), F.transform("v", whole).alias("v")).where(~F.exists("v", lambda x: F.abs(x) == float("inf")))
    pack = with_bytes(own)
    counts = pack.groupBy("dim").agg(F.count("*").alias("n"), F.sum(F.when(F.pmod("vec_id", F.lit(every)) == 0, 1).otherwise(0)).alias("q"))
    counts = counts.select("dim", F.ceil(F.col("n") / SHARD).alias("shards"), F.ceil(F.col("q") / BLOCK).alias("blocks"))
    dims = written(counts, "dims")
    most = dims.agg(F.max("shards")).first()[0] or 1
    deal = lambda n, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.col(n))
    pack = pack.join(dims.where("blocks > 0"), "dim")
    item = F.struct("vec_id", "bytes")
    shard = pack.withColumn("shard", deal("shards", 1)).groupBy("dim", "shard").agg(F.collect_list(item).alias("rows"))
    block = pack.where(F.pmod("vec_id", F.lit(every)) == 0).withColumn("block", deal("blocks", 2))
    block = block.groupBy("dim", "block", "shards").agg(F.collect_list(item).alias("queries"))
    block = block.select("dim", "block", "queries", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"))
    tiles = block.join(shard, ["dim", "shard"]).select("shard", "queries", "rows")

    def run(frames):
        for f in frames:
            for s, queries, rows in zip(f["shard"], f["queries"], f["rows"], strict=True):
                ids = np.array([r["vec_id"] for r in rows])
                qs = np.array([r["vec_id"] for r in queries])
                scores = products(matrix([r["bytes"] for r in queries]), matrix([r["bytes"] for r in rows]))
                out = []
                for q, row in zip(qs, scores, strict=True):
                    other = np.flatnonzero(ids != q)
                    at = other[select(row[other], ids[other], k)]
                    out.append((np.full(len(at), q), ids[at], row[at]))
                yield pd.DataFrame({"shard": s, **{c: np.concatenate([o[i] for o in out]) for i, c in enumerate(("query_id", "vec_id", "score"))}})

    lists = tiles.mapInPandas(run, "shard long, query_id long, vec_id long, score long")
    got = merge_tree(lists, most, [F.col("score").desc(), F.col("vec_id")], k)
    return got.select("query_id", "rank", "vec_id", "score")


def with_bytes(df: DataFrame) -> DataFrame:
    """vec_id, dim and the components' bytes, which a tile reads as a matrix
    without boxing, of (vec_id, dim, v)."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            flat = b.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            ends = np.cumsum(b.column(1).to_numpy())
            raw = [p.tobytes() for p in np.split(flat, ends[:-1])] if len(ends) else []
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(raw, pa.binary())], ["vec_id", "dim", "bytes"])

    return df.mapInArrow(run, "vec_id long, dim int, bytes binary")
