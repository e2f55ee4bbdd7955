"""Approximate nearest neighbours by a forest of random-projection trees.

Vectors of each length have a forest of their own.  Its trees are grown on a
bounded sample: a node cuts its points at the median of their projections on
the line through two of them.  Every row is then dealt to its leaf of each
tree.  A query searches all trees through one priority queue, ordered by how
far the query is on the wrong side of the cuts so far, until the leaves it took
hold ``probes`` of what all leaves hold, and at least ``AT_LEAST`` rows (a row
counts in each tree); this is the rule at every size.  The rows of those leaves
are ranked by their exact distance.

Rows with equal vectors are indexed once, with their least ids: a list of k
can't need more of them, as ties go to smaller ids.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import map_batches, written
from medallion.llm.topk import best, matrix, usable, with_bytes

SAMPLE = 16384  # vectors of a length that trees are grown on: at most so many rows reach the driver,
SAMPLES = 65536  # of all lengths together, but for a few of each
FEW = 256
TREES = 16
LEAVES = 256  # of a tree, at most
LEAF = 64  # points of the sample in a leaf, about and at least
PROBES = 0.07  # of the rows in all leaves of the forest
AT_LEAST = 4096  # rows in the leaves that a query takes
BLOCK = 2048  # vectors of a leaf, and queries, that meet in one tile


class Forest:
    """Trees as lists of nodes: a leaf's number, or (normal, cut, left, right)."""

    def __init__(self, sample: np.ndarray, trees: int, leaves: int, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.trees = [self._grow(sample, max(LEAF, len(sample) // leaves), rng) for _ in range(trees)]
        self.held = [np.zeros(sum(isinstance(n, int) for n in t), np.int64) for t in self.trees]  # rows of each leaf

    def _grow(self, x: np.ndarray, size: int, rng: np.random.Generator) -> list:
        nodes: list = []
        leaves = 0
        todo = [(np.arange(len(x)), None, 0)]
        while todo:
            rows, parent, side = todo.pop()
            me = len(nodes)
            if parent is not None:
                nodes[parent][side] = me
            cut = None
            if len(rows) > size:
                a, b = x[rng.choice(rows, 2, replace=False)]
                normal = a - b if (a != b).any() else rng.normal(size=x.shape[1])
                length = np.linalg.norm(normal)
                if 0 < length < np.inf:
                    normal = normal / length
                    p = x[rows] @ normal
                    cut = float(np.median(p))
                    left = p <= cut
            if cut is None or left.all() or not left.any():
                nodes.append(leaves)
                leaves += 1
            else:
                nodes.append([normal, cut, 0, 0])
                todo += [(rows[~left], me, 3), (rows[left], me, 2)]
        return nodes

    def leaf_of(self, tree: int, x: np.ndarray) -> np.ndarray:
        nodes, out = self.trees[tree], np.empty(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            me, rows = todo.pop()
            node = nodes[me]
            if isinstance(node, int):
                out[rows] = node
            elif len(rows):
                left = x[rows] @ node[0] <= node[1]
                todo += [(node[2], rows[left]), (node[3], rows[~left])]
        return out

    def search(self, q: np.ndarray, probes: float) -> list[tuple[int, int]]:
        """(tree, leaf) of the leaves from the queue, until they hold enough."""
        enough = max(AT_LEAST, probes * sum(h.sum() for h in self.held))
        queue, out = [(-np.inf, t, 0) for t in range(len(self.trees))], []
        while queue and enough > 0:
            wrong, t, me = heapq.heappop(queue)
            node = self.trees[t][me]
            if isinstance(node, int):
                if self.held[t][node]:
                    out.append((t, node))
                    enough -= self.held[t][node]
            else:
                p = float(q @ node[0]) - node[1]
                heapq.heappush(queue, (max(wrong, p), t, node[2]))
                heapq.heappush(queue, (max(wrong, -p), t, node[3]))
        return out


def nearest(vectors: DataFrame, k: int = 10, every: int = 100, probes: float = PROBES) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found, by Euclidean
    distance in double precision; ties to the smaller vec_id.

    Queries are the rows whose vec_id is divisible by ``every``; candidates
    are all rows of the query's length but those of its vec_id.  Null ids and
    vectors, zero vectors and vectors with null or non-finite components take
    no part.  Repeated rows count once per vec_id and vector.  Empty table: no
    rows.  Extra columns are left out.
    """
    spark = vectors.sparkSession
    own = usable(vectors).select("vec_id", F.size("v").alias("dim"), "v").where(F.exists("v", lambda x: x != 0))
    own = written(with_bytes(own), "vectors")
    schema = "query_id long, rank int, vec_id long, score double"
    # equal vectors: the k + 1 least ids (one may be the query's own)
    ids = best(own.select("bytes", "vec_id").distinct(), ["bytes"], [F.col("vec_id")], k + 1, "nth")
    points = written(ids.groupBy("bytes").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "points")
    dims = sorted(r.dim for r in points.select(F.length("bytes").alias("dim")).distinct().collect())  # a row per length
    if not dims:
        return spark.createDataFrame([], schema)
    each = min(SAMPLE, max(FEW, SAMPLES // len(dims)))
    drawn = best(points.select("bytes", F.length("bytes").alias("dim")), ["dim"], [F.xxhash64("bytes"), F.col("bytes")], each).collect()
    drawn = {d: sorted((r.rank, bytes(r.bytes)) for r in drawn if r.dim == d) for d in dims}
    forests = {d: Forest(matrix(pd.Series([x for _, x in rows])), TREES, LEAVES) for d, rows in drawn.items()}
    first = {d: i * TREES for i, d in enumerate(dims)}  # number of a forest's first tree
    grown = spark.sparkContext.broadcast(forests)

    def by_length(vectors: list[bytes]):
        for d, forest in grown.value.items():
            at = [i for i, v in enumerate(vectors) if len(v) == d]
            if at:
                yield d, forest, np.array(at)

    def deal(batch: pa.RecordBatch) -> dict:
        vectors, out = batch.column(0).to_pylist(), ([], [], [])
        for d, forest, at in by_length(vectors):
            x = matrix([vectors[i] for i in at])
            for t in range(TREES):
                for column, v in zip(out, (at, np.full(len(at), first[d] + t), forest.leaf_of(t, x)), strict=True):
                    column.append(v)
        row, tree, leaf = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in out)
        return {"bytes": batch.column(0).take(pa.array(row)), "ids": batch.column(1).take(pa.array(row)), "tree": tree, "leaf": leaf}

    members = map_batches(points, deal, "bytes binary, ids array<long>, tree int, leaf int")
    held = members.groupBy("tree", "leaf").count().collect()  # TREES * LEAVES rows a length, and a few
    for r in held:
        d = dims[r.tree // TREES]
        forests[d].held[r.tree % TREES][r.leaf] = r["count"]
    shared = spark.sparkContext.broadcast(forests)

    def probe(batch: pa.RecordBatch) -> dict:
        vectors = batch.column(1).to_pylist()
        found = []
        for v in vectors:
            d = len(v)
            found.append([(first[d] + t, leaf) for t, leaf in shared.value[d].search(np.frombuffer(v), probes)])
        row = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
        flat = np.array([p for f in found for p in f], np.int64).reshape(-1, 2)
        return {"q": batch.column(0).take(row), "query": batch.column(1).take(row), "tree": flat[:, 0], "leaf": flat[:, 1]}

    sizes = spark.createDataFrame([(r.tree, r.leaf, -(-r["count"] // BLOCK)) for r in held], "tree int, leaf int, blocks long")
    members = members.join(F.broadcast(sizes), ["tree", "leaf"])  # at most TREES * LEAVES rows and a few
    block = F.pmod(F.xxhash64("bytes"), F.col("blocks"))
    members = members.groupBy("tree", "leaf", block.alias("block")).agg(F.collect_list(F.struct("bytes", "ids")).alias("rows"))
    queries = own.where(F.pmod("vec_id", F.lit(every)) == 0)
    # a query vector goes by the least id of its rows
    alike = written(queries.groupBy("bytes").agg(F.min("vec_id").alias("q")), "queries")
    wanted = map_batches(alike.select("q", "bytes"), probe, "q long, query binary, tree int, leaf int")
    parts = max(1, -(-queries.count() // BLOCK))  # no leaf has more queries than there are
    wanted = wanted.groupBy("tree", "leaf", F.pmod(F.xxhash64("q"), F.lit(parts)).alias("part")).agg(F.collect_list(F.struct("q", "query")).alias("queries"))
    tiles = wanted.join(members, ["tree", "leaf"]).select("queries", "rows")

    def rank(frames):
        for f in frames:
            found = []
            for qs, rows in zip(f["queries"], f["rows"], strict=True):
                x, xid = matrix([r["bytes"] for r in rows]), np.repeat(np.arange(len(rows)), [len(r["ids"]) for r in rows])
                flat = np.concatenate([np.asarray(r["ids"]) for r in rows])
                for q in qs:
                    d = np.sqrt(((x - np.frombuffer(q["query"])) ** 2).sum(1))
                    # any row as near as the (k+1)-th
                    near = d <= np.partition(d, k)[k] if len(d) > k + 1 else np.ones(len(d), bool)
                    at = np.flatnonzero(near[xid])
                    at = at[np.lexsort((flat[at], d[xid[at]]))][: k + 1]
                    found.append((np.full(len(at), q["q"]), flat[at], d[xid[at]]))
            if found:
                yield pd.DataFrame({c: np.concatenate([g[i] for g in found]) for i, c in enumerate(("q", "vec_id", "score"))})

    order = [F.col("score"), F.col("vec_id")]
    lists = tiles.mapInPandas(rank, "q long, vec_id long, score double")
    # the trees find the same rows again, with the same distance
    lists = best(lists.groupBy("q", "vec_id").agg(F.min("score").alias("score")), ["q"], order, k + 1).drop("rank")
    ids_of = queries.select(F.col("vec_id").alias("query_id"), "bytes").distinct().join(alike, "bytes").select("query_id", "q")
    got = ids_of.join(lists, "q").where("vec_id != query_id")
    got = best(got.select("query_id", "vec_id", "score").distinct(), ["query_id"], order, k)
    return got.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
