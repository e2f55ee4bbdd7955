"""Exact k-means of whole-number vectors by shallot search.

A vector remembers its nearest and its second nearest centroid, an upper bound
of its distance to the first and a lower bound of the distance to all others.
Each round the bounds follow the movement of the centroids; where they can't
decide, the distances to the two remembered centroids are measured and the scan
starts from the closer one, over the other centroids in the order of their
distance from it.  A centroid farther from the start than the vector's distance
to the start plus its second best distance can't matter, so the search ball
shrinks whenever a nearer second is found.  Those that are met are compared in
integers; bounds are doubles, rounded away from wrong decisions.

Vectors travel in blocks (one row holds those of an Arrow batch, as a matrix of
the least integer type that holds them), beside their bounds.  A round reads
the blocks, adds up each block's clusters in the task, and writes the blocks
with the new bounds to the shared folder, so a lost executor costs a re-read;
the round before is deleted then.  Only sums by cluster reach the driver.

Cases: vectors of another length, null ones and those with null or non-finite
components take no part; a null vec_id is hashed as an empty one.  Rows that
repeat a vec_id are vectors each; equal hashes of first centroids are ordered by
vec_id and components.  Fewer vectors than clusters give as many clusters.  An
empty table gives no rows.  Components that don't fit a long are cut to its
range, and so are distances and sums that don't fit, after being compared
exactly.  Extra columns are left out.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import pick, small_batches, stored
from medallion.sources import fs

TOP = (1 << 63) - 1
EXACT = 1 << 26  # components below it: squares of 64 differences fit a long
BLOCK = "ids binary, known binary, dim int, kind string, vectors binary, first binary, second binary, upper binary, lower binary, distance binary"
_WIDER, _NARROWER = 1 + 1e-9, 1 - 1e-9


def whole_vectors(vectors: DataFrame, dim: int, scale: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id long, v array<long>): floor(scale * x) of the usable vectors."""
    d = pick(vectors, vec_id=id_col, v=vec_col).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("v").cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform("v", lambda x: F.floor(x * scale))  # beyond a long: its least or greatest
    return d.where((F.size("v") == dim) & ~bad).select("vec_id", whole.alias("v"))


def first_centroids(rows: DataFrame, k: int, seed: int) -> list[list[int]]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    return [list(r.v) for r in rows.select(digest.alias("h"), "vec_id", "v").orderBy("h", "vec_id", "v").limit(k).collect()]


def largest(v: np.ndarray) -> int:
    """The greatest x or -x - 1 of the components, which no type overflows."""
    return int(max(v.max(initial=0), -(v.min(initial=0) + 1)))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``a`` to those of ``b`` (one row
    or as many): longs, or Python integers where longs could overflow."""
    if max(largest(a), largest(b)) < EXACT and a.shape[-1] <= 256:
        d = a.astype(np.int64) - b.astype(np.int64)
        return np.einsum("ij,ij->i", d, d)
    d = a.astype(object) - b.astype(object)
    return (d * d).sum(axis=1)


def root(sq: np.ndarray) -> np.ndarray:
    return np.sqrt(sq.astype(np.float64))


class Search:
    """Centroids, their distances from each other, and each one's neighbours
    in order; how far each moved since the round before."""

    def __init__(self, centroids: list[list[int]], before: list[list[int]] | None):
        self.c = np.array(centroids, object)
        if not self.c.size or max(abs(int(x)) for x in self.c.flat) < 1 << 62:
            self.c = self.c.astype(np.int64)
        k = len(centroids)
        self.between = np.array([root(squared(self.c, self.c[i : i + 1])) for i in range(k)]) if k else np.zeros((0, 0))
        self.near = [sorted((j for j in range(k) if j != i), key=lambda j, i=i: (self.between[i, j], j)) for i in range(k)]
        self.half = np.array([self.between[i, n[0]] / 2 if n else np.inf for i, n in enumerate(self.near)]) * _NARROWER
        old = np.array(before, object) if before else self.c
        self.moved = root(squared(self.c, old)) * _WIDER if k else np.zeros(0)

    def start(self, v: np.ndarray):
        """First bounds: nothing is known, so the first two are measured."""
        n = len(v)
        return np.zeros(n, np.int32), np.full(n, min(1, len(self.c) - 1), np.int32), np.full(n, np.inf), np.zeros(n)

    def step(self, v: np.ndarray, first: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> int:
        """Assigns the vectors to their nearest centroids, in place; returns
        how many had to be searched."""
        if len(self.c) < 2:
            return 0
        far = np.sort(self.moved)[::-1]
        upper += self.moved[first]
        lower -= np.where(self.moved[first] == far[0], far[1], far[0]) if np.sum(self.moved == far[0]) == 1 else far[0]
        clear = np.maximum(lower, self.half[first])
        at = np.flatnonzero(~(upper < clear))
        known = squared(v[at], self.c[first[at]])
        upper[at] = root(known) * _WIDER
        open_ = ~(upper[at] < clear[at])
        at, known = at[open_], known[open_]
        other = squared(v[at], self.c[second[at]])
        # the closer of the two remembered ones is where the scan starts
        swap = (other < known) | ((other == known) & (second[at] < first[at]))
        d1, d2 = np.where(swap, other, known), np.where(swap, known, other)
        a, b = np.where(swap, second[at], first[at]), np.where(swap, first[at], second[at])
        start, ball = a.copy(), root(d1) * _WIDER
        for s in np.unique(start):
            rows = np.flatnonzero(start == s)
            skip = b[rows].copy()  # the remembered second was measured already
            for j in self.near[s]:
                # the ball of the start's distance and the second best one
                inside = self.between[s, j] * _NARROWER <= ball[rows] + root(d2[rows]) * _WIDER
                rows, skip = rows[inside], skip[inside]
                if not len(rows):
                    break
                todo = rows[skip != j]
                d = squared(v[at[todo]], self.c[j : j + 1])
                best = (d < d1[todo]) | ((d == d1[todo]) & (j < a[todo]))
                next_ = ~best & ((d < d2[todo]) | ((d == d2[todo]) & (j < b[todo])))
                down, in_ = todo[best], todo[next_]
                b[down], d2[down] = a[down], d1[down]
                a[down], d1[down] = j, d[best]
                b[in_], d2[in_] = j, d[next_]
        first[at], second[at] = a, b
        upper[at], lower[at] = root(d1) * _WIDER, root(d2) * _NARROWER
        return len(at)


def _least_type(v: np.ndarray) -> str:
    top = largest(v)
    return "<i2" if top < 1 << 15 else "<i4" if top < 1 << 31 else "<i8"


def blocks(rows: DataFrame, dim: int) -> DataFrame:
    """One row for the vectors of an Arrow batch."""

    def run(batches):
        for b in batches:
            ids = b.column(0)
            v = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            if len(v):
                kind = _least_type(v)
                known = np.array(ids.is_valid().to_pylist(), bool)
                row = [ids.fill_null(0).to_numpy().tobytes(), known.tobytes(), dim, kind, v.astype(kind).tobytes(), *[None] * 5]
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, _ARROW.types, strict=True)], schema=_ARROW)

    return rows.mapInArrow(run, BLOCK)


_ARROW = pa.schema([(n, {"binary": pa.binary(), "int": pa.int32(), "string": pa.string()}[t]) for n, t in (f.split() for f in BLOCK.split(", "))])
_STATE = (("first", np.int32), ("second", np.int32), ("upper", np.float64), ("lower", np.float64))


def assigned(state: DataFrame, centroids: list[list[int]], before: list[list[int]] | None, last: bool = False) -> DataFrame:
    """The blocks with the bounds that follow from ``centroids``, which were
    ``before`` in the last round; ``last`` adds the distances."""
    search = Search(centroids, before)

    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                v = np.frombuffer(row["vectors"], row["kind"]).reshape(-1, row["dim"])
                if row["first"] is None:
                    bounds = search.start(v)
                else:
                    bounds = [np.frombuffer(row[c], t).copy() for c, t in _STATE]
                search.step(v, *bounds)
                row |= {c: x.astype(t).tobytes() for (c, t), x in zip(_STATE, bounds, strict=True)}
                if last:
                    d = squared(v, search.c[bounds[0]])
                    row["distance"] = np.minimum(d, TOP).astype(np.int64).tobytes()
                out.append(row)
            yield pa.RecordBatch.from_pylist(out, schema=_ARROW)

    return state.mapInArrow(run, BLOCK)


def cluster_sums(state: DataFrame) -> DataFrame:
    """(cluster, d, n, total): count and sums of the components d of each
    cluster; d = -1 has the distances.  A task adds up its blocks first."""
    schema = "cluster int, d int, n long, total decimal(38,0)"
    arrow = pa.schema([("cluster", pa.int32()), ("d", pa.int32()), ("n", pa.int64()), ("total", pa.decimal128(38, 0))])

    def run(batches):
        sums: dict = {}
        for batch in batches:
            for row in batch.to_pylist():
                v = np.frombuffer(row["vectors"], row["kind"]).reshape(-1, row["dim"])
                first = np.frombuffer(row["first"], np.int32)
                far = row["distance"] and np.frombuffer(row["distance"], np.int64).astype(object)
                exact = v if row["kind"] != "<i8" else v.astype(object)
                for c in np.unique(first).tolist():
                    own = first == c
                    n, total = sums.get(c, (0, np.zeros(1 + row["dim"], object)))
                    add = exact[own].sum(axis=0, dtype=None if exact.dtype == object else np.int64)
                    total[1:] += add.astype(object)
                    if far is not None:
                        total[0] += far[own].sum()
                    sums[c] = n + int(own.sum()), total
        out = [(c, i - 1, n, Decimal(int(x))) for c, (n, total) in sums.items() for i, x in enumerate(total)]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), arrow.types)] if out else [pa.array([], t) for t in arrow.types], schema=arrow)

    return state.mapInArrow(run, schema).groupBy("cluster", "d").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def clusters(vectors: DataFrame, k: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, seed: int = 3) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia,
    centroid_sha256, after ``rounds`` rounds from seeded first centroids."""
    spark = vectors.sparkSession
    small_batches(spark)
    own = whole_vectors(vectors, dim, scale)
    centroids, before, held = first_centroids(own, k, seed), None, None
    state = blocks(own, dim)
    for r in range(rounds + 1):
        state, path = stored(assigned(state, centroids, before, last=r == rounds), "clusters")
        if held:
            fs.delete(spark, held)
        held = path
        sums = cluster_sums(state).collect()  # a row per cluster and component
        if r < rounds:
            before, centroids = centroids, [list(c) for c in centroids]
            for s in sums:
                if s.d >= 0:
                    centroids[s.cluster][s.d] = int(s.total) // s.n
    inertia = {s.cluster: min(int(s.total), TOP) for s in sums if s.d < 0}
    whole = min(sum(int(s.total) for s in sums if s.d < 0), TOP)
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"

    def rows(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, first = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["first"], np.int32)
                known = np.frombuffer(row["known"], bool)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64(), mask=~known), pa.array(first), pa.array(np.frombuffer(row["distance"], np.int64)),
                    pa.array([inertia[c] for c in first.tolist()], pa.int64()), pa.array(np.full(len(ids), whole)), pa.array([shas[c] for c in first.tolist()], pa.string()),
                ], names=[f.split()[0] for f in schema.split(", ")])

    return state.mapInArrow(rows, schema)
