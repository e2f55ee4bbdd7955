from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from medallion.llm.shallot import Search, clusters, squared

SCHEMA = "vec_id long, embedding array<float>, cluster int, EMBEDDING string, ids binary"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 1, "x", None) for i, v in vectors], SCHEMA).repartition(3)


def brute(vectors, k=8, rounds=10):
    own = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in vectors
           if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    top = (1 << 63) - 1
    own = [(i, [max(-top - 1, min(top, x)) for x in v]) for i, v in own]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    first = sorted((sha(f"3:{'' if i is None else i}"), -1 if i is None else i, v) for i, v in own)
    cents = [v for _, _, v in first[:k]]
    near = lambda v: min((sum((x - y) ** 2 for x, y in zip(v, c)), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        where = [near(v)[1] for _, v in own]
        for j in range(len(cents)):
            mine = [v for (_, v), w in zip(own, where) if w == j]
            if mine:
                cents[j] = [sum(c) // len(mine) for c in zip(*mine)]
    got = [(i, *near(v)[::-1]) for i, v in own]
    total = {j: min(top, sum(min(d, top) for _, c, d in got if c == j)) for j in range(k)}
    return sorted(map(str, [(i, c, min(d, top), total[c], min(top, sum(min(d, top) for *_, d in got)), sha(",".join(map(str, cents[c])))) for i, c, d in got]))


def got(df):
    return sorted(map(str, map(tuple, clusters(df).collect())))


def test_odd_vectors(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(150, 64)).round(1)
    vectors = [(i, v.tolist()) for i, v in enumerate(base)]
    vectors += [(1000 + i, base[0].tolist()) for i in range(60)]  # many copies of one
    vectors += [(1, base[2].tolist()), (None, base[3].tolist()), (None, base[4].tolist())]
    vectors += [(2000, None), (2001, [None] * 64), (2002, [float("nan")] * 64), (2003, [float("-inf")] * 64), (2004, [0.5] * 63), (2005, []), (2006, [0.0] * 64)]
    assert got(frame(spark, vectors)) == brute(vectors)


def test_two_values_only_tie_everywhere(spark):
    vectors = [(i, [float(i % 2)] * 64) for i in range(40)]
    assert got(frame(spark, vectors)) == brute(vectors)


@pytest.mark.parametrize("n", [0, 1, 2, 5])
def test_fewer_vectors_than_clusters(spark, n):
    vectors = [(i, [float(i)] * 64) for i in range(n)]
    assert got(frame(spark, vectors)) == brute(vectors)


def test_components_beyond_a_long(spark):
    vectors = [(i, [(-1.0) ** i * 10.0 ** (i % 30)] * 64) for i in range(60)]
    assert got(frame(spark, vectors)) == brute(vectors)


def test_bounds_never_decide_wrongly():
    """Many rounds with centroids that move by chance."""
    rng = np.random.default_rng(8)
    v = rng.integers(-40, 40, size=(600, 3)).astype("<i2")
    cents, before, bounds, searched = rng.integers(-40, 40, size=(9, 3)).tolist(), None, None, []
    for r in range(30):
        s = Search(cents, before)
        bounds = bounds or s.start(v)
        searched.append(s.step(v, *bounds))
        d = np.stack([squared(v, np.array([c])) for c in cents], axis=1)
        assert bounds[0].tolist() == d.argmin(axis=1).tolist()
        rest = d.astype(float)
        rest[np.arange(len(v)), bounds[0]] = np.inf
        assert (bounds[2] ** 2 >= d.min(axis=1)).all() and (np.maximum(bounds[3], 0) ** 2 <= rest.min(axis=1)).all()
        before, cents = cents, (np.array(cents) + rng.integers(-3, 4, size=(9, 3)) * (r % 3 == 0)).tolist()
    assert searched[0] > 500 and min(searched) == 0  # the bounds spare those that stay clear
