from __future__ import annotations

import math

import numpy as np
import pytest

from medallion.llm import ann, topk

SCHEMA = "vec_id long, embedding array<float>, label int, bytes int, score double"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 1, 2, 3.0) for i, v in vectors], SCHEMA).repartition(3)


def ok(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def brute_top(vectors, k=10, every=100):
    own = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in vectors if i is not None and ok(v)]
    out = []
    for q, a in own:
        if q % every == 0:
            hits = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in own if i != q and len(a) == len(b))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(hits[:k])]
    return sorted(out)


@pytest.fixture(scope="module")
def odd():
    rng = np.random.default_rng(2)
    base = rng.normal(size=(260, 6)).round(1).tolist()  # rounded: ties
    vectors = [(i, v) for i, v in enumerate(base)]
    vectors += [(1000 + i, base[0]) for i in range(150)]  # one common vector, two of its rows queries
    vectors += [(300, None), (400, [None] * 6), (500, [float("nan")] * 6), (501, [float("inf")] * 6), (600, [0.0] * 6), (601, [0.0] * 6), (700, []), (None, base[1])]
    return vectors


def test_top_k_of_odd_vectors_and_several_tiles(spark, odd, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 16)
    monkeypatch.setattr(topk, "BLOCK", 2)
    monkeypatch.setattr(topk, "FAN", 3)
    got = topk.top_k(frame(spark, odd))
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute_top(odd)


def test_top_k_of_few_and_no_rows(spark):
    few = [(0, [1.0, 2.0]), (7, [0.5, 0.5]), (9, [-1.0, 0.25]), (200, [1.0])]
    assert sorted(tuple(r) for r in topk.top_k(frame(spark, few)).collect()) == brute_top(few)
    assert topk.top_k(frame(spark, few).limit(0)).count() == 0


def test_products_stay_exact_for_large_numbers():
    a, b = np.array([[3.0e9, 1.0]]), np.array([[2.0e9, 3.0], [1e300, 0.0]])
    assert topk.products(a, b).tolist() == [[6 * 10**18 + 3, (1 << 63) - 1]]


def brute_nearest(vectors, k=10, every=100):
    own = [(i, np.array(v, np.float32).astype(float)) for i, v in vectors if i is not None and ok(v) and any(v)]
    out = {}
    for q, a in own:
        if q % every == 0:
            out[q] = sorted((float(np.sqrt(((a - b) ** 2).sum())), i) for i, b in own if i != q and len(a) == len(b))[:k]
    return out


def lists(got):
    out = {}
    for r in sorted(got.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


def test_nearest_of_odd_vectors(spark, odd):
    # so few rows that enough are only in all leaves: the lists are exact
    got = lists(ann.nearest(frame(spark, odd)))
    want = brute_nearest(odd)
    assert got.keys() == want.keys()
    for q, hits in want.items():
        assert [i for _, i in got[q]] == [i for _, i in hits]
        assert np.allclose([s for s, _ in got[q]], [s for s, _ in hits], rtol=1e-12, atol=0)
    assert ann.nearest(frame(spark, odd).limit(0)).count() == 0
    assert lists(ann.nearest(frame(spark, [(0, [1.0, 0.0]), (5, [0.0, 1.0])]))) == {0: [(math.sqrt(2), 5)]}


def test_recall_and_exact_scores(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    vectors = [(r.vec_id, r.embedding) for r in df.collect()]
    got, want = lists(ann.nearest(df)), brute_nearest(vectors)
    assert got.keys() == want.keys()
    found = sum(len({i for _, i in got[q]} & {i for _, i in hits}) for q, hits in want.items())
    assert found >= 0.9 * sum(len(h) for h in want.values())
    by_id = {i: np.array(v, np.float32).astype(float) for i, v in vectors}
    for q, hits in got.items():
        assert hits == sorted(hits) and len(hits) == 10
        assert all(abs(s - np.sqrt(((by_id[q] - by_id[i]) ** 2).sum())) < 1e-12 for s, i in hits)


def test_a_forest_for_each_length(spark):
    """Most rows are of one length, and all queries of the others."""
    rng = np.random.default_rng(12)
    vectors = [(i * 7 + 1 if (i * 7 + 1) % 100 else 9001, rng.normal(size=8).tolist()) for i in range(320)]
    vectors += [(100 * i, rng.normal(size=6).tolist()) for i in range(1, 5)] + [(20_001 + i, rng.normal(size=6).tolist()) for i in range(76)]
    vectors += [(700, [1.0, 2.0])]
    got, want = lists(ann.nearest(frame(spark, vectors))), brute_nearest(vectors)
    assert got.keys() == {q for q, hits in want.items() if hits} == {100, 200, 300, 400}
    for q in got:
        assert [i for _, i in got[q]] == [i for _, i in want[q]]


@pytest.mark.parametrize("n", [600, 710, 1500, 4000])
def test_recall_at_any_size(spark, n):
    rng = np.random.default_rng(n)
    vectors = [(i * 10, v.tolist()) for i, v in enumerate(rng.normal(size=(n, 64)))]
    got, want = lists(ann.nearest(frame(spark, vectors))), brute_nearest(vectors)
    found = sum(len({i for _, i in got[q]} & {i for _, i in hits}) for q, hits in want.items())
    assert found >= 0.9 * sum(len(h) for h in want.values())
