from __future__ import annotations

import random
from collections import defaultdict

import pytest

from medallion.llm import mixing
from medallion.llm.mixing import mix, min_cost_flow, sized, targets


def test_targets_share_by_weight_below_three_times_the_size():
    sizes = {"a": 1000, "b": 10, "c": 500, None: 0}
    got = targets(sizes, {"a": 1, "b": 2, "c": 3, None: 1})
    assert got[None] == 0 and got["b"] == 30
    assert got["c"] == pytest.approx(min(1500, 3 * got["a"])) and sum(got.values()) == pytest.approx(1510)
    assert targets({}, {}) == {}


def test_flow_meets_quotas_at_least_repetition():
    patterns = [(("a",), 100), (("a", "b"), 100), (("b",), 10)]
    flow = min_cost_flow(patterns, {"a": 120, "b": 90})
    assert sum(f.get("a", 0) for f in flow) == 120 and sum(f.get("b", 0) for f in flow) == 90
    assert all(sum(f.values()) <= size for f, (_, size) in zip(flow, patterns, strict=True))  # nothing twice
    flow = min_cost_flow(patterns, {"a": 0, "b": 1000})
    assert [sum(f.values()) for f in flow] == [0, 300, 30]  # three times at most


def brute_cost(patterns, quotas):
    """Least cost over all whole splits, for tiny cases."""
    best = {(0,) * len(quotas): 0}
    names = list(quotas)
    for members, size in patterns:
        new = {}
        for have, cost in best.items():
            def split(i, left, got, have=have, cost=cost, members=members, size=size):
                if i == len(names):
                    used = 3 * size - left
                    c = cost + sum(min(size, max(0, used - r * size)) * (r + 1) for r in range(3))
                    key = tuple(h + g for h, g in zip(have, got, strict=True))
                    new[key] = min(c, new.get(key, 1 << 60))
                    return
                top = min(left, quotas[names[i]] - have[i]) if names[i] in members else 0
                for g in range(top + 1):
                    split(i + 1, left - g, (*got, g))
            split(0, 3 * size, ())
        best = new
    most = max(sum(k) for k in best)
    return most, min(c for k, c in best.items() if sum(k) == most)


def test_flow_is_optimal_on_small_cases():
    rnd = random.Random(4)
    for _ in range(25):
        patterns = [(tuple(sorted(rnd.sample("abc", rnd.randint(1, 3)))), rnd.randint(0, 3)) for _ in range(3)]
        quotas = {s: rnd.randint(0, 5) for s in "abc"}
        flow = min_cost_flow(patterns, quotas)
        used = [sum(f.values()) for f in flow]
        cost = sum(sum(min(size, max(0, u - r * size)) * (r + 1) for r in range(3)) for u, (_, size) in zip(used, patterns, strict=True))
        assert (sum(used), cost) == brute_cost(patterns, quotas)


def test_mix_of_odd_documents(spark):
    rnd = random.Random(1)
    rows = [(i, " ".join("w" for _ in range(rnd.randint(0, 40))), "hot" if i % 3 else f"s{i % 7}") for i in range(400)]
    rows += [(None, "a b", "s1"), (5, rows[5][1], rows[5][2]), (900, None, "s1"), (901, "x y z", None), (902, "\xa0 q", "é"), (903, "", "only empty"), (904, "one " * 3000, "long")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, size int, TAKEN int").repartition(4)
    got = mix(sized(df)).collect()
    assert len(got) == len(rows) and sorted(map(str, got)) == sorted(map(str, mix(sized(df.repartition(3))).collect()))
    by, taken, most = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in got:
        s = r.sources[0]
        by[s] += r["size"]
        taken[s] += r.taken
        most[s] = max(most[s], r["size"])
        assert r.taken % max(1, r["size"]) == 0 and r.taken <= 3 * r["size"]
    want = targets(dict(by), {s: (1, 2, 3)[i % 3] for i, s in enumerate(sorted(by, key=lambda s: (s is None, s or "")))})
    for r in got:
        s = r.sources[0]
        assert r.source_size == by[s] and r.target == want[s]
        assert abs(taken[s] - want[s]) <= most[s] / 2 + 1
    assert mix(sized(df.limit(0))).count() == 0


def test_mix_of_overlapping_sources(spark):
    rows = [(i, 10, ["a"] if i < 50 else ["a", "b"] if i < 80 else ["b", "c"]) for i in range(100)]
    got = mix(spark.createDataFrame(rows, "doc_id long, size long, sources array<string>")).collect()
    assert sum(r.taken for r in got) == pytest.approx(sum(mixing.targets({"a": 800, "b": 500, "c": 200}, {"a": 1, "b": 2, "c": 3}).values()), abs=30)


def test_rows_that_share_an_id_are_dealt_without_meeting(spark, monkeypatch):
    """A third of all rows of one id, and more of none: the search goes on to
    sizes and row numbers until few rows are left."""
    monkeypatch.setattr(mixing, "FEW", 8)
    rnd = random.Random(9)
    rows = [(7 if i % 3 == 0 else None if i % 3 == 1 else i, rnd.randint(0, 3), ["a"] if i % 5 else ["b"]) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, size long, sources array<string>").repartition(4)
    docs = mixing.keyed(df)
    plan = mixing.plan_mix(docs)
    assert 0 < plan.n_last <= 16
    got = mix(df).collect()
    want = {r.sources[0]: r.target for r in got}
    for s in "ab":
        assert abs(sum(r.taken for r in got if r.sources[0] == s) - want[s]) <= 3 / 2 + 1
    again = mix(df.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_too_many_patterns_are_refused(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PATTERNS", 3)
    df = spark.createDataFrame([(i, 1, [f"s{i}"]) for i in range(5)], "doc_id long, size long, sources array<string>")
    with pytest.raises(ValueError):
        mix(df)
