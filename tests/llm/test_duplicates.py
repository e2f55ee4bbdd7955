from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
import xxhash

from medallion.llm import simhash, substring


def brute_fingerprint(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows, radius=4):
    """rows: (doc_id, fp).  fp -> least doc_id."""
    fps = sorted({f for _, f in rows})
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                parent[find(a)] = find(b)
    least = {}
    for d, f in rows:
        if d is not None:
            r = find(f)
            least[r] = min(d, least.get(r, d))
    return {f: least.get(find(f)) for f in fps}


def expect(rows):
    fps = [(d, brute_fingerprint(t)) for d, t in rows]
    comp = brute_components(fps)
    return Counter((d, f"{f:016x}", comp[f]) for d, f in fps)


@pytest.fixture(scope="module")
def odd():
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)] + ["É", "ÀB", "x\xa0y"]
    words = [rnd.choice(vocabulary) for _ in range(150)]
    rows = [(None, " ".join(words)), (0, None), (1, ""), (2, " \t\n"), (3, "One two"), (4, "one TWO"), (5, "a b c d"), (6, "a b c d e")]
    for i in range(40):  # near copies of one text, and a repeated row
        w = list(words)
        for _ in range(i % 4):
            w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
        rows.append((10 + i, " ".join(w)))
    rows += [(12, rows[10][1]), (12, rows[10][1]), (90, "again and again " * 30), (91, "z " * 3000)]
    rows += [(100 + i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(1, 90)))) for i in range(40)]
    # a passage that documents share at different places
    rows += [(200 + i, " ".join([*(f"p{i}_{k}" for k in range(i)), *words[20 : 60 + i], *(f"q{i}_{k}" for k in range(i))])) for i in range(12)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, anchor int, TEXT string").repartition(3)


def test_components_of_odd_texts(spark, odd):
    got = simhash.near_duplicates(frame(spark, odd))
    assert Counter(tuple(r) for r in got.select("doc_id", "fingerprint", "component_id").collect()) == expect(odd)
    assert simhash.near_duplicates(frame(spark, odd).limit(0)).count() == 0


def test_components_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert Counter(tuple(r) for r in simhash.near_duplicates(docs).collect()) == expect(rows)


def test_links_join_what_is_near_with_several_shards(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD", 8)
    rnd = random.Random(5)
    base = [rnd.getrandbits(64) for _ in range(30)]
    fps = {b for b in base}
    for b in base[:4]:
        for _ in range(60):
            x = b
            for k in rnd.sample(range(64), rnd.randint(1, 6)):
                x ^= 1 << k
            fps.add(x)
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(4)
    roots = dict(simhash.components(simhash.links(df, 4)).collect())
    comp = brute_components(list(enumerate(fps)))
    groups = defaultdict(set)
    for x, s in zip(fps, signed, strict=True):
        groups[comp[x]].add(roots.get(s, s))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_bk_tree_finds_all_within_the_radius():
    rnd = random.Random(1)
    fps = [rnd.getrandbits(12) for _ in range(200)]
    tree = simhash.BKTree(fps[0])
    for f in fps[1:]:
        tree.add(f)
    for q in range(0, 4096, 37):
        assert set(tree.search(q, 3)) == {f for f in fps if (f ^ q).bit_count() <= 3}


def brute_removed(rows, size):
    words = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i : i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for (d, _), w in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i : i + size])] > 1:
                gone.update(range(i, i + size))
        out.append((d, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return Counter(out)


@pytest.mark.parametrize("size", [35, 9])
def test_removed_words_of_odd_texts(spark, odd, size):
    got = substring.remove_repeated(frame(spark, odd), size)
    assert Counter(tuple(r) for r in got.collect()) == brute_removed(odd, size)
    if size == 9:
        assert substring.remove_repeated(frame(spark, odd).limit(0), size).count() == 0


def test_removed_words_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert Counter(tuple(r) for r in substring.remove_repeated(docs).collect()) == brute_removed(rows, 35)


def test_rows_are_told_apart_without_ids(spark):
    """Texts whose 32-bit hashes collide, all of one null id."""
    from pyspark.sql import functions as F

    n = 200_000
    ids = spark.range(n).select("id", F.concat_ws(" ", *[F.concat(F.lit(f"v{k}_"), F.col("id")) for k in range(40)]).alias("text"))
    hashed = ids.select("id", "text", F.hash(F.col("text").cast("binary")).alias("h"))
    twice = hashed.groupBy("h").agg(F.collect_list("text").alias("texts")).where("size(texts) > 1").limit(3).collect()
    assert twice  # about five pairs are to be expected
    rows = [(None, t) for r in twice for t in r.texts[:2]] + [(5, r.texts[0]) for r in twice] + [(None, None)] * 50
    assert Counter(tuple(r) for r in substring.remove_repeated(frame(spark, rows)).collect()) == brute_removed(rows, 35)


def test_spans_merge_in_linear_time():
    import time

    import numpy as np

    rnd = random.Random(2)
    for _ in range(50):
        first = np.array([rnd.randrange(60) for _ in range(rnd.randint(1, 12))])
        windows = np.array([rnd.randint(1, 5) for _ in first])
        got = substring.merged(first, windows, 4)
        covered = {w for f, n in zip(first, windows, strict=True) for w in range(f, f + n + 3)}
        assert {w for f, n in zip(*got, strict=True) for w in range(f, f + n)} == covered
        assert all(f + n < g for f, n, g in zip(got[0], got[1], got[0][1:]))
    began = time.time()
    substring.merged(np.arange(2_000_000) * 50, np.ones(2_000_000, int), 35)
    assert time.time() - began < 5


def test_a_text_of_a_million_words(spark):
    rnd = random.Random(4)
    words = [f"w{rnd.randrange(50_000)}" for _ in range(1_000_000)]
    words[900_000:900_100] = words[100:200]
    rows = [(1, " ".join(words)), (2, " ".join(words[500_000:500_040]))]
    got = {r.doc_id: r.n_removed for r in substring.remove_repeated(frame(spark, rows)).collect()}
    assert got == {1: 240, 2: 40}
