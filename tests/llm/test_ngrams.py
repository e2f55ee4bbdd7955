from __future__ import annotations

import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from medallion.llm import ngrams
from medallion.llm.common import collecting
from medallion.llm.ngrams import estimates, read_levels, score_texts, segment_bits

SCHEMA = "doc_id long, text string, score double, n int, TEXT string, held_out string"


def held_out(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1


def split(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def brute(rows):
    counts = Counter(w for i, t in rows if not held_out(i) for w in split(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        ws = split(t)
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        out.append((i, held_out(i), len(ws), sum(counts[w] > 0 for w in ws), n, round(base, 6)))
    return sorted(map(str, out))


def exact(rows):
    """The model's scores by exact counts, without a filter."""
    words, pairs = Counter(), Counter()
    for i, t in rows:
        if not held_out(i):
            ws = split(t)
            words.update(ws)
            pairs.update(zip([None, *ws], ws))
    n, v, out = sum(words.values()), len(words), {}
    for i, t in rows:
        ws = split(t)
        own = lambda w: (words[w] + 0.5) / (n + 0.5 * (v + 1))
        out[i] = sum(math.log10((pairs[a, b] + ngrams.PRIOR * own(b)) / (words[a] + ngrams.PRIOR)) for a, b in zip([None, *ws], ws))
    return out


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(6)
    vocabulary = [f"w{int(rnd.paretovariate(0.7))}" for _ in range(3000)]
    rows = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 60)))) for i in range(300)]
    rows += [(i, f"The hot É\xa0{'x' * 100} phrase hot\tphrase\n" * 3 + str(i)) for i in range(300, 450)]
    return rows + [(None, "no id"), (None, "no id"), (3, "again w1"), (1001, None), (1002, ""), (1003, " \n "), (1004, "only here"), (1005, "ÀÉ àé İ")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 0.0, 1, "x", "y") for i, t in rows], SCHEMA).repartition(3)


def shown(got):
    return sorted(str((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))) for r in got)


def test_odd_documents_against_exact_counts(spark, rows):
    got = score_texts(frame(spark, rows)).collect()
    assert shown(got) == brute(rows)
    want = exact(rows)
    by = {r.doc_id: r for r in got if r.doc_id not in (None, 3)}
    for i, r in by.items():
        assert abs(r.score - want[i]) < 0.1 * r.n_tokens + 0.01 and r.score <= 0
    assert np.mean([abs(by[i].score - want[i]) / by[i].n_tokens for i in by]) < 0.03


def test_few_common_words_and_a_filter_in_slices_change_nothing(spark, rows, monkeypatch):
    monkeypatch.setattr(ngrams, "SEGMENT_EVENTS", 700)
    want = score_texts(frame(spark, rows)).collect()
    monkeypatch.setattr(ngrams, "COMMON", 10)
    monkeypatch.setattr(ngrams, "BROADCAST", 3 << 20)
    monkeypatch.setattr(ngrams, "ASKED", 500)
    got = score_texts(frame(spark, rows)).collect()
    assert shown(got) == shown(want) == brute(rows)
    key = lambda r: (r.doc_id or -1, round(r.score, 6))
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_a_filter_in_slices_travels_in_pieces_and_rounds_leave_no_tables(spark, rows, monkeypatch):
    monkeypatch.setattr(ngrams, "SEGMENT_EVENTS", 700)
    monkeypatch.setattr(ngrams, "BROADCAST", 3 << 20)
    paths = []
    with collecting(paths):
        got = score_texts(frame(spark, rows))
    left = {p.rpartition("/")[2].split("-")[1]: p for p in paths if os.path.exists(p.removeprefix("file:"))}
    assert set(left) == {"words", "filter", "scored"}
    assert spark.read.parquet(left["filter"]).agg(F.max(F.length("bits"))).first()[0] <= 1 << 16
    assert shown(got.collect()) == brute(rows)


def test_long_texts_are_blocks_of_their_own():
    texts = [b"a b a", b"", b"long " * 2_000_000, b"b c"]
    ids, held = pa.array([1, None, 3, 4], pa.int64()), pa.array([True, False, False, True])
    cols = ngrams._pack(pa.RecordBatch.from_arrays([ids, held, pa.array(texts, pa.binary())], ["doc_id", "held_out", "text"]))
    blocks = pa.RecordBatch.from_arrays([pa.array(cols[c]) for c in cols], list(cols))
    assert blocks.column("doc_id").to_pylist() == [[1, None], [3, 4]]
    assert blocks.column("held_out").to_pylist() == [[True, False], [False, True]]
    for k, own in enumerate((texts[:2], texts[2:])):
        found, want = ngrams._unpacked(blocks.slice(k, 1)), ngrams.tokens(pa.array(own))
        assert found.sizes.tolist() == want.sizes.tolist()
        assert (found.keys[found.codes] == want.keys[want.codes]).all() and (found.pairs() == want.pairs()).all()
        assert blocks.column("n")[k].as_py() == len(want.codes) + len(want.keys)


def test_nothing_to_learn_from(spark):
    only = [i for i in range(200) if held_out(i)][:5]
    got = score_texts(frame(spark, [(i, "a b a") for i in only])).collect()
    assert shown(got) == brute([(i, "a b a") for i in only]) and all(r.score == 0 for r in got)
    assert score_texts(frame(spark, []).limit(0)).count() == 0


def test_levels_are_never_too_low_and_seldom_too_high():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**63, 650_000).astype(np.uint64)
    levels = np.minimum(rng.geometric(0.8, len(x)), 40)[:500_000]
    bits = np.frombuffer(segment_bits(x[:500_000], levels), np.uint8)
    got = read_levels(bits, np.zeros(len(x), np.int64), x)
    assert (got[:500_000] >= levels).all() and (got[:500_000] != levels).mean() < 0.01
    assert (got[500_000:] > 0).mean() < 0.01
    assert estimates()[:6].tolist() == [0, 1, 2, 3, 4.5, 6.5]
