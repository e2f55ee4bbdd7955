from __future__ import annotations

import functools
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest

from medallion.llm import packing
from medallion.llm.common import pick
from medallion.llm.idfiles import read_ids, write_ids
from medallion.llm.tokens import PieceCounts, WordIds, id_type, token_counts
from medallion.session import staging_path

WORD, PIECE = P.path("word_bpe_49k.json"), P.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  a", "a  b \n\n c\t", "▁x ▁▁y", "<s></s> <unk>", "\x00a\x1cb", "İstanbul ΣΑΣ ﬁ K", "é Á́ a b c",
    "don't it's I'LL", "<|endoftext|>x<|startoftext|>", "世界 😀😀 1234", "a" * 5000, "word " * 6000, "same", "same", "\r\nx\x85y",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(ODD)] + [(3, ODD[3], "x", 1), (3, "other", "x", 2), (None, "no id", "x", 3)]
    # columns named like the operators' own, one in another case
    return spark.createDataFrame(rows, "doc_id long, text string, TEXT string, n_tokens int").repartition(3)


def texts(docs):
    return [(r.doc_id, r.text or "") for r in pick(docs, doc_id="doc_id", text="text").collect()]


def test_counts_equal_the_library(spark, docs):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    want = sorted((i or -1, len(t.encode()), len(sp.encode(t)), len(sp.encode(t)) > 4096) for i, t in texts(docs))
    got = token_counts(docs, PIECE)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted((r.doc_id or -1, *r[1:]) for r in got.collect()) == want
    assert token_counts(docs.limit(0), PIECE).count() == 0


def test_units_add_up_for_any_text_and_small_tables(monkeypatch):
    import random

    from medallion.llm import tokens

    monkeypatch.setattr(tokens, "TABLE_BYTES", 2000)
    counts, ids, rnd = PieceCounts(PIECE), WordIds(WORD), random.Random(7)
    parts = [" ", "  ", "\n", "\t", "a", "the", "▁", "é", "世界", "<s>", "\x00", "'s", "İ", "ß", "Σ", "́", "\xa0", "\x1c", "<|endoftext|>", "12", "...", "😀", "\r\n"]
    for _ in range(3000):
        t = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25)))
        assert counts.count(t) == len(counts.sp.encode(t)), repr(t)
        assert np.frombuffer(ids.ids(t.encode()), ids.dtype).tolist() == ids.tok.encode(t, add_special_tokens=False).ids, repr(t)


@functools.cache
def word_model():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORD)


def word_ids(t, end):
    return np.array([*word_model().encode(t, add_special_tokens=False).ids, end], "<u4")


def test_files_round_trip_in_id_order(spark, docs):
    folder = staging_path(spark, "ids-test")
    manifest = write_ids(docs, WORD, folder, end_id=2)
    got = read_ids(spark, folder, id_type(WordIds(WORD).tok)).collect()
    got = sorted(got, key=lambda r: r.start)
    ids = [r.doc_id if r.doc_id is not None else -1 for r in got]
    assert ids == sorted(ids) and ids[0] == -1
    at = 0
    want = defaultdict(list)
    for i, t in texts(docs):
        want[i].append((len(w := word_ids(t, 2)), zlib.crc32(w)))
    have = defaultdict(list)
    for r in got:
        assert r.start == at
        at += r.n_tokens
        have[r.doc_id].append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}
    assert sum(r.ids for r in manifest.collect()) == at
    empty = staging_path(spark, "ids-empty")
    write_ids(docs.limit(0), WORD, empty, 2)
    assert read_ids(spark, empty, np.dtype("<u2")).count() == 0


def check_packing(rows, docs, size, end):
    want = defaultdict(list)
    for i, t in texts(docs):
        w = word_ids(t, end)
        for k, at in enumerate(range(0, len(w), size)):
            want[i].append((k, at, len(w[at : at + size]), zlib.crc32(w[at : at + size])))
    have, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        have[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        seqs[r.sequence_id].append((r.offset, r.length))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(seqs), sum(r.length for r in rows)


def test_packing_of_odd_texts(spark, docs):
    n, total = check_packing(packing.pack(docs, WORD).collect(), docs, 2048, 0)
    assert n == -(-total // 2048)
    assert packing.pack(docs.limit(0), WORD).count() == 0
    check_packing(packing.pack(docs, WORD, size=7).collect(), docs, 7, 0)


def test_packing_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    n, total = check_packing(packing.pack(docs, WORD).collect(), docs, 2048, 0)
    assert n <= -(-total // 2048) * 1.01 + 1


def test_plan_uses_each_piece_once_and_is_near_the_bound():
    rng = np.random.default_rng(0)
    for size, n in ((64, 1), (64, 50), (64, 5000), (257, 20000)):
        counts = np.bincount(rng.integers(1, size + 1, n), minlength=size + 1)
        used = np.zeros(size + 1, int)
        plan = packing.plan(counts, size)
        for lengths, k in plan:
            assert sum(lengths) <= size
            for v in lengths:
                used[v] += k
        assert (used == counts).all()
        assert sum(k for _, k in plan) <= sum(k for _, k in packing.best_fit(counts, size)) * 1.01
