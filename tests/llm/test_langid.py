from __future__ import annotations

import zlib

import numpy as np

from medallion.llm import langid


def test_gradients_equal_finite_differences():
    rng = np.random.default_rng(0)
    net = langid.BiGru(["a", "b", "c"], hidden=3, seed=1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    steps, target = rng.integers(0, 5, (6, 4)).astype(np.uint8), np.array([0, 2, 1, 1])
    inside = np.ones((6, 4))
    inside[4:, 1] = 0

    def loss():
        p = net.probabilities(steps)[:, np.arange(4), target]
        return -(np.log(p) * inside).sum() / inside.sum()

    g = net.gradients(steps, inside, target)
    for k, w in net.p.items():
        for at in [tuple(rng.integers(0, n) if i or k[1:] != ".in" else rng.integers(0, 5) for i, n in enumerate(w.shape)) for _ in range(6)]:
            old = w[at]
            w[at] = old + 1e-4
            up = loss()
            w[at] = old - 1e-4
            down = loss()
            w[at] = old
            assert abs((up - down) / 2e-4 - g[k][at]) < 2e-3, (k, at)  # states are kept in single precision


def test_held_out_accuracy_and_odd_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs)
    got = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    want = {r.doc_id: r.lang for r in docs.collect()}
    out = [i for i in want if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i, r in got.items() if r.held_out} == set(out)
    assert np.mean([got[i].lang_pred == want[i] for i in out if want[i]]) > 0.95
    assert all(0 <= r.score <= 1 for r in got.values())

    # lang, source and doc_id are no inputs
    rows = docs.limit(20).collect()
    texts = [*(r.text for r in rows), None, "", "123 ... !", "the and " * 20000, "日本", rows[0].text]
    df = spark.createDataFrame([(None if i == 3 else -i, t, "xx", 1, "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, score int, LANG string").repartition(3)
    odd = langid.identify(df, model).collect()
    assert len(odd) == len(texts)
    for r in odd:
        i = 3 if r.doc_id is None else -r.doc_id
        if i < 20:
            assert r.lang_pred == got[rows[i].doc_id].lang_pred and abs(r.score - got[rows[i].doc_id].score) < 1e-5
    by = {r.doc_id: (r.lang_pred, r.score) for r in odd}
    assert by[-20] == by[-21] == by[-22] == ("und", 0.0) and by[-23][0] == "en" and by[-24][0] in model.labels
    assert next(r for r in odd if r.doc_id is None).held_out is False


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "some text", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert {(r.doc_id, r.lang_pred, r.score) for r in langid.identify(df).collect()} == {(1, "und", 0.0), (2, "und", 0.0)}
    assert langid.identify(df.limit(0)).count() == 0
