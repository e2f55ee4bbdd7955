from __future__ import annotations

from collections import Counter, defaultdict

import corpus_pipeline as pipeline

from medallion.llm import simhash
from medallion.llm.common import written
from medallion.llm.mixing import mix, sized

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.collect()
    extra = [(9000, None, "en", "src1", 0), (9001, "... 12", "en", "src1", 6), (9002, rows[3].text, rows[3].lang, None, 5), (None, "no id here at all", "en", "src2", 17)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    frames = [docs]
    for name, stage in pipeline.STAGES:
        frames.append(written(stage(spark, frames[-1], SF), "test-stage"))
    for f in frames[1:-1]:
        assert f.columns == docs.columns
    start, lang, near, cut, mixed, packed = [f.collect() for f in frames]
    gone = {r.doc_id for r in start} - {r.doc_id for r in lang}
    assert {9000, 9001} <= gone and all(i >= 9000 for i in gone)
    fps = defaultdict(set)
    for r in lang:
        fps[simhash.fingerprint((r.text or "").encode())].add(r.doc_id)
    assert 9002 not in {r.doc_id for r in near}
    left = {r.doc_id for r in near}
    assert all(len(ids & left) <= 1 + (None in ids) for ids in fps.values())
    before = {r.doc_id: r for r in near}
    assert Counter(r.doc_id for r in cut) == Counter(r.doc_id for r in near)
    for r in cut:
        assert r == before[r.doc_id] or (len(r.text) < len(before[r.doc_id].text) and r.n_chars == len(r.text))
    texts = {r.doc_id: r.text for r in cut}
    uses = Counter(r.doc_id for r in mixed)
    assert max(uses.values()) <= 3 and all(r.text == texts[r.doc_id] for r in mixed)
    assert Counter(r.doc_id for r in packed if r.piece == 0) == uses
    assert pipeline.run(spark, SF).count() > 0


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_null_and_repeated_ids_are_told_apart(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet").where("lang is not null and n_chars > 400").limit(30)
    rows, schema = base.collect(), "doc_id long, text string, lang string, source string, n_chars long"
    t = [r.text for r in rows]
    own = [(1, t[0]), (None, t[0]), (None, t[0]), (None, t[1]), (None, t[1]), (2, t[2]), (2, t[3]), (3, t[3]), (2, t[3]), (None, t[4])]
    df = spark.createDataFrame([(i, x, "en", "s", len(x)) for i, x in own], schema).repartition(3)
    near = [(r.doc_id, r.text) for r in pipeline.near_copies(spark, df, SF).collect()]
    fps = {x: simhash.fingerprint(x.encode()) for x in t[:5]}
    assert len(set(fps.values())) == 5  # texts of groups of their own
    assert Counter(near) == Counter([(1, t[0]), (None, t[1]), (2, t[2]), (2, t[3]), (None, t[4])])


def test_mix_takes_null_id_rows_one_by_one(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    own = [(None if i % 3 == 0 else i // 2, f"t{i} " * (1 + i % 5), "abc"[i % 3 if i > 60 else 0]) for i in range(300)] + [(None, "", "a"), (None, None, "b")]
    df = spark.createDataFrame([(i, x, "en", s, 1) for i, x, s in own], schema).repartition(3)
    uses = Counter(r.text for r in pipeline.mixing(spark, df, SF).collect())
    want = {r.sources[0]: r.target for r in mix(sized(df)).collect()}
    assert not uses[""] and not uses[None] and max(uses.values()) <= 3
    for s in "abc":
        words = sum(len(x.split()) * uses[x] for _, x, c in own if x and c == s)
        assert abs(words - want[s]) <= 5 / 2 + 1, s


def test_documents_without_a_language_to_learn_stay(spark):
    rows = [(1, "some clean text", None), (2, None, None), (3, "", "en"), (4, "12 ... 3", None), (None, "日本", None), (5, "x", None)]
    df = spark.createDataFrame([(i, t, lang, "s", 1) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = pipeline.language(spark, df, SF)
    assert got.columns == df.columns and {r.text for r in got.collect()} == {"some clean text", "日本", "x"}


def test_no_column_name_clashes(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet").collect()[:60]
    names = ["score", "has_letter", "kept", "n_removed", "_uses", "sources", "key", "row", "TEXT", "Text", "_row", "lang_pred", "_null", "_c0"]
    values = [str(k) for k in range(len(names))]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names)
    df = spark.createDataFrame([(r.doc_id, r.text, r.lang, r.source, r.n_chars, *values) for r in base], schema).repartition(2)
    want = [c.name for c in df.schema]
    for k, (name, stage) in enumerate(pipeline.STAGES):
        got = stage(spark, df, SF)
        if k < 4:
            assert got.columns == want, name
            rows = got.collect()
            assert rows and all(list(r)[5:] == values for r in rows), name
        else:
            assert got.count() > 0


def test_a_stage_drops_the_tables_of_the_one_before(spark):
    from medallion.sources import fs

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = written(pipeline.language(spark, docs, SF), "test-stage")
    docs = written(pipeline.near_copies(spark, docs, SF), "test-stage")
    before = list(pipeline._left)
    assert before and all(fs.exists(spark, p) for p in before)
    lazy = pipeline.repeated_passages(spark, docs, SF)  # its own tables stay while they are read
    assert not any(fs.exists(spark, p) for p in before)
    n = lazy.count()
    pipeline.mixing(spark, lazy, SF)
    assert lazy.count() == n == docs.count()
