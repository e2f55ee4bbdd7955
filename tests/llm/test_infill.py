from __future__ import annotations

import hashlib
import random
import re
import time

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from medallion.llm.infill import Exceptions, fill_in_middle, restored, unit_starts

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("abZ<P>é€𝄞\x00\n ́ß"), max_size=60))
def test_units_and_cuts_of_any_text(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    units = UNIT.findall(text)
    ends = np.cumsum([0] + [len(u) for u in units])
    byte_ends = np.cumsum([0] + [len(u.encode()) for u in units])
    assert unit_starts(raw).tolist() == byte_ends[:-1].tolist()
    index = Exceptions(raw)
    assert len(index.at) == sum(ord(c) > 127 for c in text)  # nothing recorded for ASCII
    assert index.chars(byte_ends).tolist() == ends.tolist()
    assert index.bytes(ends).tolist() == byte_ends.tolist()


def brute(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, len(units), "plain", None, None, text
    if h4 % 100 < 20:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_odd_documents_and_the_way_back(spark):
    rnd = random.Random(3)
    texts = ["", None, "é", "a<P>b", "x <S", "S> <M", "<<P", "\n", "a\x00b", "ab́c", "𝄞" * 50, "word " * 3]
    texts += ["".join(rnd.choice("abc <é€𝄞>PSM\n") for _ in range(rnd.randint(0, 80))) for _ in range(300)]
    rows = list(enumerate(texts)) + [(None, "no id at all"), (None, "no id at all"), (7, "again"), (-5, "minus é"), (2**62, "large id")]
    df = spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], "doc_id long, text string, n int, OUTPUT string, Text string").repartition(3)
    got = fill_in_middle(df).withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    want = [brute(*r) for r in rows]
    assert sorted(map(str, [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got])) == sorted(map(str, want))
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    assert sorted(r.back for r in got) == sorted(t or "" for _, t in rows)
    for r in got:
        if r.form != "plain":
            assert len(r.back[: r.prefix_chars].encode()) == r.prefix_bytes
            assert len(r.back[r.prefix_chars : r.prefix_chars + r.middle_chars].encode()) == r.middle_bytes
    assert fill_in_middle(df.limit(0)).count() == 0


def test_a_very_long_text(spark):
    text = "Straße und Wörter, " * 400_000
    began = time.time()
    [got] = fill_in_middle(spark.createDataFrame([(1, text)], "doc_id long, text string")).withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    assert got.back == text and (got.n, got.form) == brute(1, text)[1:3] and time.time() - began < 60
