"""Duplicate passages by window hashes with anchors (in place of a relative
Lempel-Ziv parse: nothing is extended greedily or checked on the words).

A window is ``size`` = 35 consecutive words.  Every window has an anchor, the
least hash among its runs of ``ANCHOR`` words, so equal windows have equal
anchors at equal places.  The stretch of a document whose windows share an
anchor is a block; the blocks, keyed by their anchor, are the index that all
documents are looked up in.

* A block that occurs twice is a factor as a whole.
* Where documents stop agreeing, blocks with a known anchor differ: these are
  the factor boundaries.  There the windows are looked up one by one.
* A document's consecutive windows that were found make up its factors, each
  of at least ``size`` words; their words are the duplicate spans.

Hashes are shuffled (128 bits for a window: its anchor's and its own), and the
texts once: they are laid out in buckets by row, and the joins with the windows
to look up and with the spans read that layout as it is.  Equal anchors, blocks and windows are
counted by aggregations with map-side combining, so a passage shared by a
third of all documents doesn't meet in one task.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import laid_out, map_batches, pick, release, reused, stored, written
from medallion.sources import fs

ANCHOR = 6
_MASK = (1 << 64) - 1
_STEP = 0x9E3779B97F4A7C15  # an odd factor, so it can be divided out again
_WORDS = 1 << 18  # word hashes that a Python worker keeps


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > _WORDS:
            self.clear()
        h = xxhash.xxh64_intdigest(word, 7)
        if len(word) < 64:
            self[word] = h
        return h


@reused
def word_hashes() -> _WordHash:
    return _WordHash()


@functools.lru_cache(maxsize=8)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def of(x: int) -> np.ndarray:
        a = np.full(n, x, np.uint64)
        a[0] = 1
        return np.cumprod(a)

    return of(_STEP), of(pow(_STEP, -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Hashed:
    """Hashes of any run of a document's words, by prefix sums mod 2^64."""

    def __init__(self, words: list[bytes], hashes: _WordHash):
        self.n = len(words)
        up, self.down = _powers(1 << max(16, (self.n + 1).bit_length()))
        h = np.fromiter(map(hashes.__getitem__, words), np.uint64, self.n)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * up[: self.n])])

    def runs(self, begin: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return _mixed((self.sums[begin + length] - self.sums[begin]) * self.down[begin])

    def blocks(self, size: int) -> tuple[np.ndarray, ...]:
        """anchor, content, first window, its offset to the anchor, windows."""
        anchors = self.runs(np.arange(self.n - ANCHOR + 1), ANCHOR)
        wide = size - ANCHOR + 1
        at = sliding_window_view(anchors, wide).argmin(1) + np.arange(self.n - size + 1)
        first = np.flatnonzero(np.diff(at, prepend=-1))
        windows = np.diff(first, append=len(at))
        return anchors[at[first]], self.runs(first, windows + size - 1), first, at[first] - first, windows


def _texts(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, list[bytes]]]:
    for i, t in enumerate(batch.column("text").to_pylist()):
        words = t.split()
        if len(words) >= size:
            yield i, words


def _concat(parts: list[np.ndarray], dtype: type = np.int64) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, dtype)


def _blocks(texts: DataFrame, size: int) -> DataFrame:
    def fn(batch: pa.RecordBatch, hashes: _WordHash) -> dict:
        got = [(i, *Hashed(w, hashes).blocks(size)) for i, w in _texts(batch, size)]
        row = np.repeat([g[0] for g in got], [len(g[1]) for g in got]).astype(np.int64)
        cols = [_concat([g[k] for g in got], np.uint64 if k < 3 else np.int64) for k in range(1, 6)]
        names = ("anchor", "content", "first", "offset", "windows")
        return {"row": batch.column("row").take(pa.array(row))} | {c: v.view(np.int64) for c, v in zip(names, cols, strict=True)}

    return map_batches(texts, fn, "row long, anchor long, content long, first int, offset int, windows int", word_hashes)


def _windows(texts: DataFrame, size: int) -> DataFrame:
    """A row per window of the blocks listed with each document."""

    def fn(batch: pa.RecordBatch, hashes: _WordHash) -> dict:
        out: dict[str, list] = {c: [] for c in ("row", "anchor", "window", "at", "n")}
        lists = batch.column("blocks").to_pylist()
        for i, words in _texts(batch, size):
            hashed = Hashed(words, hashes)
            for b in lists[i]:
                at = b["first"] + np.arange(b["windows"])
                out["at"].append(at)
                out["window"].append(hashed.runs(at, size))
                for c, v in (("row", i), ("anchor", b["anchor"]), ("n", b["n"])):
                    out[c].append(np.full(len(at), v, np.int64))
        cols = {c: _concat(v, np.uint64 if c == "window" else np.int64) for c, v in out.items()}
        row = pa.array(cols.pop("row"))
        return {"row": batch.column("row").take(row)} | {c: v.view(np.int64) for c, v in cols.items()}

    return map_batches(texts, fn, "row long, anchor long, window long, at int, n long", word_hashes)


def _rows(docs: DataFrame, **carry: str) -> DataFrame:
    """row, a unique key, doc_id, text (bytes) and the columns ``carry``,
    laid out by row once, for all joins with the texts."""
    own = pick(docs, doc_id="doc_id", text="text", **carry)
    raw = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text")
    own = own.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), raw, *carry)
    return laid_out(own, "row", "texts", own.agg(F.sum(F.octet_length("text"))).first()[0] or 0)


def factors(texts: DataFrame, size: int = 35) -> DataFrame:
    """(row, spans): for each row of (row, text) with duplicate windows, the
    runs [first word, words) of its factors."""
    spark = texts.sparkSession
    # aggregates are written before they are joined: a join right on its
    # shuffles can be split where one anchor has a great share of the blocks
    every, path = stored(_blocks(texts.select("row", "text"), size), "all-blocks")
    known = written(every.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "anchors")
    release(spark)
    block = ["anchor", "content", "offset", "windows"]
    found = written(every.join(known, "anchor"), "blocks")
    fs.delete(spark, path)
    release(spark)
    one = F.struct("row", "first")
    index = written(found.groupBy(*block).agg(F.count("*").alias("n"), F.min(one).alias("one")), "block-index")
    release(spark)
    whole = found.join(index.where("n > 1").select(*block), block, "left_semi").select("row", "first", "windows")
    # boundaries: anchors with blocks that differ, one of which is alone
    mixed = index.groupBy("anchor").agg(F.count("*").alias("blocks"), F.min("n").alias("least")).where("blocks > 1 and least = 1")
    mixed = written(mixed.select("anchor"), "mixed-anchors")
    look = index.join(mixed, "anchor").groupBy("one.row").agg(F.collect_list(F.struct("anchor", F.col("one.first").alias("first"), "windows", "n")).alias("blocks"))
    looked = texts.select("row", "text").join(look.hint("shuffle_hash"), "row")
    windows = written(_windows(looked, size), "windows")
    release(spark)
    repeated = written(windows.groupBy("anchor", "window").agg(F.sum("n").alias("n")).where("n > 1").select("anchor", "window"), "repeated")
    single = windows.where("n = 1").join(repeated, ["anchor", "window"], "left_semi").select("row", F.col("at").alias("first"), F.lit(1).alias("windows"))
    runs = whole.unionByName(single).groupBy("row").agg(F.collect_list(F.struct("first", "windows")).alias("runs"))
    spans = written(merged_spans(runs, size), "spans")
    release(spark)
    return spans


def merged(first: np.ndarray, windows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of windows to disjoint spans of words, in order: (first, words).  A
    run of ``w`` windows covers ``w + size - 1`` words; runs that touch merge."""
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate((first + windows + size - 1)[order])
    begins = np.flatnonzero(np.concatenate([[True], first[1:] > reach[:-1]]))
    ends = np.append(begins[1:], len(first)) - 1
    return first[begins], reach[ends] - first[begins]


def merged_spans(runs: DataFrame, size: int) -> DataFrame:
    def fn(batch: pa.RecordBatch) -> dict:
        lists = batch.column("runs")
        flat, ends = lists.flatten(), np.cumsum(lists.value_lengths().to_numpy())
        first, windows = (flat.field(k).to_numpy().astype(np.int64) for k in (0, 1))
        parts = [merged(first[a:b], windows[a:b], size) for a, b in zip(np.append(0, ends[:-1]), ends, strict=True)] if len(ends) else []
        counts = np.cumsum([0] + [len(p[0]) for p in parts])
        items = pa.StructArray.from_arrays([pa.array(_concat([p[k] for p in parts]).astype(np.int32)) for k in (0, 1)], ["first", "words"])
        return {"row": batch.column("row"), "spans": pa.ListArray.from_arrays(pa.array(counts, pa.int32()), items)}

    return map_batches(runs, fn, "row long, spans array<struct<first: int, words: int>>")


def remove_repeated(docs: DataFrame, size: int = 35, carry: tuple[str, ...] = (), as_is: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the kept words joined by a blank),
    and the columns of ``docs`` named in ``carry``.  ``as_is``: texts that
    lose nothing are kept with their white space.

    Each word covered by a window of ``size`` words whose sequence also
    starts elsewhere, in the same document or another, is removed; windows
    are judged on the input.  Null and empty texts, and those shorter than a
    window, lose nothing.  Every row is a place of its own and gives a row,
    whether its doc_id is null, repeated or unique.  A text is held by one task
    as a list of its words, whatever its length.  Empty table: no rows.  Extra
    columns, whatever their names, are left out if they aren't carried.
    """
    names = {f"_k{i}": c for i, c in enumerate(carry)}
    own = _rows(docs, **names)
    spans = factors(own, size)
    schema = "".join(f", {f.name} {f.dataType.simpleString()}" for f in own.schema if f.name in names)

    def fn(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {c: [] for c in ("n_words", "n_removed", "kept")}
        for text, runs in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            words = text.split()
            keep, at = [], 0
            for r in runs or ():
                keep += words[at : r["first"]]
                at = r["first"] + r["words"]
            keep += words[at:]
            out["n_words"].append(len(words))
            out["n_removed"].append(len(words) - len(keep))
            out["kept"].append((text if as_is and not runs else b" ".join(keep)).decode("utf-8", "replace"))
        return {c: batch.column(c) for c in ("doc_id", *names)} | out

    joined = own.join(spans.hint("shuffle_hash"), "row", "left").select("doc_id", "text", "spans", *names)
    got = map_batches(joined, fn, f"doc_id long, n_words long, n_removed long, kept string{schema}")
    return got.toDF("doc_id", "n_words", "n_removed", "kept", *carry)
